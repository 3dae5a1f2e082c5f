"""Baseline forecasts and the completion of a forecast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagfield.functions.periods import shift_period
from lagfield.functions.scalars import clip
from lagfield.operators.relational import overridden


# fixed value: the usual key of a series
PRODUCT = ("product_id",)


def last_month(history: DataFrame, anchor: int, keys: Sequence[str] = PRODUCT) -> DataFrame:
    """tn(t)."""
    return history.where(F.col("periodo") == anchor).select(*keys, "tn")


def mean_12(history: DataFrame, anchor: int, keys: Sequence[str] = PRODUCT) -> DataFrame:
    """Mean of the rows of the last 12 months.

    On a history with gaps that is the mean of the observed months; on a
    gap-free one, zero months count.
    """
    recent = history.where(F.col("periodo").between(shift_period(anchor, -11), anchor))
    return recent.groupBy(*keys).agg(F.avg("tn").alias("tn"))


def same_month(history: DataFrame, anchor: int, horizon: int = 2, keys: Sequence[str] = PRODUCT) -> DataFrame:
    """The target month one year before, else the 12-month mean."""
    year_ago = history.where(F.col("periodo") == shift_period(anchor, horizon - 12)).select(*keys, "tn")
    return overridden(mean_12(history, anchor, keys), year_ago, keys, "tn")


BASELINES = {"last_month": last_month, "mean_12": mean_12, "same_month": same_month}


def complete(requested: DataFrame, prediction: DataFrame, fallback: DataFrame) -> DataFrame:
    """One row per requested product: prediction, else fallback, else 0; never negative."""
    second = fallback.select("product_id", F.col("tn").alias("_fallback"))
    joined = requested.select("product_id").join(prediction.select("product_id", "tn"), "product_id", "left")
    joined = joined.join(second, "product_id", "left")
    return joined.select("product_id", clip(F.coalesce("tn", "_fallback", F.lit(0.0)), low=0.0).alias("tn"))


def submission(requested: DataFrame, prediction: DataFrame, history: DataFrame, anchor: int) -> DataFrame:
    """:func:`complete` with the 12-month mean of ``history`` as fallback."""
    return complete(requested, prediction, mean_12(history, anchor))
