"""Convex blends of two forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagfield.functions.scalars import clip


def checked_forecast(df: DataFrame, expected: int | None = None) -> DataFrame:
    """Id and value of a forecast; raises on repeated ids or an unexpected row count."""
    out = df.select("product_id", F.col("tn").cast("double").alias("tn"))
    row = out.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("product_id").alias("ids")).first()
    if row["n"] != row["ids"]:
        raise ValueError(f"product_id repeats: {row['n']} rows, {row['ids']} ids")
    if expected is not None and row["n"] != expected:
        raise ValueError(f"expected {expected} products, found {row['n']}")
    return out


def paired(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    x = baseline.select("product_id", F.col("tn").alias("tn_base"))
    y = candidate.select("product_id", F.col("tn").alias("tn_candidate"))
    return x.join(y, "product_id")


def blend(baseline: DataFrame, candidate: DataFrame, weights: Sequence[float]) -> DataFrame:
    """``(1 - w) * baseline + w * candidate`` for each candidate weight, not below 0."""
    each = F.explode(F.array(*[F.lit(float(w)) for w in weights])).alias("weight")
    rows = paired(baseline, candidate).select("product_id", "tn_base", "tn_candidate", each)
    mixed = (1 - F.col("weight")) * F.col("tn_base") + F.col("weight") * F.col("tn_candidate")
    return rows.select("weight", "product_id", clip(mixed, low=0.0).alias("tn"), mixed.alias("tn_raw"))


def blend_totals(blended: DataFrame) -> DataFrame:
    return blended.groupBy("weight").agg(F.sum("tn_raw").alias("tn_total"))


def diagnostics(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """Correlation, and summed absolute difference over the baseline total."""
    x, y = F.col("tn_base"), F.col("tn_candidate")
    return paired(baseline, candidate).agg(
        F.corr(x, y).alias("correlation"),
        F.try_divide(F.sum(F.abs(x - y)), F.sum(x)).alias("disagreement"),
    )
