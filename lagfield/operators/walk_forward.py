"""Walk-forward back-tests of several anchors at once, from one table of history.

The folds are a small table joined to the rows, so every fold reads the same pass. A linear model needs only the cross
products of its columns: these are summed once per month, a fold's training set is the sum of the months up to its
cut, and each fold is then solved from one small matrix.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagfield.functions import series as S
from lagfield.functions.periods import month_index
from lagfield.functions.scalars import clip
from lagfield.session import stored

# fixed values: months ahead, lags of the linear model
HORIZON, LAGS = 2, 12


def fold_table(history: DataFrame, anchors: Sequence[int]) -> DataFrame:
    rows = F.array(*[F.lit(int(a)) for a in sorted(set(anchors))])
    return history.sparkSession.range(1).select(F.explode(rows).alias("anchor"))


def naive_folds(history: DataFrame, anchors: Sequence[int], horizon: int = HORIZON) -> DataFrame:
    """``anchor, product_id, actual`` and the three naive forecasts, for every product with a value at the target month.

    ``history`` has product_id, periodo and tn, one row a month. last: the anchor's month; mean_12: the mean of the
    twelve months up to it; same_month: the target's month a year before, else mean_12. A forecast without any row
    is 0. A row serves each fold whose months it lies in, by one join with the folds and one aggregate.
    """
    at = month_index("periodo") - month_index("anchor")
    rows = history.join(F.broadcast(fold_table(history, anchors)), at.between(-11, horizon)).withColumn("_at", at)
    pick = lambda k: F.max(F.when(F.col("_at") == k, F.col("tn")))
    out = rows.groupBy("anchor", "product_id").agg(
        pick(horizon).alias("actual"),
        pick(0).alias("last"),
        F.avg(F.when(F.col("_at") <= 0, F.col("tn"))).alias("mean_12"),
        pick(horizon - 12).alias("_year"),
    )
    out = out.where(F.col("actual").isNotNull())
    zero = lambda *of: F.coalesce(*of, F.lit(0.0))
    return out.select(
        "anchor", "product_id", "actual", zero("last").alias("last"), zero("mean_12").alias("mean_12"),
        zero("_year", "mean_12").alias("same_month"),
    )


def lag_rows(history: DataFrame, lags: int = LAGS, horizon: int = HORIZON) -> tuple[DataFrame, list[str]]:
    """Rows with the last ``lags`` values and the target, both null where the series has no such month."""
    row = S.series(["product_id"])
    names = [f"lag_{k}" for k in range(lags)]
    cols = [S.lag("tn", k, row).alias(f"lag_{k}") for k in range(lags)]
    return history.select("product_id", "periodo", *cols, F.lead("tn", horizon).over(row).alias("target")), names


def _cells(names: Sequence[str]) -> list[tuple[int, int, Column]]:
    columns = [F.lit(1.0), *[F.col(n) for n in names], F.col("target")]
    return [(i, j, columns[i] * columns[j]) for i in range(len(columns)) for j in range(i, len(columns))]


def cross_products(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per month the sums of all products of constant, columns and target, over rows that have all of them."""
    whole = rows.dropna(subset=[*names, "target"])
    return whole.groupBy("periodo").agg(*[F.sum(x).alias(f"s_{i}_{j}") for i, j, x in _cells(names)])


def solve_folds(months: DataFrame, names: Sequence[str], anchors: Sequence[int], horizon: int = HORIZON) -> dict[int, list[float]]:
    """Least-squares coefficients (constant first) of every fold, trained on months up to anchor - horizon.

    Targets of later months were not known at the anchor. One row per fold comes to the driver. Columns that depend
    on each other get the shortest solution; a fold without training rows gets none.
    """
    cut = month_index("periodo") <= month_index("anchor") - horizon
    sums = [F.sum(f"s_{i}_{j}").alias(f"s_{i}_{j}") for i, j, _ in _cells(names)]
    found = {}
    for row in months.join(F.broadcast(fold_table(months, anchors)), cut).groupBy("anchor").agg(*sums).collect():
        size = len(names) + 2
        full = np.zeros((size, size))
        for i, j, _ in _cells(names):
            full[i, j] = full[j, i] = row[f"s_{i}_{j}"]
        found[row["anchor"]] = np.linalg.lstsq(full[:-1, :-1], full[:-1, -1], rcond=1e-12)[0].tolist()
    return found


def linear_folds(history: DataFrame, anchors: Sequence[int], lags: int = LAGS, horizon: int = HORIZON) -> DataFrame:
    """``anchor, product_id, actual, ols``: the linear forecast of every fold for products with all lags at the anchor.

    ``history`` must have no gaps (see ``panel.densify``). All folds are trained from one aggregate and scored in one
    pass; a forecast below 0 counts as 0.
    """
    rows, names = lag_rows(history, lags, horizon)
    rows = stored(rows, "lag-rows")
    solved = solve_folds(stored(cross_products(rows, names), "cross-products"), names, anchors, horizon)
    anchored = rows.where(F.col("periodo").isin(list(solved))).dropna(subset=[*names, "target"])
    forecast = F.lit(None).cast("double")
    for anchor, beta in sorted(solved.items()):
        value = F.lit(beta[0])
        for name, b in zip(names, beta[1:]):
            value = value + F.lit(b) * F.col(name)
        forecast = F.when(F.col("periodo") == anchor, value).otherwise(forecast)
    return anchored.select(F.col("periodo").alias("anchor"), "product_id", F.col("target").alias("actual"), clip(forecast, 0.0).alias("ols"))


def pooled_errors(forecasts: DataFrame, models: Sequence[str]) -> DataFrame:
    """``model, folds, rows, wape``: absolute errors over actual values, all folds together; null if these sum to 0."""
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("forecast")) for m in models])
    each = forecasts.select("anchor", "actual", F.inline(pairs))
    total = F.sum("actual")
    return each.groupBy("model").agg(
        F.count_distinct("anchor").alias("folds"),
        F.count(F.lit(1)).alias("rows"),
        F.when(total > 0, F.sum(F.abs(F.col("actual") - F.col("forecast"))) / total).alias("wape"),
    )
