"""Least squares on lags, with and without stock columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagfield.operators.learners import least_squares
from lagfield.operators.metrics import wape
from lagfield.operators.naive import complete, mean_12
from lagfield.operators.panel import lag_table
from lagfield.operators.relational import keep_ids, overridden
from lagfield.session import stored

LAGS = [f"tn_{n}" for n in range(12)]


def forecast_on_lags(
    history: DataFrame, train_anchor: int, score_anchor: int, cohort: DataFrame | None = None
) -> DataFrame:
    """Fit on one anchor month of a cohort, predict products with 12 rows of history.

    The rest take their 12-month mean. ``history`` keeps its gaps, so a lag is a
    row; ``cohort`` is a table of product ids, all products if left out.
    """
    table = lag_table(history)
    train = table.where(F.col("periodo") == train_anchor).dropna(subset=[*LAGS, "clase"])
    if cohort is not None:
        train = keep_ids(train, cohort, "product_id", ["product_id"])
    model = least_squares(stored(train, "ols-train"), LAGS, "clase")
    future = table.where((F.col("periodo") == score_anchor) & F.col("tn_11").isNotNull())
    predicted = model(future.dropna(subset=LAGS), "pred").select("product_id", F.col("pred").alias("tn"))
    return overridden(mean_12(history, score_anchor), predicted, ["product_id"], "tn")


# fixed values: the stock column groups that are tried
STOCK_GROUPS: dict[str, list[str]] = {
    "base": [],
    "stock_actual": ["stock_final"],
    "stock_cobertura": ["stock_cobertura_12"],
    "stock_actual_cobertura": ["stock_final", "stock_cobertura_12"],
    "stock_historia": [
        "stock_final", "stock_lag_1", "stock_lag_2", "stock_delta_1", "stock_cobertura_12", "stock_negativo",
    ],
}


def _fit_predict(table: DataFrame, train_anchor: int, score_anchor: int, features: Sequence[str]) -> DataFrame | None:
    train = table.where(F.col("periodo") == train_anchor).dropna(subset=[*features, "target"])
    score = table.where(F.col("periodo") == score_anchor).dropna(subset=list(features))
    if train.isEmpty() or score.isEmpty():
        return None
    predicted = least_squares(train, features, "target")(score, "pred")
    return predicted.withColumn("tn", F.greatest("pred", F.lit(0.0)))


def stock_group_search(
    table: DataFrame, train_anchor: int, val_anchor: int, groups: dict[str, list[str]] | None = None
) -> DataFrame:
    """WAPE of each stock group at the validation anchor, best first; groups without complete rows are left out."""
    kept = stored(table.where(F.col("periodo").isin(train_anchor, val_anchor)), "stock-search")
    lags = [f"lag_{n}" for n in range(12)]
    scores = []
    for name, extra in (groups or STOCK_GROUPS).items():
        predicted = _fit_predict(kept, train_anchor, val_anchor, lags + extra)
        if predicted is not None:
            row = wape(predicted.where(F.col("target").isNotNull()), "target", "tn").first()
            scores.append((name, float(row["wape"]), len(lags) + len(extra)))
    out = table.sparkSession.createDataFrame(scores, "stock_group string, wape double, n_features int")
    return out.orderBy("wape", "stock_group")


def stock_forecast(
    table: DataFrame,
    history: DataFrame,
    requested: DataFrame,
    select: tuple[int, int],
    final: tuple[int, int],
    groups: dict[str, list[str]] | None = None,
) -> tuple[str, DataFrame]:
    """Pick the best stock group on ``select`` anchors, refit on ``final``, complete the forecast."""
    names = groups or STOCK_GROUPS
    best = stock_group_search(table, *select, names).first()
    if best is None:
        raise ValueError("no stock group has complete rows")
    kept = stored(table.where(F.col("periodo").isin(*final)), "stock-final")
    lags = [f"lag_{n}" for n in range(12)]
    predicted = _fit_predict(kept, *final, lags + names[best["stock_group"]])
    if predicted is None:
        raise ValueError("no complete rows for the final fit")
    return best["stock_group"], complete(requested, predicted.select("product_id", "tn"), mean_12(history, final[1]))
