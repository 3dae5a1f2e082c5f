"""Back-test several forecasters on the same windows and weight them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagfield.functions.periods import shift_period
from lagfield.operators.metrics import wape_of
from lagfield.session import stored

# A forecaster takes the history up to the anchor, and the anchor.
Forecaster = Callable[[DataFrame, int], DataFrame]


def backtest(
    history: DataFrame, forecasters: Mapping[str, Forecaster], anchors: Sequence[int], horizon: int = 2,
    keys: Sequence[str] = ("product_id",),
) -> DataFrame:
    """One row per anchor and series with the truth and a column per forecaster (missing = 0)."""
    out = None
    for anchor in anchors:
        past = history.where(F.col("periodo") <= anchor)
        real = history.where(F.col("periodo") == shift_period(anchor, horizon))
        rows = real.select(F.lit(anchor).alias("anchor"), *keys, F.col("tn").alias("tn_real"))
        for name, forecast in forecasters.items():
            pred = forecast(past, anchor).select(*keys, F.col("tn").alias(name))
            rows = rows.join(pred, list(keys), "left").withColumn(name, F.coalesce(name, F.lit(0.0)))
        out = rows if out is None else out.unionByName(rows)
    return out


def rmse_of(real: Column, pred: Column) -> Column:
    return F.sqrt(F.avg((real - pred) * (real - pred)))


METRICS = {"wape": wape_of, "rmse": rmse_of}


def leaderboard(results: DataFrame, models: Sequence[str], metric: str = "wape") -> DataFrame:
    """One row per model with its score over all windows, best first."""
    score = METRICS[metric]
    row = results.agg(*[score(F.col("tn_real"), F.col(m)).alias(m) for m in models])
    pairs = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("score")) for m in models])
    return row.select(F.inline(pairs)).orderBy("score", "model")


def ensemble_weights(results: DataFrame, models: Sequence[str], metric: str = "wape", rounds: int = 10) -> dict[str, float]:
    """Greedy weights: each round adds the model that helps the running mean most, repeats allowed.

    A round is one aggregate over the stored back-test with a sum per model.
    """
    kept = stored(results.select("tn_real", *models), "backtest")
    score = METRICS[metric]
    picks: list[str] = []
    best: tuple[float, list[str]] | None = None
    for size in range(1, rounds + 1):
        base = sum((F.col(p) for p in picks), F.lit(0.0))
        tries = [score(F.col("tn_real"), (base + F.col(m)) / size).alias(m) for m in models]
        row = kept.agg(*tries).first()
        winner = min(models, key=lambda m: (row[m], m))
        picks = [*picks, winner]
        if best is None or row[winner] < best[0]:
            best = (row[winner], picks)
    chosen = best[1]
    return {m: chosen.count(m) / len(chosen) for m in models if m in chosen}


def ensemble_forecast(
    history: DataFrame, forecasters: Mapping[str, Forecaster], weights: Mapping[str, float], anchor: int,
    keys: Sequence[str] = ("product_id",),
) -> DataFrame:
    """Weighted mean of the forecasts at the anchor."""
    past = history.where(F.col("periodo") <= anchor)
    out = None
    for name, weight in weights.items():
        part = forecasters[name](past, anchor).select(*keys, (F.col("tn") * weight).alias("tn"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy(*keys).agg(F.sum("tn").alias("tn"))
