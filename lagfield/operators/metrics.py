"""Volume-weighted error, calibration and model ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagfield.functions.periods import add_months, as_col
from lagfield.operators.relational import smallest_row

# fixed values: calibration grid and selection weights
SCALE_FROM, SCALE_TO, SCALE_STEP = 0.30, 1.30, 0.01
SEASON_WEIGHT, CONTROL_WEIGHT = 0.7, 0.3


def wape_of(real: Column | str, pred: Column | str) -> Column:
    """Aggregate: summed absolute error over summed truth; NaN unless the truth is positive."""
    y, p = as_col(real), as_col(pred)
    total = F.sum(y)
    return F.when(total > 0, F.sum(F.abs(y - p)) / total).otherwise(F.lit(float("nan")))


def wape(df: DataFrame, real: str = "tn_real", pred: str = "tn", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(wape_of(real, pred).alias("wape"))


def total_error_rate(pred: DataFrame, real: DataFrame, key: str = "product_id") -> DataFrame:
    """WAPE over the products of ``real``; a missing prediction counts as 0."""
    joined = real.join(pred.select(key, "tn"), key, "left")
    return joined.agg(wape_of("tn_real", F.coalesce("tn", F.lit(0.0))).alias("wape"))


def product_wape(df: DataFrame, pred: str = "pred_tn", real: str = "target_tn") -> DataFrame:
    """WAPE after summing customers to products."""
    products = df.groupBy("product_id").agg(F.sum(pred).alias("tn"), F.sum(real).alias("tn_real"))
    return wape(products)


def pooled_wape(predictions: DataFrame, truth: DataFrame, horizon: int = 2, pred: str = "pred_tn") -> DataFrame:
    """Product WAPE pooled over anchors; truth is joined on the target month."""
    summed = predictions.groupBy(
        "product_id", add_months("periodo", horizon).alias("target_period")
    ).agg(F.sum(pred).alias("tn"))
    real = truth.select("product_id", F.col("periodo").alias("target_period"), F.col("tn").alias("tn_real"))
    return wape(summed.join(real, ["product_id", "target_period"]))


def scale_grid() -> list[float]:
    steps = round((SCALE_TO - SCALE_FROM) / SCALE_STEP)
    return [SCALE_FROM + i * SCALE_STEP for i in range(steps + 1)]


def scale_scores(df: DataFrame, real: str = "tn_real", pred: str = "tn") -> DataFrame:
    """WAPE for every scale of the grid; each task keeps one running sum per scale."""
    each = F.explode(F.array(*[F.lit(s) for s in scale_grid()])).alias("scale")
    rows = df.select(F.col(real).alias("_real"), F.col(pred).alias("_pred"), each)
    return rows.groupBy("scale").agg(wape_of("_real", F.col("_pred") * F.col("scale")).alias("wape"))


def best_scale(df: DataFrame, real: str = "tn_real", pred: str = "tn") -> DataFrame:
    """The first scale with the smallest WAPE."""
    return smallest_row(scale_scores(df, real, pred), "scale", "wape")


def median_scale(calibrations: DataFrame, by: Sequence[str] = ("variant",)) -> DataFrame:
    """Median calibration over the validations of a variant."""
    return calibrations.groupBy(*by).agg(F.percentile("calibration", F.lit(0.5)).alias("calibration"))


def selection_scores(
    runs: DataFrame,
    season: str | int,
    control: str | int,
    by: Sequence[str] = ("candidate",),
    anchor: str = "anchor",
    weights: tuple[float, float] = (SEASON_WEIGHT, CONTROL_WEIGHT),
) -> DataFrame:
    """One row per candidate: its two scores side by side and their weighted score."""
    wide = runs.groupBy(*by).pivot(anchor, [season, control]).agg(F.first("wape"))
    wide = wide.withColumnRenamed(str(season), "season").withColumnRenamed(str(control), "control")
    score = F.col("season") * weights[0] + F.col("control") * weights[1]
    return wide.withColumn("score_seleccion", score)


def run_statistics(train: DataFrame, score: DataFrame, flag: str | None = None) -> dict:
    """Row counts, and the rate of a 0/1 column of the training rows."""
    cols = [F.count(F.lit(1)).alias("n")] + ([F.avg(flag).alias("rate")] if flag else [])
    row = train.agg(*cols).first()
    out = {"train_rows": row["n"], "val_rows": score.count()}
    if flag:
        out["positive_rate"] = row["rate"]
    return out


def changed_features(full: DataFrame, cut: DataFrame, keys: Sequence[str], features: Sequence[str], tol: float = 1e-9) -> DataFrame:
    """Leakage check: count, per feature, the rows that differ between two builds at one month.

    ``cut`` is built after the future is removed, so every count must be 0.
    """
    left = full.select(*keys, *[F.col(f).alias(f"_a_{f}") for f in features])
    right = cut.select(*keys, *[F.col(f).alias(f"_b_{f}") for f in features], F.lit(1).alias("_there"))
    joined = left.join(right, list(keys), "full")

    def differs(f: str) -> Column:
        a, b = F.col(f"_a_{f}").cast("double"), F.col(f"_b_{f}").cast("double")
        same = (a.isNull() & b.isNull()) | F.coalesce(F.abs(a - b) <= tol * F.greatest(F.lit(1.0), F.abs(a)), F.lit(False))
        return F.count_if(~same | F.col("_there").isNull())

    row = joined.agg(*[differs(f).alias(f) for f in features])
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("changed")) for f in features])
    return row.select(F.inline(pairs))
