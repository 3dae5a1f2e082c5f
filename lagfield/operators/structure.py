"""Commercial structure of a product, from its customer series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagfield.functions import series as S
from lagfield.functions.scalars import ratio
from lagfield.operators import features as X
from lagfield.operators.features import FeatureSet
from lagfield.operators.panel import PAIR

# fixed values: structure columns and the lags they are taken at
CORE = (
    "cp_pairs", "cp_buyers", "cp_buyer_rate", "cp_tn_per_buyer",
    "cp_request_tn", "cp_fill_rate", "cp_hhi", "cp_top_share",
)
CORE_LAGS = (0, 1, 3, 12)
LIFECYCLE = (
    "cp_new_buyers", "cp_repeat_buyers", "cp_churned",
    "cp_regime0_share", "cp_regime1_share", "cp_regime2_share", "cp_regime3_share",
)
LIFECYCLE_LAGS = (0, 12)
# fixed values: most purchases that still count as regime 0, 1, 2
REGIME_LIMITS = (0, 2, 5)


def regime_of(purchases):
    """0 never, 1 up to two, 2 up to five, 3 more purchases."""
    never, few, some = REGIME_LIMITS
    return (
        F.when(purchases <= never, 0).when(purchases <= few, 1).when(purchases <= some, 2).otherwise(3)
    )


def lifecycle(panel: DataFrame) -> DataFrame:
    """New, repeat and churn flags and the running regime of each pair and month."""
    w = S.series(PAIR)
    df = panel.withColumn("buy", (F.col("tn") > 0).cast("int"))
    df = X.with_columns(
        df,
        {"buy_before": F.coalesce(S.lag("buy", 1, w), F.lit(0)), "buy_total": S.running_sum("buy", w)},
    )
    df = df.withColumn("prior_12", S.rolling("buy_before", "sum", 12, w, min_rows=1))
    buys, before = F.col("buy") == 1, F.col("prior_12") > 0
    return X.with_columns(
        df,
        {
            "is_new": (buys & ~before).cast("int"),
            "is_repeat": (buys & before).cast("int"),
            "is_churn": ((F.col("buy") == 0) & (F.col("buy_before") == 1)).cast("int"),
            "regime": regime_of(F.col("buy_total")),
        },
    )


def structure(panel: DataFrame) -> DataFrame:
    """Per product and month: buyers, concentration, fill rate, lifecycle and regime shares."""
    grouped = lifecycle(panel).groupBy("product_id", "periodo").agg(
        F.count(F.lit(1)).alias("cp_pairs"),
        F.sum("buy").alias("cp_buyers"),
        F.sum("tn").alias("_total"),
        F.max("tn").alias("_largest"),
        F.sum(F.col("tn") * F.col("tn")).alias("_squares"),
        F.sum("request_tn").alias("cp_request_tn"),
        F.sum("is_new").alias("cp_new_buyers"),
        F.sum("is_repeat").alias("cp_repeat_buyers"),
        F.sum("is_churn").alias("cp_churned"),
        *[F.count_if(F.col("regime") == r).alias(f"_regime{r}") for r in range(4)],
    )
    pairs = F.greatest("cp_pairs", F.lit(1))
    buyers = F.greatest("cp_buyers", F.lit(1))
    return grouped.select(
        "product_id",
        "periodo",
        "cp_pairs",
        "cp_buyers",
        (F.col("cp_buyers") / pairs).alias("cp_buyer_rate"),
        (F.col("_total") / buyers).alias("cp_tn_per_buyer"),
        "cp_request_tn",
        ratio("_total", "cp_request_tn").alias("cp_fill_rate"),
        ratio("_squares", F.col("_total") * F.col("_total")).alias("cp_hhi"),
        ratio("_largest", "_total").alias("cp_top_share"),
        "cp_new_buyers",
        "cp_repeat_buyers",
        "cp_churned",
        *[(F.col(f"_regime{r}") / pairs).alias(f"cp_regime{r}_share") for r in range(4)],
    )


def structure_lags(table: DataFrame) -> FeatureSet:
    """The structure columns at their lags within each product."""
    w = S.series(["product_id"])
    plan = [(c, n) for c in CORE for n in CORE_LAGS] + [(c, n) for c in LIFECYCLE for n in LIFECYCLE_LAGS]
    cols = {f"{c}_lag{n}": S.lag(c, n, w) for c, n in plan}
    out = X.with_columns(table, cols).select("product_id", "periodo", *cols)
    return FeatureSet(out, list(cols), [])
