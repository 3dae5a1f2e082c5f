"""Exploratory market-share and concentration queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagfield.functions.periods import to_month_start, year_of
from lagfield.functions.scalars import joined_text
from lagfield.operators.relational import SMALL_ROWS, attach, grand_total, running_by_value
from lagfield.session import stored


def in_year(facts: DataFrame, year: int) -> DataFrame:
    return facts.where(F.col("periodo").between(year * 100 + 1, year * 100 + 12))


def monthly_sales(facts: DataFrame) -> DataFrame:
    return facts.groupBy("periodo").agg(F.sum("tn").alias("tn"))


def yearly_sales(facts: DataFrame) -> DataFrame:
    return facts.groupBy(year_of("periodo").alias("anio")).agg(F.round(F.sum("tn")).alias("tn"))


def trend(facts: DataFrame) -> DataFrame:
    """Least-squares line through the monthly totals; x is days since 1970."""
    days = F.unix_date(to_month_start("periodo")).cast("double")
    points = monthly_sales(facts).select(days.alias("x"), F.col("tn").alias("y"))
    return points.agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("r2"),
    )


def share_of_total(facts: DataFrame, key: str) -> DataFrame:
    """Sum and percentage of the grand total per key."""
    sums = facts.groupBy(key).agg(F.sum("tn").alias("tn"))
    total = grand_total(facts, "tn")
    return sums.select(key, "tn", F.try_divide(F.col("tn") * 100.0, total).alias("tn_pct"))


def distinct_count(facts: DataFrame, key: str) -> DataFrame:
    return facts.agg(F.count_distinct(key).alias("n"))


def with_running_share(shares: DataFrame, key: str, limit: int = SMALL_ROWS) -> DataFrame:
    """Cumulative percentage from the largest down; equal shares get the same value."""
    run = running_by_value(shares, "tn_pct", {"pct": F.sum("tn_pct")}, descending=True, limit=limit)
    side = stored(run.select("tn_pct", F.col("run_pct").alias("tn_pct_acumulado")), "running-share")
    return attach(shares, side, ["tn_pct"], [key], limit=limit)


def largest(shares: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The ``n`` largest with their place and running share.

    Only values at or above the last one are summed; there are at most ``n`` of them.
    """
    kept = stored(shares, "shares")
    top = kept.orderBy(F.col("tn").desc(), key).limit(n)
    values = kept.where(F.col("tn_pct") >= top.agg(F.min("tn_pct")).scalar()).groupBy("tn_pct").agg(F.sum("tn_pct").alias("_s"))
    run = values.select("tn_pct", F.sum("_s").over(Window.orderBy(F.col("tn_pct").desc())).alias("tn_pct_acumulado"))
    place = F.row_number().over(Window.orderBy(F.col("tn").desc(), key))
    return top.join(F.broadcast(run), "tn_pct", "left").withColumn("puesto", place)


def smallest(shares: DataFrame, key: str, n: int = 300) -> DataFrame:
    """The ``n`` smallest, with their place and running share counted from the largest.

    The running share is the total less the values below, of which there are at most ``n``.
    """
    kept = stored(shares, "shares")
    low = kept.orderBy(F.col("tn").asc(), F.col(key).desc()).limit(n)
    values = kept.where(F.col("tn_pct") <= low.agg(F.max("tn_pct")).scalar()).groupBy("tn_pct").agg(F.sum("tn_pct").alias("_s"))
    below = F.coalesce(F.sum("_s").over(Window.orderBy("tn_pct").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    total = kept.agg(F.sum("tn_pct")).scalar()
    run = values.select("tn_pct", below.alias("_below"))
    from_end = F.row_number().over(Window.orderBy(F.col("tn").asc(), F.col(key).desc()))
    rows = kept.agg(F.count(F.lit(1))).scalar()
    out = low.join(F.broadcast(run), "tn_pct", "left").withColumn("tn_pct_acumulado", total - F.col("_below"))
    return out.drop("_below").withColumn("puesto", (rows + 1 - from_end).cast("int"))


def history_completeness(facts: DataFrame, requested: DataFrame, year: int) -> DataFrame:
    """Requested products by months sold in the year: all twelve, fewer, none."""
    months = in_year(facts, year).groupBy("product_id").agg(F.count_distinct("periodo").alias("meses"))
    group = (
        F.when(F.col("meses") == 12, "12 meses (completo)")
        .when(F.col("meses").isNull(), "sin ventas")
        .otherwise("<12 meses (hueco/nuevo)")
    )
    joined = requested.join(months, "product_id", "left")
    return joined.groupBy(group.alias("grupo")).agg(F.count(F.lit(1)).alias("cant"))


def pareto(facts: DataFrame, year: int, thresholds: Sequence[int] = (50, 80, 90), limit: int = SMALL_ROWS) -> DataFrame:
    """How many products reach each percentage of the year's sales."""
    sums = in_year(facts, year).groupBy("product_id").agg(F.sum("tn").alias("tn"))
    run = running_by_value(
        sums, "tn", {"n": F.count(F.lit(1)), "total": F.sum("tn")}, descending=True, limit=limit
    )
    run = stored(run, "pareto")
    total, count = grand_total(run, "total"), grand_total(run, "n")
    pct = F.try_divide(100.0 * F.col("run_total"), total)
    within = [
        F.struct(F.lit(t).alias("umbral"), F.sum(F.when(F.col("pct") <= t, F.col("n"))).alias("below"))
        for t in thresholds
    ]
    counted = run.select("n", pct.alias("pct")).agg(F.array(*within).alias("rows")).select(F.inline("rows"))
    # a threshold that no product stays below has no row
    need = F.col("below") + 1
    return counted.where(F.col("below").isNotNull()).select(
        F.concat(F.col("umbral").cast("string"), F.lit("% de las tn")).alias("cubre"),
        need.alias("productos"),
        F.round(100.0 * need / count, 1).alias("pct_catalogo"),
    )


def skew(facts: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Mean, exact median, their ratio and the maximum of product-month sales."""
    sums = facts.groupBy("product_id", "periodo").agg(F.sum("tn").alias("tn"))
    run = running_by_value(sums, "tn", {"n": F.count(F.lit(1))}, limit=limit)
    count = run.agg(F.sum("n")).first()[0] or 0
    low, high = (count - 1) // 2, count // 2
    median = (
        F.min(F.when(F.col("run_n") > low, F.col("tn"))) + F.min(F.when(F.col("run_n") > high, F.col("tn")))
    ) / 2
    row = run.agg(
        (F.sum(F.col("tn") * F.col("n")) / F.sum("n")).alias("mean"), median.alias("median"), F.max("tn").alias("max")
    )
    return row.select(
        F.round("mean", 1).alias("media"),
        F.round("median", 1).alias("mediana"),
        F.round(F.try_divide("mean", "median"), 1).alias("ratio"),
        F.round("max", 0).alias("maximo"),
    )


def histogram(facts: DataFrame, bins: int = 100) -> DataFrame:
    """Equal-width counts of product-month sales between their minimum and maximum."""
    sums = facts.groupBy("product_id", "periodo").agg(F.sum("tn").alias("tn"))
    low, high = sums.agg(F.min("tn"), F.max("tn")).first()
    if low is None or low == high:
        return sums.groupBy(F.lit(1).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (high - low) / bins
    spot = F.least(F.floor((F.col("tn") - F.lit(low)) / F.lit(width)) + 1, F.lit(bins))
    return sums.groupBy(spot.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def series_of(facts: DataFrame, key: str, ids: Sequence[int]) -> DataFrame:
    """Monthly sums of some customers or products, one line each."""
    return facts.where(F.col(key).isin(list(ids))).groupBy(key, "periodo").agg(F.sum("tn").alias("tn"))


def joint_series(facts: DataFrame, key: str, ids: Sequence[int]) -> DataFrame:
    """Monthly sums of some customers or products taken together."""
    return facts.where(F.col(key).isin(list(ids))).groupBy("periodo").agg(F.sum("tn").alias("tn"))


def attributes_where(products: DataFrame, **equal) -> DataFrame:
    """Attribute rows by column value, or by several with a list."""
    out = products
    for name, wanted in equal.items():
        many = isinstance(wanted, (list, tuple, set))
        out = out.where(F.col(name).isin(list(wanted)) if many else F.col(name) == wanted)
    return out


def labelled_series(facts: DataFrame, products: DataFrame, product_id: int) -> DataFrame:
    """One product's monthly series with its attributes as a label."""
    label = products.where(F.col("product_id") == product_id).select("product_id", joined_text(products).alias("titulo"))
    sums = facts.where(F.col("product_id") == product_id).groupBy("product_id", "periodo").agg(F.sum("tn").alias("tn"))
    return sums.join(label, "product_id").select("periodo", "tn", "titulo")
