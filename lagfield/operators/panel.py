"""Regular monthly panels from sales facts.

Facts have one or more rows per ``customer_id, product_id, periodo`` with a
``plan_flag`` and the measures ``request_tn`` and ``tn``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagfield.functions import series as S
from lagfield.functions.periods import from_index, month_index, shift_period
from lagfield.functions.scalars import hash_order
from lagfield.operators.relational import every_salt, keep_ids, last_per_key, shuffle_width

PAIR = ("customer_id", "product_id")
GRAIN = (*PAIR, "periodo")
MEASURES = ("request_tn", "tn")
# pairs of a full part; of one whose rows are sorted in memory with all that is joined to them
PART_PAIRS = 20_000
SORTED_PAIRS = 4_000


def monthly_total(facts: DataFrame, keys: Sequence[str] = ("product_id",), value: str = "tn") -> DataFrame:
    """Sum of ``value`` per key and month."""
    return facts.groupBy(*keys, "periodo").agg(F.sum(value).alias(value))


def one_row_per_month(facts: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Collapse repeated facts: measures are summed, the plan flag is the maximum."""
    sums = [F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in measures]
    return facts.groupBy(*GRAIN).agg(F.max("plan_flag").alias("plan_flag"), *sums)


def densify(df: DataFrame, keys: Sequence[str], value: str = "tn", until: int | None = None) -> DataFrame:
    """Fill the months between a key's first and last row with zero.

    Needs one row per key and month. Each row is followed by the months missing
    before the next one, so a single window does it, without a calendar join.
    ``until`` carries every series on to that month.
    """
    w = S.series(keys)
    at = month_index("periodo")
    tail = F.lit(1) if until is None else F.greatest(month_index(F.lit(until)) - at + 1, F.lit(1))
    gap = F.coalesce(F.lead(at).over(w) - at, tail)
    spread = df.select(*keys, at.alias("_at"), F.col(value).alias("_value"), gap.alias("_gap"))
    filled = spread.select(
        *keys, "_at", "_value", F.explode(F.sequence(F.lit(0), F.col("_gap") - 1)).alias("_step")
    )
    return filled.select(
        *keys,
        from_index(F.col("_at") + F.col("_step")).alias("periodo"),
        F.when(F.col("_step") == 0, F.coalesce("_value", F.lit(0.0))).otherwise(F.lit(0.0)).alias(value),
    )


def product_history(facts: DataFrame, requested: DataFrame | None = None, keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """Gap-free monthly series per key, for the requested products."""
    totals = monthly_total(facts, keys)
    if requested is not None:
        totals = keep_ids(totals, requested, "product_id", ["periodo", *keys])
    return densify(totals, keys)


def product_life(facts: DataFrame) -> DataFrame:
    """First and last month of each product and of its plan, null if never in the plan."""
    in_plan = F.when(F.col("plan_flag") == 1, F.col("periodo"))
    return facts.groupBy("product_id").agg(
        F.min("periodo").alias("born"),
        F.max("periodo").alias("died"),
        F.min(in_plan).alias("plan_from"),
        F.max(in_plan).alias("plan_to"),
    )


def customer_start(facts: DataFrame) -> DataFrame:
    return facts.groupBy("customer_id").agg(F.min("periodo").alias("started"))


def plan_flag_in_window(period: Column) -> Column:
    """1 between the first and last plan month of the product, else 0."""
    return F.coalesce(period.between(F.col("plan_from"), F.col("plan_to")), F.lit(False)).cast("int")


def life_grid(facts: DataFrame) -> DataFrame:
    """Every customer x product x month with the product alive and the customer started.

    Products by month and customers by month meet on the month, plus a bucket of
    the customer that splits a month over many tasks. The partition number is
    explicit because the rows multiply after the shuffle, which adaptive
    coalescing by input size does not see. Only months that occur in the facts
    are used.
    """
    width = shuffle_width(facts)
    buckets = max(1, width // 8)
    months = facts.select("periodo").distinct()
    last = facts.select(F.max(month_index("periodo"))).scalar()

    alive = product_life(facts).withColumn(
        "periodo", F.explode(F.sequence(month_index("born"), month_index("died")))
    )
    alive = alive.withColumn("periodo", from_index("periodo")).join(months, "periodo", "left_semi")
    products = alive.select(
        "product_id", "periodo", plan_flag_in_window(F.col("periodo")).alias("plan_flag")
    ).withColumn("_bucket", every_salt(buckets))

    customers = customer_start(facts).select(
        "customer_id",
        F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).alias("_bucket"),
        F.explode(F.sequence(month_index("started"), last)).alias("periodo"),
    ).withColumn("periodo", from_index("periodo"))
    on = ["periodo", "_bucket"]
    grid = products.repartition(width, *on).join(customers.repartition(width, *on), on)
    return grid.select(*GRAIN, "plan_flag")


def pair_life(facts: DataFrame, cut: int | None = None) -> DataFrame:
    """Every customer and product with common months, and how many they have: the grid counted, not made.

    A pair lives from the later of the product's first and the customer's first month to the product's last, or the
    cut. ``observed_months`` counts the months of the facts in between, as the difference of two places in their
    order, so the calendar is not expanded.
    """
    width = shuffle_width(facts)
    buckets = max(1, width)
    rows = facts if cut is None else facts.where(F.col("periodo") <= cut)
    # one row per month of the calendar, so one task and a broadcast are enough
    months = facts.select("periodo").distinct()
    places = months.select("periodo", F.row_number().over(Window.orderBy("periodo")).alias("_place"))
    place = lambda of, name: places.select(F.col("periodo").alias(of), F.col("_place").alias(name))
    alive = product_life(facts).select("product_id", "born", "died")
    if cut is not None:  # a life may end behind it
        last = months.where(F.col("periodo") <= cut).select(F.max("periodo")).scalar()
        alive = alive.withColumn("died", F.least("died", last))
    alive = alive.where(F.col("born") <= F.col("died"))
    alive = alive.join(F.broadcast(place("born", "_born")), "born").join(F.broadcast(place("died", "_died")), "died")
    alive = alive.select("product_id", "_born", "_died").withColumn("_bucket", every_salt(buckets))
    started = customer_start(rows).join(F.broadcast(place("started", "_started")), "started").select(
        "customer_id", "_started", F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).alias("_bucket")
    )
    pairs = alive.repartition(width, "_bucket").join(started.repartition(width, "_bucket"), "_bucket")
    lived = F.col("_died") - F.greatest("_born", "_started") + 1
    return pairs.where(lived > 0).select(*PAIR, lived.cast("long").alias("observed_months"))


def zero_rows(facts: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Grid rows that have no fact, with zero measures."""
    missing = life_grid(facts).join(facts.select(*GRAIN).distinct(), list(GRAIN), "left_anti")
    return missing.select(*GRAIN, "plan_flag", *[F.lit(0.0).alias(m) for m in measures])


def zero_fill(facts: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """All facts, repeated ones included, plus a zero row for each empty grid cell."""
    cols = [*GRAIN, "plan_flag", *measures]
    return facts.select(*cols).unionByName(zero_rows(facts, measures).select(*cols))


def pair_panel(facts: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """Zero-filled panel with one row per customer, product and month.

    Equals :func:`zero_fill` followed by :func:`one_row_per_month`. Facts are
    collapsed first; facts and grid are then shuffled once by pair, and that
    layout serves both the merge and the later windows over the pair.
    """
    have = one_row_per_month(facts, measures).withColumn("_own", F.col("plan_flag"))
    grid = life_grid(facts).select("*", F.lit(None).cast("int").alias("_own"))
    both = have.drop("plan_flag").unionByName(
        grid.withColumnRenamed("plan_flag", "_window"), allowMissingColumns=True
    )
    return (
        both.repartition(*PAIR)
        .groupBy(*GRAIN)
        .agg(
            F.coalesce(F.max("_own"), F.max("_window")).alias("plan_flag"),
            *[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in measures],
        )
    )


def packed_panel(
    facts: DataFrame, measures: Sequence[str] = MEASURES, parts: int | None = None, keys: Sequence[str] = PAIR
) -> DataFrame:
    """:func:`pair_panel` with one row per customer and product, its months as the array ``_rows``.

    The months of a pair are a slice of the calendar, so only pairs and facts are shuffled, once, and not the grid,
    which is many times as long. An array is as long as the life of the pair. Stored bucketed by the pair, every window
    and aggregate over the pair is spared a shuffle; :func:`unpacked` gives the panel. ``keys`` lay out the rows: the pair,
    or the product, whose layout serves the pair too.
    """
    width = shuffle_width(facts)
    # one value per month of the calendar
    calendar = sorted(r[0] for r in facts.select("periodo").distinct().collect() if r[0] is not None)
    months = F.array(*[F.lit(m) for m in calendar]).cast("array<int>")
    place = lambda of: F.array_position(months, F.col(of).cast("int"))
    alive = product_life(facts).where(F.col("born").isNotNull())
    alive = alive.select("product_id", "plan_from", "plan_to", place("born").alias("_born"), place("died").alias("_died"))
    started = customer_start(facts).where(F.col("started").isNotNull())
    buckets = max(1, width // 8)
    customers = started.select(
        "customer_id", place("started").alias("_started"), F.pmod(F.xxhash64("customer_id"), F.lit(buckets)).alias("_bucket")
    )
    products = alive.withColumn("_bucket", every_salt(buckets))
    pairs = products.repartition(width, "_bucket").join(customers.repartition(width, "_bucket"), "_bucket")
    first = F.greatest("_born", "_started")
    lived = (F.col("_died") - first + 1).cast("int")
    grid = pairs.where(lived > 0).select(
        *PAIR, F.lit(True).alias("_grid"), first.cast("int").alias("_first"), lived.alias("_lived"), "plan_from", "plan_to"
    )
    life = ("_first", "_lived", "plan_from", "plan_to")
    rows = facts.select(*GRAIN, "plan_flag", *measures, F.lit(False).alias("_grid")).unionByName(grid, allowMissingColumns=True)
    have = rows.repartition(parts or width, *keys).groupBy(*GRAIN, "_grid").agg(
        F.max("plan_flag").alias("plan_flag"), *[F.coalesce(F.sum(m), F.lit(0.0)).alias(m) for m in measures],
        *[F.max(c).alias(c) for c in life],
    )
    fact = F.when(~F.col("_grid"), F.struct("periodo", "plan_flag", *measures))
    both = have.groupBy(*PAIR).agg(
        F.collect_list(fact).alias("_facts"), *[F.max(c).alias(c) for c in life]
    )
    own = F.transform("_facts", lambda f: F.struct(
        f["periodo"].alias("periodo"),
        F.coalesce(f["plan_flag"], F.when(f["periodo"].isNotNull(), plan_flag_in_window(f["periodo"]))).alias("plan_flag"),
        *[f[m].alias(m) for m in measures],
    ))
    # a pair without a life has only the facts that it has
    lived = F.slice(months, F.coalesce("_first", F.lit(1)), F.coalesce("_lived", F.lit(0)))
    missing = F.array_except(lived, F.col("_facts.periodo"))
    zeros = F.transform(missing, lambda m: F.struct(
        m.alias("periodo"), plan_flag_in_window(m).alias("plan_flag"), *[F.lit(0.0).alias(x) for x in measures]
    ))
    return both.select(*PAIR, F.concat(own, zeros).alias("_rows"))


def pair_parts(facts: DataFrame, full: int = PART_PAIRS) -> int:
    """Parts of a table with a row per pair: a matter of their number, which is at most products times customers."""
    counts = facts.agg(*[F.count_distinct(k).alias(k) for k in PAIR]).first()
    pairs = counts[0] * counts[1]
    return max(min(shuffle_width(facts), pairs // 500 + 1), pairs // full + 1)


def fits_by_product(facts: DataFrame) -> bool:
    """True when the pairs of a product fit a part, so that a panel may be laid out by product.

    Every product meets at most all customers.
    """
    return facts.agg(F.count_distinct("customer_id")).first()[0] <= PART_PAIRS


def unpacked(packed: DataFrame, measures: Sequence[str] = MEASURES) -> DataFrame:
    """The rows of a :func:`packed_panel`."""
    return packed.select(*PAIR, F.explode("_rows").alias("_row")).select(
        *PAIR, *[F.col(f"_row.{c}").alias(c) for c in ("periodo", "plan_flag", *measures)]
    )


def lag_table(
    df: DataFrame,
    keys: Sequence[str] = ("product_id",),
    value: str = "tn",
    lags: int = 12,
    horizon: int = 2,
    prefix: str = "tn_",
    target: str = "clase",
) -> DataFrame:
    """Lags 0..``lags``-1 and the value ``horizon`` rows ahead, counted in rows of the series.

    On facts with gaps a row is not a month; use :func:`calendar_lag_table` there
    if months are meant.
    """
    w = S.series(keys)
    return df.select(
        *keys,
        "periodo",
        S.lag(value, -horizon, w).alias(target),
        *[S.lag(value, n, w).alias(f"{prefix}{n}") for n in range(lags)],
    )


def calendar_lag_table(df: DataFrame, keys: Sequence[str] = ("product_id",), value: str = "tn", **options) -> DataFrame:
    """:func:`lag_table` on the gap-free series, so a lag is a month."""
    return lag_table(densify(df, keys, value), keys, value, **options)


def training_rows(table: DataFrame, anchor: int, horizon: int = 2, target: str = "target") -> DataFrame:
    """Rows whose target was already known at the anchor."""
    return table.where((F.col("periodo") <= shift_period(anchor, -horizon)) & F.col(target).isNotNull())


def split_counts(table: DataFrame, anchors: Sequence[int], horizon: int = 2, target: str = "target") -> DataFrame:
    """Training and validation rows of each anchor, counted in one pass."""
    known = F.col(target).isNotNull()
    counts = [
        F.struct(
            F.lit(a).alias("anchor"),
            F.count_if((F.col("periodo") <= shift_period(a, -horizon)) & known).alias("train_rows"),
            F.count_if((F.col("periodo") == a) & known).alias("val_rows"),
        )
        for a in anchors
    ]
    return table.agg(F.array(*counts).alias("rows")).select(F.inline("rows"))


def anchor_rows(table: DataFrame, anchor: int, target: str | None = "target") -> DataFrame:
    rows = table.where(F.col("periodo") == anchor)
    return rows if target is None else rows.where(F.col(target).isNotNull())


def sample_products(panel: DataFrame, n: int, seed: int = 1) -> DataFrame:
    """All rows of ``n`` products picked by a seeded hash of the id."""
    ids = panel.select("product_id").distinct().orderBy(hash_order(["product_id"], seed), "product_id").limit(n)
    return keep_ids(panel, ids, "product_id", ["periodo", *[c for c in PAIR if c in panel.columns]])


def last_observed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Last row of each series."""
    return last_per_key(df, keys, "periodo")
