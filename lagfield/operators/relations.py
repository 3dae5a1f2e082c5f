"""What a series' customer, product and category do as a whole: encoded targets, breadth, totals of every level.

All of it is built from tables with a row per key and month. Their windows run over one key's months, so they are as
long as the calendar, however many rows a key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagfield.functions import series as S
from lagfield.functions.periods import from_index, month_index
from lagfield.functions.scalars import ratio
from lagfield.operators.panel import PAIR
from lagfield.operators.relational import attach
from lagfield.session import stored

# fixed values: levels of the yearly comparison, the horizon of the target
LEVELS = ("cat1", "cat2", "cat3", "brand", "product_id", "customer_id")
UNIVERSE = "universe"
HORIZON = 2
SMOOTHING = 20.0


def _until_now(keys: Sequence[str]) -> Window:
    return Window.partitionBy(*keys).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)


def target_encoding(
    panel: DataFrame, keys: Sequence[str] = PAIR, horizon: int = HORIZON, smoothing: float = SMOOTHING, value: str = "tn"
) -> DataFrame:
    """Panel rows with ``te_<key>``: the mean target of the key's series over earlier months, drawn to the mean of all.

    The target of month s is the value ``horizon`` months later, so at month t the targets of months up to
    t - horizon are known and no others: a row never sees its own target or a later one. With n known targets of sum
    x and the mean m of all targets known by then, the encoding is (x + smoothing * m) / (n + smoothing); it is null
    as long as no target at all is known. ``panel`` has a row per customer, product and month without gaps.
    """
    row = S.series(PAIR)
    known = panel.select(*PAIR, (month_index("periodo")).alias("_at"), S.lag(value, horizon, row).isNotNull().alias("_old"), value)
    # a value is the target of the row ``horizon`` months before it, if the series had begun by then
    known = known.where(F.col("_old") & F.col(value).isNotNull())
    months = panel.select(month_index("periodo").alias("_at")).distinct()
    zero = [F.lit(0.0).alias("_x"), F.lit(0).cast("long").alias("_n")]
    per_month = known.groupBy("_at").agg(F.sum(value).alias("_x"), F.count(F.lit(1)).alias("_n")).unionByName(months.select("_at", *zero))
    per_month = per_month.groupBy("_at").agg(F.sum("_x").alias("_x"), F.sum("_n").alias("_n"))
    # one row per month of the calendar
    whole = per_month.select(
        "_at", F.try_divide(F.sum("_x").over(_until_now([])), F.sum("_n").over(_until_now([]))).alias("_mean")
    )
    out = panel.withColumn("_at", month_index("periodo"))
    for key in keys:
        seen = known.groupBy(key, "_at").agg(F.sum(value).alias("_x"), F.count(F.lit(1)).alias("_n"))
        # months in which the key has rows, but no target becomes known, carry its sums on
        asked = panel.select(key, month_index("periodo").alias("_at")).distinct()
        both = seen.unionByName(asked.select(key, "_at", *zero)).groupBy(key, "_at").agg(F.sum("_x").alias("_x"), F.sum("_n").alias("_n"))
        sums = both.select(key, "_at", *[F.sum(c).over(_until_now([key])).alias(c) for c in ("_x", "_n")])
        drawn = (F.col("_x") + F.lit(smoothing) * F.col("_mean")) / (F.col("_n") + F.lit(smoothing))
        side = sums.join(F.broadcast(whole), "_at").select(key, "_at", drawn.alias(f"te_{key}"))
        out = attach(out, stored(side, f"te-{key}"), [key, "_at"], [c for c in PAIR if c != key])
    return out.drop("_at")


def breadth(
    facts: DataFrame, key: str, partner: str, windows: Sequence[int] = (3, 12), prefix: str = "breadth", value: str = "tn"
) -> DataFrame:
    """Different partners a key traded with in the last w months, for each month of the key's life.

    Columns: the key, periodo, ``<prefix>_<w>`` and ``<prefix>_<w>_trend``, the change against w months before (null
    where the life is shorter). A distinct count cannot slide over a window, so intervals are counted: a purchase
    counts for w months, the purchases of a pair that follow within w months are one interval, and the number of
    open intervals is a running sum of +1 where one begins and -1 where it ends. Months without a purchase of ``key``
    count too; only positive values are purchases.
    """
    bought = facts.where(F.col(value) > 0).select(F.col(key), F.col(partner), month_index("periodo").alias("_at")).distinct()
    lives = facts.groupBy(key).agg(F.min(month_index("periodo")).alias("_from"), F.max(month_index("periodo")).alias("_to"))
    months = lives.select(key, F.explode(F.sequence("_from", "_to")).alias("_at"))
    pair = Window.partitionBy(key, partner).orderBy("_at")
    steps = months.select(key, "_at", *[F.lit(0).cast("long").alias(f"_w{w}") for w in windows])
    last, following = F.lag("_at").over(pair), F.lead("_at").over(pair)
    near = bought.select(key, "_at", (F.col("_at") - last).alias("_back"), (following - F.col("_at")).alias("_ahead"))
    events = []
    for w in windows:
        starts, ends = F.col("_back").isNull() | (F.col("_back") > w), F.col("_ahead").isNull() | (F.col("_ahead") > w)
        events += [(w, F.when(starts, F.col("_at")), 1), (w, F.when(ends, F.col("_at") + w), -1)]
    marks = F.array(*[F.struct(F.lit(w).alias("w"), at.alias("at"), F.lit(by).alias("by")) for w, at, by in events])
    marked = near.select(key, F.explode(marks).alias("m")).where("m.at is not null")
    changes = marked.groupBy(key, F.col("m.at").alias("_at")).agg(
        *[F.coalesce(F.sum(F.when(F.col("m.w") == w, F.col("m.by"))), F.lit(0)).alias(f"_w{w}") for w in windows]
    )
    # months of the life with the changes that fall into them; those behind its end are of no use
    joined = steps.unionByName(changes).groupBy(key, "_at").agg(*[F.sum(f"_w{w}").alias(f"_w{w}") for w in windows])
    run = joined.select(key, "_at", *[F.sum(f"_w{w}").over(_until_now([key])).alias(f"{prefix}_{w}") for w in windows])
    run = run.join(lives, key).where(F.col("_at") <= F.col("_to"))
    order = Window.partitionBy(key).orderBy("_at")
    trends = [(F.col(f"{prefix}_{w}") - F.lag(f"{prefix}_{w}", w).over(order)).alias(f"{prefix}_{w}_trend") for w in windows]
    return run.select(key, from_index("_at").alias("periodo"), *[f"{prefix}_{w}" for w in windows], *trends)


def level_totals(facts: DataFrame, products: DataFrame, levels: Sequence[str] = LEVELS, value: str = "tn") -> DataFrame:
    """``level, member, periodo, tn, tn_12, yoy``: monthly totals of the universe and of every level, in one pass.

    Grouping sets expand each fact once per level before the partial sums, so the facts are read and their category
    joined once. ``tn_12`` is the total twelve calendar months before, ``yoy`` their ratio; both are null without one.
    ``member`` is the value of the level as text; null members of a category (products without attributes) are one.
    """
    attributes = products.select("product_id", *[c for c in levels if c not in PAIR])
    sums = facts.groupBy(*PAIR, "periodo").agg(F.sum(value).alias("_value"))
    rows = attach(sums, attributes, ["product_id"], ["customer_id", "periodo"])
    sets = [[F.col("periodo")], *[[F.col("periodo"), F.col(c)] for c in levels]]
    totals = rows.groupingSets(sets, "periodo", *levels).agg(
        F.sum("_value").alias("tn"), *[F.grouping(c).alias(f"_no_{c}") for c in levels]
    )

    def pick(of, otherwise: Column) -> Column:
        out = otherwise
        for c in levels:
            out = F.when(F.col(f"_no_{c}") == 0, of(c)).otherwise(out)
        return out

    named = totals.select(
        pick(F.lit, F.lit(UNIVERSE)).alias("level"), pick(lambda c: F.col(c).cast("string"), F.lit(UNIVERSE)).alias("member"), "periodo", "tn"
    )
    year = Window.partitionBy("level", "member").orderBy(month_index("periodo")).rangeBetween(-12, -12)
    out = named.withColumn("tn_12", F.sum("tn").over(year))
    return out.withColumn("yoy", ratio("tn", "tn_12"))


def with_level_totals(pairs: DataFrame, totals: DataFrame, products: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """Rows of customer, product and month with the year-on-year ratio and their share of every level.

    The levels of a product are gathered in one table by product and month, so a large table of pairs meets two side
    tables, that and the customers', whatever the number of levels.
    """
    by_product = [c for c in levels if c != "customer_id"]
    own = pairs.select("product_id", "periodo").distinct().join(products.select("product_id", *[c for c in levels if c not in PAIR]), "product_id", "left")
    members = F.array(
        F.struct(F.lit(UNIVERSE).alias("level"), F.lit(UNIVERSE).alias("member")),
        *[F.struct(F.lit(c).alias("level"), F.col(c).cast("string").alias("member")) for c in by_product],
    )
    asked = own.select("product_id", "periodo", F.inline(members))
    met = asked.alias("q").join(
        totals.alias("t"),
        (F.col("q.level") == F.col("t.level")) & (F.col("q.periodo") == F.col("t.periodo")) & F.col("q.member").eqNullSafe(F.col("t.member")),
    )
    value = lambda c, x: F.max(F.when(F.col("q.level") == c, F.col(f"t.{x}")))
    names = [UNIVERSE, *by_product]
    side = met.groupBy("q.product_id", "q.periodo").agg(
        *[value(c, x).alias(f"{x}_{c}") for c in names for x in ("tn", "yoy")]
    )
    out = attach(pairs, stored(side, "level-products"), ["product_id", "periodo"], ["customer_id"])
    if "customer_id" in levels:
        names = [*names, "customer_id"]
        side = totals.where("level = 'customer_id' and member is not null").select(
            F.col("member").alias("_member"), "periodo", F.col("tn").alias("tn_customer_id"), F.col("yoy").alias("yoy_customer_id")
        )
        out = attach(out.withColumn("_member", F.col("customer_id").cast("string")), stored(side, "level-customers"), ["_member", "periodo"], ["product_id"])
    shares = [ratio("tn", f"tn_{c}").alias(f"share_{c}") for c in names]
    return out.select(*PAIR, "periodo", "tn", *[f"yoy_{c}" for c in names], *shares)


def plan_months(panel: DataFrame) -> DataFrame:
    """Panel rows with ``trimestre``, the quarter, and ``meses_en_plan``, the months in the plan up to the row's."""
    row = S.series(PAIR)
    quarter = F.floor((F.col("periodo") % 100 - 1) / 3) + 1
    return panel.select("*", quarter.cast("int").alias("trimestre"), S.running_sum("plan_flag", row).cast("long").alias("meses_en_plan"))
