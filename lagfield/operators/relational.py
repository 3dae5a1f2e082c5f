"""Joins, ranks and running totals that stay whole and spread under skew."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagfield.session import stored

# A side is broadcast, and a global window is run in one task, only when a count
# shows it has at most this many rows.
SMALL_ROWS = 200_000
# Distinct values looked at to place the bucket bounds of a distributed running sum.
BOUND_SAMPLE = 8_192
# Stands between a column name and a category; sorts before any printable text.
_MARK = "\u0001"


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def is_small(side: DataFrame, limit: int = SMALL_ROWS) -> bool:
    """True when ``side`` has at most ``limit`` rows; reads no more than that."""
    return side.limit(limit + 1).count() <= limit


def salt_count(df: DataFrame) -> int:
    return max(2, min(64, shuffle_width(df) // 4))


def every_salt(salts: int) -> Column:
    """Repeats a row once for each salt value."""
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))


def attach(
    big: DataFrame,
    side: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "left",
    limit: int = SMALL_ROWS,
) -> DataFrame:
    """Join a large table with a keyed side table (unique on ``on``).

    A side counted as small is broadcast. A larger one never is: the size that Spark takes from its compressed files,
    before its rows are unpacked or repeated, says little, so the merge join is named. Adaptive execution splits the
    partition of a key that holds a third of the rows; where it is off, the join goes by the key plus a salt taken from
    the ``spread`` columns of the large table. ``how`` is ``left``, ``inner``, ``left_semi`` or ``left_anti``. Give a
    stored table as ``side`` when it is costly, as the check counts it.
    """
    keys = list(on)
    if is_small(side, limit):
        return big.join(F.broadcast(side), keys, how)
    if splits_skew(big):
        return big.join(side.hint("merge"), keys, how)
    salts = salt_count(big)
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
    copies = side.withColumn("_salt", every_salt(salts))
    return salted.join(copies.hint("merge"), [*keys, "_salt"], how).drop("_salt")


def attach_in_place(big: DataFrame, side: DataFrame, key: str, also: str, limit: int = SMALL_ROWS) -> DataFrame:
    """Left join on ``key`` and ``also`` of a large table that lies by ``key``, without moving its rows.

    ``side`` is unique on both. A side that is not small is shuffled to the parts of the large table. For that only ``key``
    may be a join key, so ``also`` is compared among the few side rows of a key.
    """
    if is_small(side, limit):
        return big.join(F.broadcast(side), [key, also], "left")
    near = side.withColumnsRenamed({key: "_near", also: "_also"})
    # two bounds, as an equality would be taken for a join key
    same = (F.col(key) == F.col("_near")) & (F.col(also) >= F.col("_also")) & (F.col(also) <= F.col("_also"))
    return big.join(near.hint("shuffle_hash"), same, "left").drop("_near", "_also")


def splits_skew(df: DataFrame) -> bool:
    """True when adaptive execution splits the skewed partitions of a merge join."""
    conf = df.sparkSession.conf
    names = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    return all(conf.get(n).lower() == "true" for n in names)


def keep_ids(df: DataFrame, ids: DataFrame, on: str, spread: Sequence[str], limit: int = SMALL_ROWS) -> DataFrame:
    """Rows whose id is in ``ids`` (each row once)."""
    return attach(df, ids.select(on).distinct(), [on], spread, "left_semi", limit)


def without_keys(df: DataFrame, done: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows with no match in ``done`` on the keys: set difference, resume of unfinished work."""
    return df.join(done.select(*on).distinct(), list(on), "left_anti")


def overridden(base: DataFrame, update: DataFrame, on: Sequence[str], value: str) -> DataFrame:
    """Base rows, with ``value`` replaced where the update has one."""
    newer = update.select(*on, F.col(value).alias("_new"))
    joined = base.join(newer, list(on), "left")
    return joined.withColumn(value, F.coalesce("_new", value)).drop("_new")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in ``order``.

    Runs as an aggregate, so copies of a hot key are reduced before the shuffle.
    Columns outside keys and order break ties, which makes the pick repeatable.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order, *rest)
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def last_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key, the one with the largest ``order`` value."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(order, *[c for c in rest if c != order])
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows of each group.

    The rank runs per salted part first, so at most ``k`` rows of a part reach
    the task that ranks the whole group.
    """
    salts = salt_count(df)
    rest = [c for c in df.columns if c not in group] or list(group)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*rest), F.lit(salts)))
    part = Window.partitionBy(*group, "_salt").orderBy(*order)
    whole = Window.partitionBy(*group).orderBy(*order)
    kept = salted.withColumn("_rank", F.row_number().over(part)).where(F.col("_rank") <= k)
    return (
        kept.withColumn("_rank", F.row_number().over(whole)).where(F.col("_rank") <= k).drop("_rank", "_salt")
    )


def union_relaxed(*frames: DataFrame) -> DataFrame:
    """Union by name; missing columns become null and clashing types widen."""
    kinds: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for field in frame.schema:
            kinds.setdefault(field.name, []).append(field.dataType)

    def common(types: list[T.DataType]) -> T.DataType:
        distinct = set(types)
        if len(distinct) == 1:
            return types[0]
        if all(isinstance(t, T.IntegralType) for t in distinct):
            return T.LongType()
        if all(isinstance(t, T.NumericType) for t in distinct):
            return T.DoubleType()
        return T.StringType()

    target = {name: common(types) for name, types in kinds.items()}
    aligned = [
        f.select(*[F.col(c).cast(target[c]).alias(c) for c in f.columns]) for f in frames
    ]
    out = aligned[0]
    for frame in aligned[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def grand_total(df: DataFrame, value: str) -> Column:
    """Sum over the whole table as a scalar subquery, usable in another select."""
    return df.select(F.sum(value)).scalar()


def _bounds(values: DataFrame, column: str, buckets: int) -> list:
    """Bucket bounds from a fixed-size, hash-ordered pick of the distinct values."""
    rows = values.select(column).orderBy(F.xxhash64(column)).limit(BOUND_SAMPLE).collect()
    seen = sorted(r[0] for r in rows)
    step = max(1, len(seen) // buckets)
    return seen[step::step]


def running_by_value(
    df: DataFrame,
    value: str,
    sums: Mapping[str, Column],
    descending: bool = False,
    limit: int = SMALL_ROWS,
) -> DataFrame:
    """One row per distinct non-null ``value`` with running sums up to it.

    Each entry of ``sums`` gives columns ``name`` (within the value) and
    ``run_name`` (through the value). Ties are one row, which is the RANGE frame
    of ``SUM(..) OVER (ORDER BY value)``. A table counted as small is summed by
    one window. Beyond that the values are cut into ordered buckets, summed per
    bucket, and each bucket starts from the total of those before it.
    """
    aggs = [expr.alias(name) for name, expr in sums.items()]
    values = stored(df.where(F.col(value).isNotNull()).groupBy(value).agg(*aggs), "values")
    order = F.col(value).desc() if descending else F.col(value).asc()
    if is_small(values, limit):
        w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return values.select("*", *[F.sum(n).over(w).alias(f"run_{n}") for n in sums])

    bounds = _bounds(values, value, max(2, min(512, shuffle_width(df))))
    above = F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col(value))
    position = F.size(above)
    bucketed = values.withColumn("_bucket", -position if descending else position)
    totals = bucketed.groupBy("_bucket").agg(*[F.sum(n).alias(f"_sum_{n}") for n in sums])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # at most one row per bucket, so one task and a broadcast are enough
    starts = totals.select(
        "_bucket", *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_from_{n}") for n in sums]
    )
    within = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = bucketed.join(F.broadcast(starts), "_bucket")
    return joined.select(
        value, *sums, *[(F.sum(n).over(within) + F.col(f"_from_{n}")).alias(f"run_{n}") for n in sums]
    )


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float], limit: int = SMALL_ROWS) -> list[float]:
    """Exact quantiles with linear interpolation, from running counts of distinct values."""
    run = running_by_value(df, value, {"n": F.count(F.lit(1))}, limit=limit)
    total = run.agg(F.sum("n")).first()[0] or 0
    if total == 0:
        return []
    spots = [p * (total - 1) for p in probs]
    picks = []
    for s in spots:
        low, high = int(s), min(int(s) + 1, total - 1)
        picks += [F.min(F.when(F.col("run_n") > low, F.col(value))), F.min(F.when(F.col("run_n") > high, F.col(value)))]
    row = run.agg(*[p.alias(f"q{i}") for i, p in enumerate(picks)]).first()
    return [
        float(row[2 * i]) + (float(row[2 * i + 1]) - float(row[2 * i])) * (s - int(s)) for i, s in enumerate(spots)
    ]


def category_codes(df: DataFrame, columns: Sequence[str], limit: int = SMALL_ROWS) -> DataFrame:
    """``kind, category, code``: the distinct non-null texts of each column, numbered from 0 in order."""
    pairs = F.array(*[F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("category")) for c in columns])
    texts = df.select(F.inline(pairs)).where(F.col("category").isNotNull()).distinct()
    keyed = texts.select(F.concat("kind", F.lit(_MARK), "category").alias("_key"))
    run = running_by_value(keyed, "_key", {"one": F.count(F.lit(1))}, limit=limit).select(
        F.substring_index("_key", _MARK, 1).alias("kind"),
        F.expr(f"substr(_key, instr(_key, '{_MARK}') + 1)").alias("category"),
        "run_one",
    )
    # one row per column
    first = run.groupBy("kind").agg(F.min("run_one").alias("_first"))
    joined = run.join(F.broadcast(first), "kind")
    return joined.select("kind", "category", (F.col("run_one") - F.col("_first")).cast("int").alias("code"))


def smallest_row(df: DataFrame, key: str, score: str) -> DataFrame:
    """The single row with the smallest score; the smaller key wins a tie."""
    return df.orderBy(F.col(score).asc(), F.col(key).asc()).limit(1)
