"""Mixing sources to target weights by weighted sampling with exponential keys (Efraimidis and Spirakis).

Every source has a target in words. The mix takes a source whole as often as its target allows, these are the complete
epochs, and then a part of it: each document draws the key -ln(u) / w with u uniform and w its quality weight, the
documents are sorted by their keys within the source, and the sizes are summed up in that order until the budget that
the epochs leave is used. A document of twice the weight is twice as likely to come first.

The sums follow the data's own order: one range shuffle by (source, key) of narrow rows, a running sum within each
range, and one start per source and range. So a source that holds a third of all rows is shared by many tasks, and
only a row per source and range is gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagfield.llm.common import SPACES, WORDY, clean_columns
from lagfield.operators.relational import running_by_value
from lagfield.session import stored

# fixed values: weights of the sources in their order, repeating, and the most epochs of one source
WEIGHTS, MAX_EPOCHS = (1, 2, 3), 3


def unit_hash(*parts: Column) -> Column:
    """A number between 0 and 1 from the text of the parts, the same on every run."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MAX_EPOCHS) -> DataFrame:
    """Sources with weight and target, from ``(source, source_size)`` with each source once.

    Sources by code point, a null one last, take the weights in turn, and share the sum of all sizes in proportion.
    No target passes ``most`` times its source's size; what is left over is shared again among the others, until no
    target is above. Without words every target is 0. The rank is a running count over the names, so any number of
    sources is numbered without one task; each round of sharing is one aggregate over the sources.
    """
    if min(weights) <= 0 or most < 1:
        raise ValueError("weights must be above 0, and a source must be allowed one epoch")
    sizes = stored(sizes, "source-sizes")
    named = sizes.where(F.col("source").isNotNull())
    ranks = running_by_value(named, "source", {"one": F.count(F.lit(1))}).select("source", F.col("run_one").alias("rank"))
    last = ranks.agg(F.coalesce(F.max("rank"), F.lit(0)).alias("last")).select("last").scalar()
    joined = sizes.join(ranks, "source", "left").withColumn("rank", F.coalesce("rank", last + 1))
    turn = F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)
    ceiling = F.lit(float(most)) * F.col("source_size")
    table = stored(joined.select("source", "source_size", weight.alias("weight"), ceiling.alias("ceiling")), "sources")
    share, full = None, F.lit(False)
    while True:
        # the share of a unit of weight, once the sources known to be full have got all they may
        left, open_weight, full_now = table.agg(
            F.sum("source_size").cast("double") - F.coalesce(F.sum(F.when(full, F.col("ceiling"))), F.lit(0.0)),
            F.sum(F.when(~full, F.col("weight"))),
            F.count_if(full),
        ).first()
        if not open_weight:
            break
        share = left / open_weight
        above = full | (F.col("weight") * F.lit(share) > F.col("ceiling"))
        if table.agg(F.count_if(above)).first()[0] == full_now:
            break
        full = above
    target = F.when(full, F.col("ceiling")).otherwise(F.col("weight") * F.lit(share or 0.0))
    return stored(table.select("source", "source_size", "weight", target.alias("target")), "targets")


def measured(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """Narrow rows of documents: doc_id, source, size (words of the text, 0 without one) and the text's digest."""
    rows = clean_columns(docs, doc_id=id_col, source=source_col, text=text_col)
    text = F.coalesce("text", F.lit(""))
    cut = F.size(F.split(F.regexp_replace(text, f"^{SPACES}|{SPACES}$", ""), SPACES))
    size = F.when(text.rlike(WORDY), cut).otherwise(F.lit(0)).cast("long")
    return rows.select("doc_id", F.col("source").cast("string").alias("source"), size.alias("size"), F.md5(text).alias("digest"))


def graded(rows: DataFrame, labels: DataFrame, good: float = 4.0, bad: float = 1.0, unknown: float = 2.0) -> DataFrame:
    """``rows`` with a column ``quality``, the weight that the label of its doc_id gives.

    A document labelled more than once takes the mean of its labels; rows without an id or a label are ``unknown``.
    """
    marks = clean_columns(labels, doc_id="doc_id", mark="quality").where("doc_id is not null and mark is not null")
    marks = marks.groupBy("doc_id").agg(F.avg(F.col("mark").cast("double")).alias("mark"))
    # rows without an id meet no label and stay out of the join, where they would be one key
    joined = rows.where("doc_id is not null").join(marks, "doc_id", "left")
    lone = rows.where("doc_id is null").withColumn("mark", F.lit(None).cast("double"))
    quality = F.coalesce(F.lit(bad) + F.lit(good - bad) * F.col("mark"), F.lit(unknown))
    return joined.unionByName(lone).withColumn("quality", quality).drop("mark")


def mix(
    rows: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MAX_EPOCHS, seed: int = 0, by: Sequence[str] = ("doc_id", "source", "digest")
) -> DataFrame:
    """The mix of ``rows``, which have doc_id, source, size, quality and the columns of ``by``.

    Added: source_size, weight and target of the row's source, epochs (whole passes over the source), picked (one
    pass more) and taken, the size times the times that the mix takes the row. The last row is picked if at least half
    of it is within the budget, so a source's sum of ``taken`` is at most half a document away from its target; no row
    is taken more than ``most`` times.

    The key is a hash of seed and ``by``: reruns agree whatever the partitions, and rows that tie are equal in all of
    these, so either may come first. Rows with a null or repeated id count each by itself. A null size counts as 0, a
    null quality as 1; a quality of 0 or less puts a row behind all others. A null source is a source of its own, an
    empty one another. An empty table gives none. Other columns are ignored.
    """
    key = F.when(F.col("quality") > 0, -F.log("u") / F.col("quality")).otherwise(F.lit(float("inf")))
    drawn = rows.select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.coalesce(F.col("size").cast("long"), F.lit(0)).alias("size"),
        F.coalesce(F.col("quality").cast("double"), F.lit(1.0)).alias("quality"),
        unit_hash(F.lit(seed), *[F.col(c) for c in by]).alias("u"),
    )
    drawn = drawn.withColumn("key", key).drop("quality").withColumn("row", F.monotonically_increasing_id())
    # the row number only lets equal rows spread over ranges
    order = ["source", "key", "u", "row"]
    ranges = drawn.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    ranges = stored(ranges, "mix-rows")

    totals = stored(ranges.groupBy("source", "part").agg(F.sum("size").alias("words")), "mix-ranges")
    targets = source_targets(totals.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most)
    # a row per source and range, with the words of the source in the ranges before
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.withColumn("from", F.coalesce(F.sum("words").over(before), F.lit(0)))
    starts = starts.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    starts = starts.select(F.col("source").alias("of"), F.col("part").alias("at"), "from", "source_size", "weight", "target")

    within = Window.partitionBy("source", "part").orderBy("key", "u", "row").rowsBetween(Window.unboundedPreceding, 0)
    summed = ranges.withColumn("through", F.sum("size").over(within))
    # a range of a source is at most what one task of the range shuffle held
    joined = summed.join(starts, (F.col("part") == F.col("at")) & F.col("source").eqNullSafe(F.col("of")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    joined = joined.withColumn("epochs", epochs.cast("long"))
    budget = F.col("target") - F.col("epochs") * F.col("source_size")
    middle = F.col("from") + F.col("through") - F.col("size") / 2
    joined = joined.withColumn("picked", (F.col("size") > 0) & (middle <= budget) & (F.col("epochs") < F.lit(most)))
    taken = F.col("size") * (F.col("epochs") + F.col("picked").cast("long"))
    return joined.select(
        "doc_id", "source", "size", "source_size", "weight", "target", "epochs", "picked", taken.alias("taken")
    )
