"""Helpers shared by the operators: word splitting, let-binding, components."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagfield.session import shared_dir, stored

# fixed values: the white space between words
SPACES = r"[\x20\x09-\x0D]+"
WORDY = r"[^\x20\x09-\x0D]"
# fixed values: words of a shingle and the similarity of a link, in percent
SHINGLE, PERCENT = 5, 75


def words(text: Column) -> Column:
    """The words of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def clean_columns(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the names the operator uses; extra columns cannot clash."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def stored_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """Like ``stored``, but bucketed by ``key``: joins on it move the other side only.

    For wide rows with a key that does not repeat. The table is entered in the session's catalog, its files lie with
    those of ``stored``.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unique = f"{name}-{uuid.uuid4().hex}"
    path = f"{shared_dir(spark).rstrip('/')}/lagfield/{spark.sparkContext.applicationId}/{unique}"
    entry = f"lagfield_{unique}".replace("-", "_")
    df.repartition(parts, key).write.format("parquet").options(path=path, compression="zstd").bucketBy(parts, key).saveAsTable(entry)
    return spark.table(entry)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components: ``(id, component)`` for every id in ``edges(a, b)``.

    ``component`` is the smallest id reachable. Labels are passed along the edges and then jumped (the label of
    a label), so the rounds grow with the logarithm of a chain. A hub costs one partial aggregate, not one task.
    Labels have a row per id and are hashed part by part: by the size of its files, Spark would broadcast a large table.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.where(F.col("a") != F.col("b")).distinct(), f"{name}-edges")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m"))
    labels = stored(labels.select("id", F.least("id", "m").alias("component"), F.lit(True).alias("moved")), name)
    while labels.where("moved").limit(1).count():
        seen = both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("m")).hint("shuffle_hash"), "b")
        best = seen.groupBy(F.col("a").alias("id")).agg(F.min("m").alias("m"))
        nearer = labels.join(best.hint("shuffle_hash"), "id").select("id", "component", F.least("component", "m").alias("next"))
        jump = labels.select(F.col("id").alias("next"), F.col("component").alias("far"))
        labels = stored(
            nearer.join(jump.hint("shuffle_hash"), "next").select(
                "id",
                F.least("next", "far").alias("component"),
                (F.least("next", "far") != F.col("component")).alias("moved"),
            ),
            name,
        )
    return labels.select("id", "component")
