"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. Partition counts and memory are left to the
# cluster: adaptive execution coalesces small shuffles and splits skewed joins.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Monthly rows take ten and more times as much memory as compressed in a shuffle,
    # so a task gets a quarter of the default.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # A bucket is one partition also where no join or group needs it: row samples go by the partitions.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM does not compile methods over 8,000 bytes. A select of some eighty
    # features makes a larger one when fused, so such stages are better unfused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "lagfield", master: str | None = None, **extra: str) -> SparkSession:
    """Build a session; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, as in
    tests, falls back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="lagfield-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where one result feeds several plans: the lineage is cut, lost executors
    do not redo the work before it, and later readers prune columns. Tables of
    one run lie under one folder, named by the application, to be removed after it.
    """
    spark = df.sparkSession
    run = spark.sparkContext.applicationId
    path = f"{shared_dir(spark).rstrip('/')}/lagfield/{run}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, keys: Sequence[str], parts: int, name: str = "step", ordered: bool = False) -> DataFrame:
    """Like :func:`stored`, in buckets by ``keys``: windows, groups and joins on them need no shuffle.

    Give ``df`` in ``parts`` partitions by ``keys``, so that a bucket is one file, in the order of the keys if ``ordered``.
    The table is entered in the session's catalog, its files lie with those of ``stored``.
    """
    spark = df.sparkSession
    unique = f"{name}-{uuid.uuid4().hex}"
    path = f"{shared_dir(spark).rstrip('/')}/lagfield/{spark.sparkContext.applicationId}/{unique}"
    entry = f"lagfield_{unique}".replace("-", "_")
    writer = df.write.format("parquet").option("path", path).bucketBy(parts, *keys)
    (writer.sortBy(*keys) if ordered else writer).saveAsTable(entry)
    return spark.table(entry)
