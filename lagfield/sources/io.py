"""Readers and writers for the workbench files and tables."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lagfield.operators.relational import shuffle_width, union_relaxed
from lagfield.session import stored

# fixed values: columns of the input files
SELL_IN = (
    "periodo int, customer_id bigint, product_id bigint, plan_precios_cuidados int, "
    "cust_request_qty int, cust_request_tn double, tn double"
)
SELL_IN_ZEROES = (
    "customer_id bigint, product_id bigint, periodo int, plan_precios_cuidados int, "
    "cust_request_qty int, cust_request_tn double, tn double"
)
REQUESTED = "product_id bigint"
PRODUCTS = "product_id bigint, cat1 string, cat2 string, cat3 string, brand string, sku_size string"
STOCKS = "product_id bigint, periodo int, stock_final double"
FORECAST = "product_id bigint, tn double"
SEGMENTS = (
    "customer_id bigint, product_id bigint, positive_months bigint, total_tn double, "
    "observed_months bigint, regime int, regime_name string, shape_cluster int, cluster_v2 int"
)


def read_delimited(
    spark: SparkSession, path: str, schema: str | None = None, sep: str = ",", spread: bool = False
) -> DataFrame:
    """Delimited text with a header, plain or gzip.

    Columns of ``schema`` are taken by name and cast; without one the types are
    inferred. Gzip text is one split per file, so ``spread`` shuffles it for the
    work that follows.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
    else:
        wanted = T.StructType.fromDDL(schema)
        df = reader.csv(path).select(*[F.col(f.name).cast(f.dataType) for f in wanted])
    return df.repartition(shuffle_width(df)) if spread else df


def read_sell_in(spark: SparkSession, path: str) -> DataFrame:
    """Sell-in facts (tab separated) under the names the operators use."""
    df = read_delimited(spark, path, SELL_IN, sep="\t", spread=path.endswith(".gz"))
    return df.withColumnsRenamed({"plan_precios_cuidados": "plan_flag", "cust_request_tn": "request_tn"})


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """Zero-filled panel (comma separated) under the names the operators use."""
    df = read_delimited(spark, path, SELL_IN_ZEROES, spread=path.endswith(".gz"))
    return df.withColumnsRenamed({"plan_precios_cuidados": "plan_flag", "cust_request_tn": "request_tn"})


def as_table(df: DataFrame, name: str) -> DataFrame:
    """Write once as Parquet and register under a name for SQL."""
    kept = stored(df, name)
    kept.createOrReplaceTempView(name)
    return kept


def write_csv(df: DataFrame, path: str, compression: str | None = None, order: Sequence[str] = ()) -> None:
    """Delimited text with a header, one file per partition.

    With ``order`` the files follow a global order: rows are split by range and
    sorted within each file.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    df.write.mode("overwrite").csv(path, header=True, compression=compression or "none")


def write_panel(df: DataFrame, path: str, files: int = 64) -> None:
    """Panel as Parquet by month, in ``files`` files each; readers of some months skip the rest."""
    df.repartition("periodo", F.pmod(F.xxhash64("customer_id", "product_id"), F.lit(files))).write.mode(
        "overwrite"
    ).partitionBy("periodo").parquet(path)


def write_manifest(spark: SparkSession, path: str, payload: dict) -> None:
    """A small nested record as one JSON line."""
    spark.createDataFrame([(json.dumps(payload, ensure_ascii=False),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


def append_log(rows: DataFrame, path: str) -> None:
    """Add run rows to a log whose columns and their types may differ from earlier runs.

    A row is stored as the text of its values with the types it had.
    """
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    values = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), {"ignoreNullFields": "false"})
    rows.select(values.alias("row"), F.lit(json.dumps(kinds)).alias("kinds")).write.mode("append").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the log; a column that had several types gets the wider one, as in a union."""
    stored_rows = spark.read.parquet(path)
    # one entry per layout of a run, not per row
    layouts = sorted(r[0] for r in stored_rows.select("kinds").distinct().collect())
    parts = []
    for kinds in layouts:
        schema = ", ".join(f"`{c}` {kind}" for c, kind in json.loads(kinds).items())
        parts.append(stored_rows.where(F.col("kinds") == kinds).select(F.from_json("row", schema).alias("r")).select("r.*"))
    return union_relaxed(*parts)


def combined_log(*logs: DataFrame) -> DataFrame:
    """Logs with differing columns and types in one table."""
    return union_relaxed(*logs)


def write_medoids(medoids: DataFrame, path: str) -> None:
    """Medoid table ``cut, medoid_id, seq``; one folder per cut. Only the cuts of the table are replaced."""
    medoids.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("cut").parquet(path)


def read_medoids(spark: SparkSession, path: str, cut: int) -> DataFrame:
    return spark.read.parquet(path).where(F.col("cut") == cut)


def read_segments(spark: SparkSession, path: str, cut: int) -> DataFrame:
    """A segment map file with the cut it was made at; a missing file raises."""
    return read_delimited(spark, path, SEGMENTS).withColumn("cut", F.lit(cut))


def finished(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Results of earlier runs, or no rows if there are none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
