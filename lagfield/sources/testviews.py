"""Sales-panel views over the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagfield.functions.periods import period_of
from lagfield.operators.relational import attach

# fixed values: first month of the stock source
STOCK_START = 200007


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Lines with their order. Orders grow with the lines, so the merge join is named: by the size of its two columns in the
    file, Spark would still broadcast an order table of a million rows."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders") if orders is None else orders
    joined = lines.join(orders.hint("merge"), lines.l_orderkey == orders.o_orderkey)
    return joined.withColumn("periodo", period_of("o_orderdate"))


def _nation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with the nation of the customer, which is looked up once per order."""
    nations = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    return _lines(spark, sf_dir, attach(table(spark, sf_dir, "orders"), nations, ["o_custkey"], ["o_orderkey"], "inner"))


def _grouped(lines: DataFrame) -> DataFrame:
    return lines.groupBy("customer_id", "product_id", "periodo").agg(
        F.max(F.when(F.col("l_discount") >= 0.09, 1).otherwise(0)).alias("plan_flag"),
        F.sum("l_quantity").alias("request_tn"),
        F.sum(F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).otherwise(0.0)).alias("tn"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense grain: a nation is the customer, a supplier the product."""
    lines = _nation_lines(spark, sf_dir)
    return _grouped(
        lines.withColumn("customer_id", F.col("c_nationkey")).withColumn("product_id", F.col("l_suppkey"))
    )


def sales_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sparse grain: many customers, ten product groups."""
    lines = _lines(spark, sf_dir)
    return _grouped(
        lines.withColumn("customer_id", F.col("o_custkey")).withColumn("product_id", F.col("l_suppkey") % 10)
    )


def sale_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ungrouped facts, so a customer, product and month may repeat."""
    return _nation_lines(spark, sf_dir).select(
        F.col("c_nationkey").alias("customer_id"),
        F.col("l_suppkey").alias("product_id"),
        "periodo",
        F.when(F.col("l_discount") >= 0.09, 1).otherwise(0).alias("plan_flag"),
        F.col("l_quantity").alias("request_tn"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity")).otherwise(0.0).alias("tn"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("s_suppkey").alias("product_id"),
            F.col("r_name").alias("cat1"),
            F.col("s_nationkey").alias("cat2"),
            F.col("n_name").alias("cat3"),
            (F.col("s_suppkey") % 10).alias("brand"),
            F.col("s_acctbal").alias("sku_size"),
        )
    )


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts late; negative, positive and missing stock all occur."""
    signed = (
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity"))
        .when(F.col("l_returnflag") == "N", -F.col("l_quantity"))
        .otherwise(0.0)
    )
    lines = _lines(spark, sf_dir).where(F.col("periodo") >= STOCK_START)
    return lines.groupBy(F.col("l_suppkey").alias("product_id"), "periodo").agg(F.sum(signed).alias("stock_final"))


def requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products to forecast; id -1 has no history."""
    supplier = table(spark, sf_dir, "supplier")
    known = supplier.where(F.col("s_suppkey") % 10 != 0).select(F.col("s_suppkey").alias("product_id"))
    none = spark.range(1).select(F.lit(-1).cast("bigint").alias("product_id"))
    return known.unionByName(none)
