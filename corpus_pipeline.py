"""A training-data pipeline over ``documents``: five stages, each written as Parquet and read again by the next.

Each function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
``documents``; the last adds the tokens.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lagfield.llm.cotraining import good_documents
from lagfield.llm.decontaminate import without_leaks
from lagfield.llm.line_dedup import line_dedup
from lagfield.llm.minhash import first_copies
from lagfield.llm.pieces import encode, read_model
from lagfield.llm.queries import PIECES, table
from lagfield.session import shared_dir, tune


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier does not reject."""
    return good_documents(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document has; ``n_chars`` follows the text."""
    return line_dedup(docs, size_col="n_chars")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return first_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents with their tokens."""
    return encode(docs, read_model(PIECES))


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_copies),
    ("benchmark_decontamination", benchmark),
    ("sentencepiece", tokens),
]

# SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared folder and reread."""
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/lagfield/{spark.sparkContext.applicationId}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
