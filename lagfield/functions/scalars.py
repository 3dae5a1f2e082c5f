"""Column expressions shared by the operators."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagfield.functions.periods import as_col

# fixed values: denominators and floors of the feature contract
RATIO_EPS = 1e-6
STOCK_EPS = 1e-3
LEVEL_FLOOR = 1e-3


def ratio(num: Column | str, den: Column | str, eps: float = RATIO_EPS) -> Column:
    """``num / (den + eps)``; null instead of an error if the sum is exactly 0."""
    return F.try_divide(as_col(num), as_col(den) + F.lit(eps))


def clip(value: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Clip to bounds; null stays null."""
    x = as_col(value)
    out = x
    if low is not None:
        out = F.when(out < low, F.lit(float(low))).otherwise(out)
    if high is not None:
        out = F.when(out > high, F.lit(float(high))).otherwise(out)
    return out


def positive_flag(value: Column | str) -> Column:
    """Null stays null, else 1 when above zero and 0 otherwise."""
    x = as_col(value)
    return F.when(x.isNotNull(), (x > 0).cast("int"))


def row_mean(cols: Sequence[Column | str]) -> Column:
    """Mean over the non-null columns of a row, null if all are null."""
    cs = [as_col(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cs])
    count = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cs])
    return F.when(count > 0, F.try_divide(total, count))


def row_max(cols: Sequence[Column | str]) -> Column:
    """Largest non-null column of a row."""
    return F.greatest(*[as_col(c) for c in cols])


def digitize(value: Column | str, cuts: Sequence[float]) -> Column:
    """Number of ascending cut points at or below the value (left-closed bins)."""
    x = as_col(value)
    return reduce(lambda a, b: a + b, [(x >= float(c)).cast("int") for c in cuts], F.lit(0))


def one_hot(value: Column | str, ids: Sequence[int], prefix: str) -> list[Column]:
    """One 0/1 column per id; a null value gives 0 everywhere."""
    x = as_col(value)
    return [F.coalesce(x == i, F.lit(False)).cast("int").alias(f"{prefix}{i}") for i in ids]


def lenient_double(value: Column | str) -> Column:
    """Number or null, never an error."""
    return as_col(value).try_cast("double")


def starting_with(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def joined_text(df: DataFrame, sep: str = ", ") -> Column:
    """All columns of ``df`` as one text, nulls left out."""
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in df.columns])


def hash_order(keys: Sequence[str], seed: int) -> Column:
    """A repeatable pseudo-random order that does not depend on partitioning."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def _unit(keys: Sequence[str], seed: int, stream: int) -> Column:
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)), F.lit(str(stream))))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / F.lit(float(2**52))


def lognormal_noise(keys: Sequence[str], sigma: float, seed: int) -> Column:
    """Multiplier ``exp(sigma * z)`` with ``z`` normal and fixed by key and seed."""
    radius = F.sqrt(F.lit(-2.0) * F.log(_unit(keys, seed, 1)))
    angle = F.lit(2.0 * math.pi) * _unit(keys, seed, 2)
    return F.exp(F.lit(float(sigma)) * radius * F.cos(angle))


def with_noise(df: DataFrame, value: str, keys: Sequence[str], sigma: float, seed: int) -> DataFrame:
    return df.withColumn(value, F.col(value) * lognormal_noise(keys, sigma, seed))


def with_zscore(df: DataFrame, seq: str, out: str, floor: float = 1e-9, additive: bool = False) -> DataFrame:
    """Population z-score of an array column.

    ``additive`` adds ``floor`` to the deviation; otherwise a deviation at or
    below ``floor`` gives zeros. Mean and deviation are columns of their own, so
    they are not recomputed for each element.
    """
    n = F.size(seq).cast("double")
    mean = F.try_divide(F.aggregate(seq, F.lit(0.0), lambda a, x: a + x), n)
    df = df.withColumn("_mean", mean)
    spread = F.aggregate(seq, F.lit(0.0), lambda a, x: a + (x - F.col("_mean")) * (x - F.col("_mean")))
    df = df.withColumn("_sd", F.sqrt(F.try_divide(spread, n)))
    sd = F.col("_sd")
    if additive:
        scaled = F.transform(seq, lambda x: (x - F.col("_mean")) / (sd + floor))
    else:
        scaled = F.transform(
            seq, lambda x: F.when(sd > floor, F.try_divide(x - F.col("_mean"), sd)).otherwise(F.lit(0.0))
        )
    return df.withColumn(out, scaled).drop("_mean", "_sd")
