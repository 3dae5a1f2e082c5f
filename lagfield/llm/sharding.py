"""Sharding by a permutation-filled lookup table, with DataFrame functions only.

Every shard has a preference order over the slots of a prime-sized table; the shards take turns, each claiming its
next free slot, until the table is full. A key's slot is its hash modulo the table size, so placing a row is one
lookup in a broadcast table whose size is that prime. If a shard goes, its slots are claimed by the others and few
other slots move.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A prime over a hundred times the usual number of shards.
TABLE_SIZE = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def _number(name: str, use: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{use}:{name}".encode(), digest_size=8).digest(), "big")


def lookup_table(shards: Sequence[str], size: int = TABLE_SIZE) -> list[int]:
    """The shard number of each slot. ``size`` must be prime and at least the number of shards, names different."""
    names = list(shards)
    if not names or len(set(names)) != len(names):
        raise ValueError("shards need different names, one at least")
    if not _is_prime(size) or size < len(names):
        raise ValueError(f"table size {size} must be a prime of at least {len(names)}")
    place = [_number(n, "offset") % size for n in names]
    skip = [_number(n, "skip") % (size - 1) + 1 if size > 2 else 1 for n in names]
    # turns go in the order of names' hashes, so they do not depend on the order given
    order = sorted(range(len(names)), key=lambda i: _number(names[i], "turn"))
    table = [-1] * size
    free = size
    while True:
        for i in order:
            while table[place[i]] >= 0:
                place[i] = (place[i] + skip[i]) % size
            table[place[i]] = i
            free -= 1
            if not free:
                return table


def table_frame(spark: SparkSession, shards: Sequence[str], size: int = TABLE_SIZE) -> DataFrame:
    """``(slot, shard)``, one row per slot."""
    names = F.array(*[F.lit(n) for n in shards])
    slots = F.split(F.lit(",".join(map(str, lookup_table(shards, size)))), ",")
    rows = spark.range(1).select(F.posexplode(slots).alias("slot", "number"))
    return rows.select("slot", F.get(names, F.col("number").cast("int")).alias("shard"))


def place(
    df: DataFrame, keys: Sequence[str], shards: Sequence[str], size: int = TABLE_SIZE, column: str = "shard"
) -> DataFrame:
    """The rows with their shard in ``column``, which replaces one of that name.

    Rows with equal keys share a shard; null keys count as a value. An empty table stays empty.
    """
    slot = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(size)).cast("int")
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns])
    rows = df.select(row.alias("_row"), slot.alias("slot"))
    placed = rows.join(F.broadcast(table_frame(df.sparkSession, shards, size)), "slot")
    kept = [F.col("_row").getField(c).alias(c) for c in df.columns if c.lower() != column.lower()]
    return placed.select(*kept, F.col("shard").alias(column))


def write_shards(
    df: DataFrame, path: str, keys: Sequence[str], shards: Sequence[str], files: int = 8, size: int = TABLE_SIZE
) -> None:
    """Write the rows as Parquet, a folder per shard and about ``files`` files in each, so no task holds a shard."""
    placed = place(df, keys, shards, size, "_shard")
    rest = [F.col(f"`{c}`") for c in df.columns]
    spread = placed.repartition(len(shards) * files, "_shard", F.pmod(F.xxhash64(*rest), F.lit(files)))
    spread.write.mode("overwrite").partitionBy("_shard").parquet(path)
