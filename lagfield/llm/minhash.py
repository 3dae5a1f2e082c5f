"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its smallest and its largest image, so half as many
permutations are evaluated. Both agree between two sets with the probability of their similarity. Bands of these
values propose pairs; every link is confirmed on the full shingle sets.

Texts with equal sets are one class from the start. Within a bucket each class is first compared with one
representative only; what these links already connect needs no further look. Members of buckets that are not yet in
one part are then joined on their rarest shingles: of two sets that are similar enough, the rarest quarters of both
share a shingle, at places that leave room for the rest. So no link is lost and a large group costs few pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagfield.llm.common import PERCENT, SHINGLE, clean_columns, components
from lagfield.session import stored

# Texts hashed together in a task, in bytes; only a matter of memory.
CHUNK = 2_000_000
# Word hashes kept by a task.
KNOWN_WORDS = 500_000


@dataclass(frozen=True)
class MinMaxConfig:
    """``permutations`` give twice as many values, cut into bands of ``rows``.

    64 permutations make 32 bands of 4: a pair of similarity 0.75 is missed by all with probability 5e-6.
    ``rounds`` representatives are tried in a bucket before its unconnected parts are joined on rare shingles.
    """

    shingle: int = SHINGLE
    percent: int = PERCENT
    permutations: int = 64
    rows: int = 4
    rounds: int = 2


class WordHashes(dict):
    """64-bit hashes of words, computed once each."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None], size: int, known: WordHashes) -> list[np.ndarray]:
    """Sorted hashes of the different shingles of each text.

    Splitting bytes at ASCII white space and lower-casing A-Z is what ``bytes.split`` and ``bytes.lower`` do.
    """
    factors = _mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    sets = []
    for text in texts:
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            sets.append(np.empty(0, np.uint64))
            continue
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = max(1, len(words) - size + 1)
        joined = np.full(n, min(len(words), size), np.uint64)
        for i in range(min(size, len(words))):
            joined += hashes[i : i + n] * factors[i]
        sets.append(np.unique(_mixed(joined)))
    return sets


def min_max_values(sets: list[np.ndarray], permutations: int) -> np.ndarray:
    """Signatures of non-empty sets: for each permutation its minimum, then its maximum."""
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    keys = _mixed(np.arange(1, 2 * permutations + 1, dtype=np.uint64))
    out = np.empty((len(sets), 2 * permutations), np.uint64)
    for k in range(permutations):
        image = (flat ^ keys[2 * k]) * (keys[2 * k + 1] | np.uint64(1))
        image ^= image >> np.uint64(32)
        out[:, 2 * k] = np.minimum.reduceat(image, starts)
        out[:, 2 * k + 1] = np.maximum.reduceat(image, starts)
    return out


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= CHUNK:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _signatures(config: MinMaxConfig):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in _chunks(texts):
                sets = shingle_sets(texts[a:b], config.shingle, known)
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                if full:
                    values = min_max_values([sets[i] for i in full], config.permutations)
                    values = values.reshape(len(full), -1, config.rows)
                    band = np.zeros(values.shape[:2], np.uint64)
                    for r in range(config.rows):
                        band = _mixed(band + values[:, :, r])
                    # the number of the band is part of its hash
                    band = _mixed(band + np.arange(1, band.shape[1] + 1, dtype=np.uint64)).astype(np.int64)
                    for i, row in zip(full, band):
                        bands[i] = row
                yield pd.DataFrame(
                    {
                        "id": batch["id"].iloc[a:b].to_numpy(),
                        "n_shingles": [len(s) for s in sets],
                        "content": [xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None for s in sets],
                        "bands": bands,
                    }
                )

    return run


def _sets_of(config: MinMaxConfig):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in _chunks(texts):
                sets = shingle_sets(texts[a:b], config.shingle, known)
                yield pd.DataFrame({"id": batch["id"].iloc[a:b].to_numpy(), "shingles": [s.tobytes() for s in sets]})

    return run


def _confirmed(config: MinMaxConfig):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            linked = []
            for x, y in zip(batch["x"], batch["y"]):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                both = int((q[at] == p).sum())
                linked.append(100 * both >= config.percent * (len(p) + len(q) - both))
            yield batch.loc[np.array(linked, bool), ["a", "b"]] if linked else batch[["a", "b"]]

    return run


def _confirm(pairs: DataFrame, sets: DataFrame, config: MinMaxConfig) -> DataFrame:
    """Pairs of ``pairs(a, b)`` whose full sets are similar enough."""
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    return stored(both.select("a", "b", "x", "y").mapInPandas(_confirmed(config), "a long, b long"), "minmax-links")


def _exploded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for a in range(0, len(batch), 256):
            part = batch.iloc[a : a + 256]
            sets = [np.frombuffer(x, np.int64) for x in part["shingles"]]
            yield pd.DataFrame({"id": np.repeat(part["id"].to_numpy(), [len(x) for x in sets]), "g": np.concatenate(sets)})


def _rare_pairs(members: DataFrame, sets: DataFrame, config: MinMaxConfig) -> DataFrame:
    """Pairs of ``members(id, n_shingles, part)`` of different parts that may be linked.

    Shingles go from rare to common. Sets x and y need ``percent`` of their union in common, so of the first
    (100 - percent) percent of x, and one more, at least one is among those of y; and behind the first one in common
    enough places have to be left in both. Where a part holds most of a shingle's sets, only the others are paired.
    """
    own = sets.join(members.select("id"), "id", "left_semi").mapInPandas(_exploded, "id long, g long")
    own = stored(own, "minmax-shingles")
    ranked = own.join(own.groupBy("g").agg(F.count(F.lit(1)).alias("df")).where("df > 1"), "g", "left")
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.coalesce("df", F.lit(1)), "g"))
    first = ranked.withColumn("i", rank).join(members, "id")
    first = first.where((F.col("i") - 1) * 100 <= (100 - config.percent) * F.col("n_shingles"))
    first = stored(first.where("df > 1").select("id", "n_shingles", "part", "i", "g"), "minmax-rare")
    most = first.groupBy("g", "part").agg(F.count(F.lit(1)).alias("n")).groupBy("g").agg(
        F.max_by("part", F.struct("n", "part")).alias("most"), F.count(F.lit(1)).alias("parts")
    )
    x = first.join(most.where("parts > 1"), "g").where("part <> most").alias("x")
    y = first.alias("y")
    n, m = F.col("x.n_shingles"), F.col("y.n_shingles")
    room = 1 + F.least(n - F.col("x.i"), m - F.col("y.i"))
    met = x.join(
        y, (F.col("x.g") == F.col("y.g")) & (F.col("x.part") != F.col("y.part"))
        & ((100 + config.percent) * room >= config.percent * (n + m)),
    )
    return met.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def near_links(docs: DataFrame, config: MinMaxConfig = MinMaxConfig()) -> tuple[DataFrame, DataFrame]:
    """``(members, classes)`` of ``docs(id, text)``.

    members: id, n_shingles, rep (the smallest id with the same set; null for empty sets).
    classes: rep, component (connected by confirmed links).
    """
    schema = "id long, n_shingles long, content string, bands array<long>"
    signed = stored(docs.mapInPandas(_signatures(config), schema), "minmax")
    sets = stored(
        signed.where("n_shingles > 0").groupBy("content", "n_shingles").agg(F.min("id").alias("rep")), "minmax-sets"
    )
    members = signed.select("id", "n_shingles", "content").join(sets.select("content", "rep"), "content", "left")
    members = stored(members.select("id", "n_shingles", "rep"), "minmax-members")
    reps = signed.join(sets.select(F.col("rep").alias("id")), "id", "left_semi").dropDuplicates(["id"])
    reps = reps.select("id", "n_shingles", F.explode("bands").alias("band"))
    # only buckets with company matter
    shared = reps.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("band")
    buckets = stored(reps.join(shared, "band"), "minmax-buckets")

    # the full sets of all that have company, for every round
    company = buckets.select("id").distinct()
    full_sets = stored(
        docs.join(company, "id", "left_semi").dropDuplicates(["id"]).select("id", "text")
        .mapInPandas(_sets_of(config), "id long, shingles binary"),
        "minmax-full",
    )
    close = lambda n, m: 100 * F.least(n, m) >= config.percent * F.greatest(n, m)
    held = buckets.withColumn("part", F.col("id"))
    parts = links = tried = None
    for turn in range(config.rounds + 1):
        # buckets with members in different parts
        sides = held.groupBy("band").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi")
        held = stored(held.join(sides.select("band"), "band", "left_semi"), "minmax-open")
        if not held.limit(1).count():
            break
        if turn == config.rounds:
            pairs = _rare_pairs(held.select("id", "n_shingles", "part").distinct(), full_sets, config)
        else:
            pick = F.min_by(F.struct("id", "n_shingles", "part"), F.xxhash64("id", F.lit(turn)))
            lead = held.groupBy("band").agg(pick.alias("r"))
            lead = lead.select("band", F.col("r.id").alias("a"), F.col("r.n_shingles").alias("n"), F.col("r.part").alias("part_a"))
            met = lead.join(held.withColumnsRenamed({"id": "b", "n_shingles": "m"}), "band")
            pairs = met.where((F.col("part_a") != F.col("part")) & close(F.col("n"), F.col("m")))
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "minmax-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        found = _confirm(pairs, full_sets, config)
        links = found if links is None else links.unionByName(found)
        parts = components(links, "minmax-parts")
        held = held.drop("part").join(parts.withColumnRenamed("component", "part"), "id", "left")
        held = held.withColumn("part", F.coalesce("part", "id"))
    if parts is None:
        parts = sets.select(F.col("rep").alias("id"), F.col("rep").alias("component")).limit(0)
    return members, parts.select(F.col("id").alias("rep"), "component")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: MinMaxConfig = MinMaxConfig()
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable), kept (first of its component).

    Null, empty and blank texts have no shingles and are their own component. Rows with a null id are not linked;
    their component is null and they are kept. Rows that repeat an id should repeat its text and give repeated
    results; where they do not, the id joins the components of all its texts. An empty table gives an empty one.
    """
    docs = clean_columns(docs, id=id_col, text=text_col)
    docs = docs.select(F.col("id").cast("long").alias("id"), "text")
    members, classes = near_links(docs.where(F.col("id").isNotNull()), config)
    named = members.join(classes, "rep", "left").select(
        "id", "n_shingles", F.coalesce("component", "rep", "id").alias("component_id")
    )
    lost = docs.where(F.col("id").isNull()).mapInPandas(
        _signatures(config), "id long, n_shingles long, content string, bands array<long>"
    ).select("id", "n_shingles", F.lit(None).cast("long").alias("component_id"))
    rows = named.unionByName(lost)
    return rows.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))).withColumnRenamed(
        "id", id_col
    )


def first_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", config: MinMaxConfig = MinMaxConfig()
) -> DataFrame:
    """The documents that are the first of their component, with all their columns."""
    later = near_duplicates(docs, id_col, text_col, config).where(~F.col("kept"))
    later = later.select(F.col(id_col).alias("_later")).distinct()
    return docs.join(later, docs[id_col] == later["_later"], "left_anti")
