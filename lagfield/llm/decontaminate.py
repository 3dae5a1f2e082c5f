"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

One pass over the documents finds the n-grams that a test item has too, and cuts out the words around. How common an
n-gram is among the items only says which seeds of an item are probed, never which documents are looked at: the
common ones are left out only where an alignment of the score asked for must hold others too. A part with too few of
the item's words for that score is passed over; the rest are aligned, so edited copies score by what is left of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagfield.llm.common import clean_columns
from lagfield.llm.minhash import WordHashes, _chunks, _mixed
from lagfield.session import stored

# ASCII signs read as spaces; letters, digits and other bytes stay.
_FOLD = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


@dataclass(frozen=True)
class DecontaminationConfig:
    """Seeds are ``gram`` words long. A passage is a leak of an item if the alignment reaches ``min_score``.

    The score is the alignment's part of a full match of the item: equal words earn 2, other words and gaps cost 1.
    It must also be worth ``min_words`` equal words, or the whole of a shorter item, as a few common words are no leak:
    an item of 8 words or less must be there whole, one of 10 words by 0.8, one of 14 or more by ``min_score``.
    Without two equal words in a row an alignment with n words earns n + 1 of 2n at most. So seeds of two words miss
    nothing from a score of 0.6 on; longer seeds may.
    Items of under ``gram`` words match by their whole text.
    Items are taken in blocks of ``block``, so a task holds a bounded part of the benchmark.
    """

    gram: int = 2
    min_score: float = 0.6
    min_words: int = 8
    block: int = 20_000


def fold_words(text: str | None) -> list[bytes]:
    """Words without signs and case."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words; a shorter text is one run."""
    n = max(1, len(hashes) - size + 1)
    factors = _mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    joined = np.full(n, min(len(hashes), size), np.uint64)
    for i in range(min(size, len(hashes))):
        joined += hashes[i : i + n] * factors[i]
    return _mixed(joined)


def _item_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known = WordHashes()
    for batch in batches:
        rows = []
        for item, text in zip(batch["item"], batch["text"]):
            words = fold_words(text)
            if len(words) >= 1:
                rows.append((item, np.array([known[w] for w in words], np.uint64).astype(np.int64)))
        yield pd.DataFrame(rows, columns=["item", "words"])


class _Block:
    """A block of items as flat arrays, to be sent to the tasks once.

    An alignment of ``m`` equal words and ``e`` other steps has at most ``e + 1`` runs, so with seeds of ``k`` words it
    holds ``m - (k - 1)(e + 1)`` of the item's n-grams at least. With ``2m - e`` the least score asked for and ``m`` at
    most the item's length this is ``need``. The n-grams most common in the block are no seeds as far as ``need``
    allows: the others must then be met ``need`` times less the number left out.
    """

    def __init__(self, rows: pd.DataFrame, config: DecontaminationConfig) -> None:
        size = config.gram
        self.items = rows["item"].to_numpy(np.int64)
        self.words = [np.asarray(w, np.int64) for w in rows["words"]]
        lengths = np.array([len(w) for w in self.words])
        self.asked = np.maximum(config.min_score * 2 * lengths, 2 * np.minimum(config.min_words, lengths)) - 1e-9
        self.need = np.maximum(1, np.ceil((size - 1) * (self.asked - 1) - (2 * size - 3) * lengths - 1e-6)).astype(np.int64)
        # as many words as an alignment of that score can run over in a document
        self.reach = lengths + np.maximum(0, np.floor(2 * lengths - self.asked)).astype(np.int64)
        own = [_grams(w.view(np.uint64), size) for w in self.words]
        everywhere, common = np.unique(np.concatenate([np.unique(g) for g in own]), return_counts=True)
        keys, owners = [], []
        for i, grams in enumerate(own):
            often = common[np.searchsorted(everywhere, grams)]
            out = min(int(self.need[i] - 1), int((often > 1).sum()))
            seeds = np.unique(grams[np.argsort(-often, kind="stable")[out:]])
            self.need[i] -= out
            keys.append(seeds)
            owners.append(np.full(len(seeds), i))
        keys, owners = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(keys, kind="stable")
        self.owners = owners[order]
        self.grams, self.first, self.count = np.unique(keys[order], return_index=True, return_counts=True)
        self.low = np.zeros(1 << 20, bool)
        self.low[(self.grams & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def places(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Items (their numbers) and places of the seeds met in a document, by item and place."""
        maybe = np.flatnonzero(self.low[(own & np.uint64((1 << 20) - 1)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.grams, own[maybe]), len(self.grams) - 1)
        hit = self.grams[at] == own[maybe]
        maybe, at = maybe[hit], at[hit]
        count = self.count[at]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        owner, place = self.owners[np.repeat(self.first[at], count) + within], np.repeat(maybe, count)
        order = np.argsort(owner, kind="stable")
        return owner[order], place[order]

    def windows(self, hashes: np.ndarray, size: int) -> Iterator[tuple[int, int, int]]:
        """Item, begin and end of the parts of a document that may hold an alignment of the score asked for."""
        owner, place = self.places(_grams(hashes, size))
        if not len(owner):
            return
        # as many seeds as needed, within the reach of the item
        last = np.arange(len(owner)) + self.need[owner] - 1
        inside = last < len(owner)
        end = np.minimum(last, len(owner) - 1)
        near = np.flatnonzero(inside & (owner[end] == owner) & (place[end] - place <= self.reach[owner]))
        k = 0
        while k < len(near):
            item = int(owner[near[k]])
            reach = int(self.reach[item])
            begin, stop = place[near[k]] - reach, place[end[near[k]]] + size + reach
            k += 1
            while k < len(near) and owner[near[k]] == item and place[near[k]] - reach <= stop:
                stop = place[end[near[k]]] + size + reach
                k += 1
            begin, stop = max(0, int(begin)), min(len(hashes), int(stop))
            # the score is at most 2 for each word of the item that is there
            if 2 * np.isin(self.words[item], hashes[begin:stop].view(np.int64)).sum() >= self.asked[item]:
                yield item, begin, stop


def _leaks(block: Broadcast, config: DecontaminationConfig):
    """Pairs of a document and an item with their score; equal parts are aligned once in a batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, asked = WordHashes(), block.value
        for batch in batches:
            ids, texts = batch["id"].to_numpy(), batch["text"].tolist()
            for a, b in _chunks(texts):
                classes: dict = {}
                parts, numbers, pairs = [], [], []
                for k in range(a, b):
                    words = fold_words(texts[k])
                    if not words:
                        continue
                    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
                    for item, begin, end in asked.windows(hashes, config.gram):
                        part = hashes[begin:end].view(np.int64)
                        number = classes.setdefault((item, part.tobytes()), len(parts))
                        if number == len(parts):
                            parts.append(part)
                            numbers.append(item)
                        pairs.append((ids[k], number))
                if not pairs:
                    continue
                scores = _part_scores(parts, [asked.words[i] for i in numbers])
                leak = scores >= asked.asked[numbers]
                found = [
                    (i, asked.items[numbers[n]], scores[n] / (2.0 * len(asked.words[numbers[n]]))) for i, n in pairs if leak[n]
                ]
                yield pd.DataFrame(found, columns=["id", "item", "score"])

    return run


def align_scores(passages: list[np.ndarray], items: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each passage with its item, all pairs at once.

    Rows go over the item's words; a gap in the passage is a running maximum along the row.
    """
    n, m = max(map(len, passages)), max(map(len, items))
    held = np.zeros((len(passages), n), np.int64)
    there = np.zeros((len(passages), n), bool)
    for i, p in enumerate(passages):
        held[i, : len(p)], there[i, : len(p)] = p, True
    asked = np.zeros((len(items), m), np.int64)
    real = np.zeros((len(items), m), bool)
    for i, q in enumerate(items):
        asked[i, : len(q)], real[i, : len(q)] = q, True
    slope = np.arange(n + 1, dtype=np.int32)
    above = np.zeros((len(passages), n + 1), np.int32)
    best = np.zeros(len(passages), np.int32)
    for j in range(m):
        same = (held == asked[:, j : j + 1]) & there
        here = np.zeros_like(above)
        here[:, 1:] = np.maximum(above[:, :-1] + np.where(same, 2, -1), above[:, 1:] - 1)
        here = np.maximum.accumulate(np.maximum(here, 0) + slope, axis=1) - slope
        here[~real[:, j]] = 0
        best = np.maximum(best, here.max(axis=1))
        above = here
    return best


def _part_scores(parts: list[np.ndarray], items: list[np.ndarray]) -> np.ndarray:
    """Alignment scores of pairs of any sizes."""
    # pairs of like size together, so little is padded
    order = np.argsort([len(p) for p in parts], kind="stable")
    scores = np.zeros(len(parts))
    begin = 0
    while begin < len(order):
        end = begin + 1
        while end < len(order) and (end - begin + 1) * len(parts[order[end]]) <= 400_000:
            end += 1
        group = order[begin:end]
        scores[group] = align_scores([parts[i] for i in group], [items[i] for i in group])
        begin = end
    return scores


def leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", config: DecontaminationConfig = DecontaminationConfig(),
) -> DataFrame:
    """Pairs (id, item) of documents that hold an item or an edited copy of it, with the best score.
    ``min_score`` and ``min_words`` say what counts, see the configuration.

    Null and empty texts on either side match nothing; rows with a null id are not searched. Items shorter than a
    seed match only by a document of just their words. Rows that repeat an id or an item are taken together.
    """
    docs = clean_columns(docs, id=id_col, text=text_col).where("id is not null and text is not null")
    docs = docs.select(F.col("id").cast("long").alias("id"), "text")
    items = clean_columns(items, item=item_col, text=item_text).where("item is not null and text is not null")
    items = items.select(F.col("item").cast("long").alias("item"), "text")
    tested = stored(items.mapInPandas(_item_words, "item long, words array<long>"), "items")
    n_items = tested.count()
    blocks = max(1, -(-n_items // config.block))
    found = None
    for block in range(blocks):
        own = tested if blocks == 1 else tested.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block)
        # a block is bounded by its number of items and their lengths
        rows = own.toPandas()
        if not len(rows):
            continue
        sent = docs.sparkSession.sparkContext.broadcast(_Block(rows, config))
        scored = docs.mapInPandas(_leaks(sent, config), "id long, item long, score double")
        found = scored if found is None else found.unionByName(scored)
    if found is None:
        found = docs.select("id", F.lit(0).cast("long").alias("item"), F.lit(0.0).alias("score")).limit(0)
    best = found.groupBy("id", "item").agg(F.max("score").alias("score"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "score")


def leak_report(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", config: DecontaminationConfig = DecontaminationConfig(),
) -> DataFrame:
    """One row per input row: id, n_items, items (their ids, comma-joined), best_score, kept (no leak)."""
    pairs = leaks(docs, items, id_col, text_col, item_col, item_text, config)
    per_doc = pairs.groupBy(F.col(id_col).alias("_id")).agg(
        F.count(F.lit(1)).alias("n_items"),
        F.array_join(F.array_sort(F.collect_list(item_col)).cast("array<string>"), ",").alias("items"),
        F.max("score").alias("best_score"),
    )
    rows = docs.select(F.col(f"`{id_col}`").alias(id_col))
    return rows.join(per_doc, rows[id_col] == per_doc["_id"], "left").select(
        id_col, F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.coalesce("items", F.lit("")).alias("items"),
        "best_score", F.col("_id").isNull().alias("kept"),
    )


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents without a leak, with all their columns."""
    found = leaks(docs, items, id_col, **options).select(F.col(id_col).alias("_leaking")).distinct()
    return docs.join(found, docs[id_col] == found["_leaking"], "left_anti")
