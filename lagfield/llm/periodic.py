"""Periodic runs of words: every stretch in which a block of words repeats at least four times in a row.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends. The runs of a
document come from two suffix trees, one of its words and one of their reversal, both built by Ukkonen's algorithm.
An Euler tour of a tree visits, between two leaves next to each other in order, one node that is shallowest; the
lowest common ancestor of any two leaves is the shallowest of those between them, and a table of minima over powers
of two answers that in constant time. So the longest common extension of two positions, to the right in the first
tree and to the left in the second, costs one look-up.

Candidates: each run holds, at one of its positions, the longest Lyndon word that begins there, by the order of the
words or by its reverse, and the length of that word is the run's period. So one candidate a position and order,
extended to both sides, finds every run.

A run of exponent four holds each of its words four times. Words that are rarer in a stretch cut it, again and again
until no such word is left; the trees are built of the stretches that remain. Nothing that could be a run is cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagfield.llm.common import clean_columns, let, words

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
# fixed values: the least length of a run, and the least number of times its period fits (2 at least)
MIN_LENGTH, MIN_TIMES = 6, 4
# characters of text that go back to Spark at once
_CHUNK = 4_000_000

_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class SuffixTree:
    """Suffix tree of a sequence of numbers from 1 up, built left to right in linear time."""

    def __init__(self, symbols: np.ndarray) -> None:
        self.n = len(symbols)
        s = [*symbols.tolist(), 0]  # 0 ends the sequence and sorts before all else
        self.width = width = int(symbols.max(initial=0)) + 1
        self._grow(s, width)

    def _grow(self, s: list[int], width: int) -> None:
        size = len(s)
        start, end, parent, link, suffix = [0], [0], [0], [0], [-1]
        edges: dict[int, int] = {}  # node * width + first symbol -> child
        node = edge = length = waiting = leaves = 0
        for i, c in enumerate(s):
            waiting += 1
            fresh = -1  # the node made last in this step, still without its link
            while waiting:
                if not length:
                    edge = i
                key = node * width + s[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(i), end.append(size), parent.append(node), link.append(0), suffix.append(leaves)
                    leaves += 1
                    if fresh >= 0:
                        link[fresh] = node
                        fresh = -1
                else:
                    first = start[child]
                    span = end[child] - first
                    if length >= span:
                        node, edge, length = child, edge + span, length - span
                        continue
                    if s[first + length] == c:
                        length += 1
                        if fresh >= 0:
                            link[fresh] = node
                        break
                    cut = len(start)
                    start.append(first), end.append(first + length), parent.append(node), link.append(0), suffix.append(-1)
                    edges[key] = cut
                    start[child], parent[child] = first + length, cut
                    edges[cut * width + s[first + length]] = child
                    edges[cut * width + c] = cut + 1
                    start.append(i), end.append(size), parent.append(cut), link.append(0), suffix.append(leaves)
                    leaves += 1
                    if fresh >= 0:
                        link[fresh] = cut
                    fresh = cut
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - waiting + 1
        self.parent, self.suffix = np.array(parent, np.int64), suffix
        self.span = np.array(end, np.int64) - np.array(start, np.int64)
        self.first = np.array(s, np.int64)[np.array(start, np.int64)]

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in order, and before each the string depth of the shallowest node since the last one.

        ``reverse`` turns the order of the symbols round; the end still sorts first.
        """
        rank = (self.width - self.first) % self.width if reverse else self.first
        order = np.lexsort((rank[1:], self.parent[1:])) + 1
        above = self.parent[order]
        begin = np.searchsorted(above, np.arange(len(self.parent) + 1)).tolist()
        leading = np.zeros(len(self.parent), bool)
        leading[order[np.concatenate([[True], above[1:] != above[:-1]])]] = True
        leading, kids, span, parent, suffix = leading.tolist(), order.tolist(), self.span.tolist(), self.parent.tolist(), self.suffix
        depth = [0] * len(parent)
        suffixes, shallow, gap = [], [], 0
        stack = kids[begin[0] : begin[1]][::-1]
        while stack:
            v = stack.pop()
            above_v = parent[v]
            if not leading[v]:
                gap = depth[above_v]
            if suffix[v] >= 0:
                suffixes.append(suffix[v])
                shallow.append(gap)
            else:
                depth[v] = depth[above_v] + span[v]
                stack.extend(kids[begin[v] : begin[v + 1]][::-1])
        return np.array(suffixes, np.int64), np.array(shallow, np.int64)


class Extensions:
    """Longest common extensions of suffixes of one tree."""

    def __init__(self, tree: SuffixTree) -> None:
        order, self.shallow = tree.tour()
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.arange(len(order))

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at ``a`` and at ``b`` have in common, for each pair; the two differ.

        The look-ups go from short distances to long ones, so one row of the table of minima is held at a time.
        """
        low = np.minimum(self.rank[a], self.rank[b]) + 1
        high = np.maximum(self.rank[a], self.rank[b]) + 1
        power = np.frexp((high - low).astype(np.float64))[1] - 1
        found = np.zeros(len(low), np.int64)
        minima = self.shallow
        for k in range(int(power.max(initial=-1)) + 1):
            if k:
                half = 1 << (k - 1)
                minima = np.minimum(minima[:-half], minima[half:])
            here = np.flatnonzero(power == k)
            found[here] = np.minimum(minima[low[here]], minima[high[here] - (1 << k)])
        return found


def _lyndon(rank: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each position, by the ranks of the suffixes."""
    ranks, n = rank.tolist(), len(rank)
    smaller = [0] * n  # the next suffix that ranks lower
    for i in range(n - 1, -1, -1):
        j, own = i + 1, ranks[i]
        while j < n and ranks[j] > own:
            j = smaller[j]
        smaller[i] = j
    return np.array(smaller, np.int64) - np.arange(n)


def _stretch_runs(x: np.ndarray, min_length: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one stretch of words numbered from 1 up."""
    n = len(x)
    tree = SuffixTree(x)
    right = Extensions(tree)
    backward = np.empty(n + 1, np.int64)
    backward[tree.tour(reverse=True)[0]] = np.arange(n + 1)
    at = np.concatenate([np.arange(n), np.arange(n)])
    q = np.concatenate([_lyndon(right.rank[:n]), _lyndon(backward[:n])])
    # a run's first root begins within its first period, so at least so much of the run is ahead of its copy
    good = np.flatnonzero((times * q <= n) & (at + q < n))
    good = good[x[at[good]] == x[at[good] + q[good]]]
    at, q = at[good], q[good]
    ahead = right.of(at, at + q)
    good = ahead > (times - 2) * q
    at, q, ahead = at[good], q[good], ahead[good]
    if not len(at):
        return []
    behind = np.zeros(len(at), np.int64)
    inner = np.flatnonzero(at > 0)
    if len(inner):
        left = Extensions(SuffixTree(x[::-1]))
        behind[inner] = left.of(n - at[inner], n - at[inner] - q[inner])
    length = behind + q + ahead
    good = length >= np.maximum(min_length, times * q)
    return list(zip((at - behind)[good].tolist(), length[good].tolist(), q[good].tolist()))


def word_runs(words: list, min_length: int = MIN_LENGTH, times: int = MIN_TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of a list of words, by start and then period."""
    least = max(min_length, times)
    if len(words) < least:
        return []
    numbers: dict = {}
    codes = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    found: set[tuple[int, int, int]] = set()
    open_stretches = [(0, codes)]
    while open_stretches:
        offset, x = open_stretches.pop()
        _, x, counts = np.unique(x, return_inverse=True, return_counts=True)
        often = counts[x] >= times
        if often.all():
            found.update((offset + s, n, q) for s, n, q in _stretch_runs(x + 1, min_length, times))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], often, [False]])))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if b - a >= least:
                open_stretches.append((offset + a, x[a:b]))
    return sorted(found, key=lambda run: (run[0], run[2]))


def _collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that a run holds after its first period."""
    if not runs:
        return " ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return " ".join([words[i] for i in np.flatnonzero(kept)])


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, times: int = MIN_TIMES
) -> DataFrame:
    """One row per document: its id, n_words, runs (array of start, length, period in words) and collapsed.

    Words are stretches without white space, numbered from 0. A run has at least ``min_length`` words and ``times``
    of its smallest period; runs come by start, then period. ``collapsed`` is the kept words with one space between:
    a word goes if a run holds it behind that run's first period.

    Each row is judged by itself, whatever its id: repeated rows and null ids come out as often as they go in. Null,
    empty and blank texts have no words, no runs and an empty ``collapsed``. Long texts are taken whole: a task holds
    the two trees of one stretch of repeated words at a time. Other columns are ignored; an empty table gives none.
    """
    rows = clean_columns(docs, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            begin, size, counts, all_runs, collapsed = 0, 0, [], [], []
            for i in range(len(texts)):
                own = _WORDS.findall(texts[i].as_py() or "")
                runs = word_runs(own, min_length, times)
                counts.append(len(own))
                all_runs.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                collapsed.append(_collapsed(own, runs))
                size += len(collapsed[-1])
                if size >= _CHUNK or i + 1 == len(texts):
                    columns = [pa.array(counts, pa.int64()), pa.array(all_runs, pa.list_(_RUN)), pa.array(collapsed, pa.string())]
                    names = [id_col, "n_words", "runs", "collapsed"]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, i + 1 - begin), *columns], names)
                    begin, size, counts, all_runs, collapsed = i + 1, 0, [], [], []

    return rows.mapInArrow(run, schema)


def with_tail_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text, where one document in ten has a tail that repeats the tail's first words.

    With h the checksum of the decimal id and g = h // 10, the documents with h % 10 = 0 and n > 0 words get, from
    word a = g % n on, the words a + (i - a) % p for p = 1 + (n - a) // (3 + g % 8). Others, and those without an id,
    keep their text.
    """
    rows = clean_columns(docs, id=id_col, text=text_col)
    h = F.crc32(F.col("id").cast("string").cast("binary"))
    rows = rows.select("id", "text", F.floor(h / 10).alias("g"), (h % 10 == 0).alias("hit"))

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = F.pmod(F.col("g"), n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.col("g") % 8))
        spots = let(F.struct(a.alias("a"), p.alias("p")), lambda v: F.transform(
            F.sequence(F.lit(0), n - 1), lambda i: F.when(i < v["a"], i).otherwise(v["a"] + F.pmod(i - v["a"], v["p"]))
        ))
        again = F.array_join(F.transform(spots, lambda i: F.get(w, i.cast("int"))), " ")
        return F.when(n == 0, F.col("text")).otherwise(again)

    tail = let(words(F.col("text")), repeated)
    text = F.when(F.col("hit") & F.col("text").isNotNull(), tail).otherwise(F.col("text"))
    return rows.select(F.col("id").alias(id_col), text.alias(text_col))
