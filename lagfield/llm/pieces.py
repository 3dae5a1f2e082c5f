"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model file is read as protobuf wire data, and the parts of a tokenizer are rebuilt from it: the normaliser, the
white-space marker, byte fallback, and the model itself, unigram scores or the merges that the scores of a BPE model
imply. A worker encodes batches on several threads.

If no piece has the marker behind another character and the normaliser changes nothing, merges never cross from one
"spaces and word" chunk to the next. Then a worker encodes each different chunk once and checks
it once against the reference library, which checks every whole text. Other models encode whole texts.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from lagfield.llm.common import clean_columns

# fixed values: kinds of pieces and models in the file format, and the marker that stands for a space
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
MARK = "▁"
# Texts encoded together, in characters; only a matter of memory.
CHUNK = 2_000_000
# Chunks a worker remembers.
KNOWN_CHUNKS = 400_000
# New chunks encoded in a row.
ROW = 256
_CHUNKS = re.compile(" +[^ ]*").findall


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one protobuf message."""
    at, end = 0, len(data)

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    while at < end:
        tag, at = varint(at)
        kind = tag & 7
        if kind == 0:
            value, at = varint(at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"unknown wire type {kind}")
        yield tag >> 3, value


@dataclass(frozen=True)
class PieceModel:
    """What a model file says: pieces with scores and kinds, and how texts are prepared."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    model_type: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    trim_spaces: bool

    @property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)

    @property
    def by_chunk(self) -> bool:
        """True if no merge can cross from the end of a word to the space behind it."""
        plain = not self.charsmap and not self.trim_spaces and self.dummy_prefix
        return plain and self.model_type == BPE and not any(re.search(f"[^{MARK}]{MARK}", p) for p in self.pieces)


def parse_model(data: bytes) -> PieceModel:
    """Read a model file: pieces are field 1, trainer and normaliser settings fields 2 and 3."""
    pieces, scores, kinds = [], [], []
    model_type, byte_fallback = UNIGRAM, False
    charsmap, dummy_prefix, trim_spaces = b"", True, True
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode("utf-8")
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            pieces.append(piece)
            scores.append(score)
            kinds.append(kind)
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    model_type = v
                elif n == 35:
                    byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    charsmap = v
                elif n == 3:
                    dummy_prefix = bool(v)
                elif n == 4:
                    trim_spaces = bool(v)
    return PieceModel(
        tuple(pieces), tuple(scores), tuple(kinds), model_type, byte_fallback, charsmap, dummy_prefix, trim_spaces
    )


def merges_of(model: PieceModel) -> list[tuple[str, str]]:
    """The merges a BPE model implies: any two pieces that join to a piece, best score of the result first."""
    usable = {p: i for i, p in enumerate(model.pieces) if model.kinds[i] in (NORMAL, USER_DEFINED)}
    found = []
    for piece, i in usable.items():
        for cut in range(1, len(piece)):
            left, right = piece[:cut], piece[cut:]
            if left in usable and right in usable:
                found.append((-model.scores[i], i, usable[left], usable[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def build_tokenizer(model: PieceModel) -> Tokenizer:
    """A tokenizer with the ids of the model file."""
    if model.model_type == UNIGRAM:
        inner = models.Unigram(list(zip(model.pieces, model.scores)), model.unknown, model.byte_fallback)
    elif model.model_type == BPE:
        inner = models.BPE(
            vocab={p: i for i, p in enumerate(model.pieces)}, merges=merges_of(model),
            unk_token=model.pieces[model.unknown], fuse_unk=True, byte_fallback=model.byte_fallback,
        )
    else:
        raise ValueError(f"model type {model.model_type} has no counterpart")
    tokenizer = Tokenizer(inner)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.trim_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK))
    steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    undo = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        undo.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(undo)
    return tokenizer


class _Known(dict):
    """Numbers of the chunks seen by a worker; arrays hold their ids and checks."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []
        self.flat = np.empty(0, np.int32)
        self.counts = np.empty(0, np.int64)
        self.good, self.whole = np.empty(0, bool), np.empty(0, bool)

    def __missing__(self, chunk: str) -> int:
        code = self[chunk] = len(self)
        self.new.append(chunk)
        return code

    def add(self, ids: list[np.ndarray], good: np.ndarray, whole: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, *ids])
        self.counts = np.concatenate([self.counts, np.array([len(i) for i in ids], np.int64)])
        self.good, self.whole = np.concatenate([self.good, good]), np.concatenate([self.whole, whole])
        self.new = []


class Codec:
    """Encoder and decoder of one model file, with the reference library beside it for parity."""

    def __init__(self, data: bytes) -> None:
        import sentencepiece

        self.model = parse_model(data)
        self.tokenizer = build_tokenizer(self.model)
        self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.known = _Known()
        self.by_chunk = self.model.by_chunk
        self.marked = np.array([p.startswith(MARK) for p in self.model.pieces], bool)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Ids of each text, whether the reference library gives the same, whether they decode to the text."""
        plain = [t.replace(MARK, " ") for t in texts]
        if not self.by_chunk:
            ids = self._ids(texts)
            same = np.array([a == b for a, b in zip(ids, self.reference.encode(texts, num_threads=1))], bool)
            back = np.array([a == b for a, b in zip(self.decode(ids), plain)], bool)
            return [np.array(i, np.int32) for i in ids], same, back
        # A space goes before the text, as the tokenizer adds one; each chunk is spaces and then a word.
        parts = [_CHUNKS(" " + t) if t else [] for t in plain]
        ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        if len(self.known) > KNOWN_CHUNKS:
            self.known = _Known()
        codes = np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), np.int64, int(ends[-1]))
        known = self._learned()

        lengths = known.counts[codes]
        before = np.cumsum(lengths) - lengths
        steps = np.arange(int(lengths.sum())) - np.repeat(before, lengths)
        tokens = known.flat[np.repeat((np.cumsum(known.counts) - known.counts)[codes], lengths) + steps]
        cuts = np.concatenate([[0], np.cumsum(lengths)])[ends]
        clear = lambda ok: np.diff(np.concatenate([[0], np.cumsum(~ok[codes])])[ends]) == 0
        return [tokens[a:b] for a, b in zip(cuts[:-1], cuts[1:])], clear(known.good), clear(known.whole)

    def _learned(self) -> _Known:
        """The known chunks, after the new ones are encoded, decoded and compared with the reference.

        Chunks of one space and a word are encoded many in a row, as nothing merges across them; a token with the
        marker in front begins the next one. A row that does not come out as expected is redone chunk by chunk.
        """
        known, new = self.known, self.known.new
        if not new:
            return known
        n = len(new)
        ids: list = [None] * n
        good, whole = np.ones(n, bool), np.ones(n, bool)
        plain = [i for i, c in enumerate(new) if len(c) > 1 and c[1] != " "]
        apart = [i for i, c in enumerate(new) if not (len(c) > 1 and c[1] != " ")]
        rows = [plain[i : i + ROW] for i in range(0, len(plain), ROW)]
        texts = ["".join([new[i] for i in row])[1:] for row in rows]
        found = self._ids(texts)
        same = [a == b for a, b in zip(found, self.reference.encode(texts, num_threads=1))]
        back = [a == b for a, b in zip(self.decode(found), texts)]
        for row, tokens, ok in zip(rows, found, [a and b for a, b in zip(same, back)]):
            tokens = np.array(tokens, np.int32)
            begins = np.flatnonzero(self.marked[tokens])
            if not ok or len(begins) != len(row):
                apart += row
                continue
            cuts = [*begins.tolist(), len(tokens)]
            for i, a, b in zip(row, cuts, cuts[1:]):
                ids[i] = tokens[a:b]
        if apart:
            bare = [new[i][1:] for i in apart]
            each = self._chunk_ids(bare, self._ids)
            other = self._chunk_ids(bare, lambda x: self.reference.encode(x, num_threads=1))
            for i, own, ref, text, again in zip(apart, each, other, bare, self.decode(each)):
                ids[i], good[i], whole[i] = np.array(own, np.int32), own == ref, text == again
        known.add(ids, good, whole)
        return known

    def _chunk_ids(self, bare: list[str], encode) -> list[list[int]]:
        """Ids of chunks given without their first space; a lone space has no text behind it to encode."""
        filled = [i for i, c in enumerate(bare) if c]
        lone = [self.model.pieces.index(MARK)] if MARK in self.model.pieces else []
        ids: list[list[int]] = [lone] * len(bare)
        for i, found in zip(filled, encode([bare[i] for i in filled])):
            ids[i] = found
        return ids

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)


@lru_cache(maxsize=2)
def _codec(data: bytes) -> Codec:
    return Codec(data)


def read_model(path: str) -> bytes:
    """The model file; like any tokenizer file it is small and the same for all tasks."""
    with open(path, "rb") as file:
        return file.read()


def _batches(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= CHUNK:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode(docs: DataFrame, model: bytes, text_col: str = "text", digest: bool = False) -> DataFrame:
    """The rows with their tokens.

    Added columns, which replace any of the same name: tokens (array of ids; with ``digest`` their hash
    ``tokens_hash`` instead), n_tokens, parity (the ids are those of the reference library) and round_trip (decoding
    gives the text back, with the marker read as a space). Null and empty texts have no tokens.
    """
    added = ["tokens_hash" if digest else "tokens", "n_tokens", "parity", "round_trip"]
    kept = [c for c in docs.columns if c.lower() not in added]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[f"`{c}`" for c in kept]).schema)
    schema += f", {added[0]} {'string' if digest else 'array<int>'}, n_tokens long, parity boolean, round_trip boolean"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(model)
        for frame in frames:
            texts = [t if isinstance(t, str) else "" for t in frame[text_col]]
            for a, b in _batches(texts):
                part = texts[a:b]
                ids, same, back = codec.encode(part)
                out = frame.iloc[a:b].copy()
                out[added[0]] = [xxhash.xxh3_128_hexdigest(i.tobytes()) for i in ids] if digest else ids
                out["n_tokens"] = [len(i) for i in ids]
                out["parity"] = same
                out["round_trip"] = back
                yield out

    return docs.select(*[f"`{c}`" for c in kept]).mapInPandas(run, schema)


def decode(tokens: DataFrame, model: bytes, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """Texts of token lists: id and text. Null and empty lists give an empty text."""
    rows = clean_columns(tokens, id=id_col, tokens=tokens_col)
    kind = rows.schema["id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = _codec(model)
        for frame in frames:
            lists = [[int(i) for i in t] if t is not None else [] for t in frame["tokens"]]
            yield pd.DataFrame({id_col: frame["id"], "text": codec.decode(lists)})

    return rows.mapInPandas(run, f"`{id_col}` {kind}, text string")
