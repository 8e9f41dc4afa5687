"""SentencePiece encoding and decoding with a given model file.

An Aho-Corasick automaton over the pieces is run once over a text; at each
place its matches, longest first along the output links, relax the best score
of a Viterbi table. Where no piece ends at a place, the character there falls
back to its UTF-8 bytes.

No piece of the model holds the space mark behind another character, so the
best path of a text is the best paths of its runs ``marks + other characters``
one after another, and a run is encoded once for each worker's memory.

A unigram model's scores are log probabilities and add up along a path. A BPE
model's scores only rank its merges: of a path, every two neighbours must stay
apart when their characters are merged by rank. For such a model a step of the
Viterbi table is open only between two such pieces, and the one open path is the
model's own segmentation. Which pairs stay apart is remembered by each worker.

Defined results: null and empty texts encode to no ids; the mark U+2581 in a
text decodes to a space, as in the format itself; everything else, however
long, decodes to exactly the same text. Ties take the longer last piece.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.llm.common import ids_only, table

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
NORMAL, UNKNOWN, USER, BYTE = 1, 2, 4, 6
#: Runs that a Python worker remembers; the memory starts anew when full.
CACHE_RUNS = 400_000
#: Pairs of pieces that it remembers.
CACHE_PAIRS = 600_000

_RUN = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


@dataclass(frozen=True)
class Model:
    """Pieces, scores and kinds by id, and the normaliser's two switches."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[int, ...]
    dummy_prefix: bool
    unknown: int
    by_merges: bool


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            shift += 7
            if byte < 0x80:
                return value

    while at < len(data):
        key = varint()
        width = {0: 0, 1: 8, 5: 4}.get(key & 7)
        if width == 0:
            yield key >> 3, varint()
            continue
        size = varint() if width is None else width
        yield key >> 3, data[at : at + size]
        at += size


def read_model(data: bytes) -> Model:
    """Reads a model file's bytes; only the identity normaliser is supported."""
    pieces, scores, kinds, prefix, by_merges = [], [], [], True, False
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append(piece[1].decode())
            scores.append(struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0])
            kinds.append(piece.get(3, NORMAL))
        elif number == 2:
            by_merges = dict(_fields(value)).get(3, 1) == 2  # the trainer's model type
        elif number == 3:
            rules = dict(_fields(value))
            if rules.get(2) or rules.get(4, 1):
                raise ValueError("the model's normaliser changes texts; only the identity is supported")
            prefix = bool(rules.get(3, 1))
    if any(MARK in p.lstrip(MARK) for p, k in zip(pieces, kinds, strict=True) if k in (NORMAL, USER)):
        raise ValueError("a piece holds the space mark behind another character")
    return Model(tuple(pieces), tuple(scores), tuple(kinds), prefix, kinds.index(UNKNOWN), by_merges)


class Codec:
    """Encoder and decoder of one model; built once in each worker."""

    def __init__(self, model: Model):
        import ahocorasick

        self.model = model
        self.automaton = ahocorasick.Automaton()
        self.byte_ids = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(model.pieces, model.kinds, strict=True)) if k == BYTE}
        for i, (piece, score, kind) in enumerate(zip(model.pieces, model.scores, model.kinds, strict=True)):
            if kind in (NORMAL, USER):
                self.automaton.add_word(piece, (len(piece), i, score))
        self.automaton.make_automaton()
        self.fallback = min(s for s, k in zip(model.scores, model.kinds, strict=True) if k == NORMAL) - 10.0
        self.outputs = [bytes([int(p[3:5], 16)]) if k == BYTE else p.encode() if k in (NORMAL, USER) else b"" for p, k in zip(model.pieces, model.kinds, strict=True)]
        self.rank = {p: s for p, s, k in zip(model.pieces, model.scores, model.kinds, strict=True) if k in (NORMAL, USER)}
        self.apart: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """Characters merged by rank, the best pair first, the leftmost of
        equals, until no neighbours form a piece."""
        parts = list(text)
        while True:
            pairs = [(-self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.rank]
            if not pairs:
                return parts
            at = min(pairs)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def open(self, before: int, piece: int, key: int) -> bool:
        """Whether the path may step from one piece (or -1, anything that no
        piece can hold) to another; remembered under key."""
        if len(self.apart) >= CACHE_PAIRS:
            self.apart.clear()
        expected = [self.model.pieces[i] for i in (before, piece) if i >= 0]
        found = self.apart[key] = self.merged("".join(expected)) == expected
        return found

    def _by_bytes(self, char: str) -> list[int]:
        return [self.byte_ids.get(b, self.model.unknown) for b in char.encode()]

    def best_path(self, run: str) -> list[int]:
        """Ids of the best path over one run: one pass of the automaton."""
        n, low = len(run), self.fallback
        if self.model.by_merges:
            start, last = self._open_path(run, n)
        else:
            best, start, last = [0.0] + [float("-inf")] * n, [0] * (n + 1), [-1] * (n + 1)
            closed = 0  # places up to here have their final score
            for end, (size, piece, score) in [*self.automaton.iter(run), (n, (0, -1, 0.0))]:
                while closed < end:
                    closed += 1
                    if best[closed] == float("-inf"):
                        best[closed], start[closed] = best[closed - 1] + low, closed - 1
                if size and (total := best[end + 1 - size] + score) > best[end + 1]:
                    best[end + 1], start[end + 1], last[end + 1] = total, end + 1 - size, piece
        ids: list[int] = []
        while n:
            ids += [last[n]] if last[n] >= 0 else self._by_bytes(run[start[n] : n])[::-1]
            n = start[n]
        return ids[::-1]

    def _open_path(self, run: str, n: int) -> tuple[list[int], list[int]]:
        """The same pass where every place has one open step at most: a place
        that has it isn't relaxed again."""
        start, last, apart = [-1] * (n + 1), [-1] * (n + 1), self.apart
        start[0] = closed = 0
        for end, (size, piece, _) in self.automaton.iter(run):
            if start[end + 1] >= 0:
                continue
            while closed < end:
                closed += 1
                if start[closed] < 0:
                    start[closed] = closed - 1
            before = last[end + 1 - size]
            key = before << 32 | piece
            ok = apart.get(key)
            if self.open(before, piece, key) if ok is None else ok:
                start[end + 1], last[end + 1] = end + 1 - size, piece
        while closed < n:
            closed += 1
            if start[closed] < 0:
                start[closed] = closed - 1
        return start, last

    def encode(self, text: str | None) -> np.ndarray:
        """Ids (int32) of a whole text."""
        if not text:
            return np.zeros(0, np.int32)
        runs = _RUN.findall((MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK))
        cache = self.cache
        new = {r for r in runs if r not in cache}
        if len(cache) + len(new) > CACHE_RUNS:
            cache.clear()
            new = set(runs)
        for run in new:
            cache[run] = np.array(self.best_path(run), np.int32).tobytes()
        return np.frombuffer(b"".join([cache[r] for r in runs]), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        outputs = self.outputs
        text = b"".join([outputs[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


_codecs: dict[int, Codec] = {}


def _codec(held) -> Codec:
    """The worker's codec of a broadcast model."""
    if held.value is not getattr(_codecs.get(0), "model", None):
        _codecs[0] = Codec(held.value)
    return _codecs[0]


def load(path: str = MODEL_PATH) -> Model:
    with open(path, "rb") as f:
        return read_model(f.read())


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int32()))


def encode(docs: DataFrame, model: Model) -> DataFrame:
    """docs with ``ids`` (array<int>), row by row; an older ``ids`` goes."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(held)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                names = batch.schema.names
                ids = [codec.encode(t) for t in batch.column(names.index("text")).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, _lists(ids)], [*names, "ids"])

    return kept.mapInArrow(run, kept.withColumn("ids", F.lit(None).cast("array<int>")).schema)


def decode(rows: DataFrame, model: Model, column: str = "decoded") -> DataFrame:
    """rows (with ``ids``) with the text that the ids stand for; null ids give
    a null text."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    kept = rows.drop(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(held)
        for batch in batches:
            names = batch.schema.names
            ids = batch.column(names.index("ids"))
            offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy()
            known = ids.is_valid().to_pylist()
            texts = [codec.decode(values[a:b]) if ok else None for a, b, ok in zip(offsets, offsets[1:], known, strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, column])

    return kept.mapInArrow(run, kept.withColumn(column, F.lit(None).cast("string")).schema)


def op6_sentencepiece(spark: SparkSession, sf_dir: str, path: str = MODEL_PATH) -> DataFrame:
    """Ids of every text, and whether they decode to the text again."""
    model = load(path)
    docs = ids_only(table(spark, sf_dir, "documents"), "doc_id", "text")
    same = F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), MARK, " ")
    return decode(encode(docs, model), model).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), same.alias("round_trip"), "ids")
