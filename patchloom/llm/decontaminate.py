"""Benchmark decontamination: a prefix-filtered set join, verified exactly.

A benchmark item is cut into windows of ten words (an item with fewer words is
one window). A window occurs in a document only if all its words do, so one
necessary token, its rarest by the counts over all documents, is enough as the
prefix to join on. A document word that equals the prefix of a window fixes
where the window would have to stand; windows that would begin before or end
after the text are cut by position and length, and the rest are compared word
by word.

The benchmark is the stated query set. It is held in blocks of a bounded number
of characters; every block meets all documents in one more pass over the rows,
and no document leaves its task.

Defined results: a null or wordless text has no words and no hits; items without
words are ignored; the windows of an item without an id count as hits and name
no item in the query and in ``decontaminate``, and are ignored by ``match``
without ``nameless``; equal items each count; repeated rows give
repeated results; an empty benchmark contaminates nothing.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patchloom.llm.common import bytes_column, ids_only, table

WINDOW = 10
#: Characters of benchmark text that one pass holds in each Python worker: some
#: 40 bytes a word, and while the driver indexes a block some 200 for each window.
BLOCK_CHARS = 4_000_000
#: Windows that are compared with a document at once.
PROBES = 1_000_000

_WORD = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c in _WORD else 0x20 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z."""
    return text.translate(_FOLD).split() if text else []


def windows_of(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def blocks_of(benchmark: DataFrame, block_chars: int = BLOCK_CHARS, nameless: bool = False) -> Iterator[list[tuple[str | None, bytes]]]:
    """The benchmark's (item_id, text) in blocks of about block_chars."""
    items = benchmark.where("text IS NOT NULL" if nameless else "item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("string").alias("item_id"), "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_chars)
    for block in range(n):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block)
        yield [(r.item_id, r.text.encode()) for r in mine.toLocalIterator()]


def count_words(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """Occurrences in all documents of the words of one benchmark block."""
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, found = held.value, Counter()
        for batch in batches:
            for text in bytes_column(batch.column(0)):
                found.update([w for w in words_of(text) if w in known])
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["word", "n"])

    counted = ids_only(docs, "text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in counted.collect()}


class Index:
    """Windows of a benchmark block by their rarest word, as arrays.

    Words are numbered; a text is an array of numbers and a window a place in one,
    so a window takes some twenty bytes beside the words. Equal windows are one,
    with the items of all of them.
    """

    def __init__(self, items: list[tuple[str | None, bytes]], counts: dict[bytes, int], size: int = WINDOW):
        ids: dict[bytes, int] = {}
        texts = [np.array([ids.setdefault(w, len(ids)) for w in words_of(text)], np.int32) for _, text in items]
        rarity = np.array([counts.get(w, 0) for w in ids], np.int64)
        # a word's place by (count, word): the rarest word of a window is its least
        order = sorted(range(len(ids)), key=lambda i, names=list(ids): (rarity[i], names[i]))
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        known: dict[bytes, int] = {}
        at, where, prefix, owned = [], [], [], []
        start = 0
        for item, numbers in enumerate(texts):
            n = min(size, len(numbers))
            for i in range(len(numbers) - n + 1 if n else 0):
                window = numbers[i : i + n]
                w = known.setdefault(window.tobytes(), len(known))
                if w == len(at):
                    least = int(rank[window].argmin())
                    at.append(least)
                    where.append((start + i, n))
                    prefix.append(int(window[least]))
                if items[item][0] is not None:
                    owned.append((w, item))
            start += len(numbers)
        self.words = ids
        self.stream = np.concatenate(texts) if texts else np.zeros(0, np.int32)
        by_word = np.argsort(np.array(prefix, np.int64), kind="stable")
        place = np.empty(len(by_word), np.int64)
        place[by_word] = np.arange(len(by_word))
        self.at = np.array(at, np.uint8)[by_word]
        self.start, self.length = (np.array(x, np.int64)[by_word] for x in (list(zip(*where, strict=True)) or [(), ()]))
        self.first = np.searchsorted(np.array(prefix, np.int64)[by_word], np.arange(len(ids) + 1))
        pairs = np.array(sorted({(int(place[w]), item) for w, item in owned}), np.int64).reshape(-1, 2)
        self.owners = pairs[:, 1].astype(np.int32)
        self.owner_first = np.searchsorted(pairs[:, 0], np.arange(len(at) + 1))
        self.names = [item for item, _ in items]

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, int, list[str]]]:
        """(start, end, item ids) of every window that stands in words. All
        windows that a document's words are prefixes of are compared at once,
        word after word, some PROBES at a time."""
        numbers = np.fromiter(map(self.words.get, words, repeat(-1)), np.int32, len(words))
        at = np.flatnonzero(numbers >= 0)
        first = self.first[numbers[at]]
        count = self.first[numbers[at] + 1] - first
        at, first, count = at[count > 0], first[count > 0], count[count > 0]
        ends = np.cumsum(count)
        low = 0
        while low < len(at):
            done = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, done + PROBES, "right")))
            c = count[low:high]
            k = np.repeat(first[low:high] - (ends[low:high] - c - done), c) + np.arange(int(c.sum()))
            begin = np.repeat(at[low:high], c) - self.at[k]
            ok = (begin >= 0) & (begin + self.length[k] <= len(words))
            k, begin = k[ok], begin[ok]
            for d in range(int(self.length[k].max(initial=0))):
                inside = d < self.length[k]
                same = ~inside
                same[inside] = numbers[begin[inside] + d] == self.stream[self.start[k[inside]] + d]
                k, begin = k[same], begin[same]
            for start, w in zip(begin.tolist(), k.tolist(), strict=True):
                yield start, start + int(self.length[w]), [self.names[o] for o in self.owners[self.owner_first[w] : self.owner_first[w + 1]]]
            low = high


def merge_spans(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Sorted disjoint [start, end) spans with the same union."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


_ADDED = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hit_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
])


def match(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_chars: int = BLOCK_CHARS, nameless: bool = False) -> DataFrame:
    """docs with n_words, hit_spans (disjoint [start, end) word spans) and
    item_ids (sorted) of the benchmark windows that occur in the text.

    Columns of docs with these names are replaced.
    """
    spark = docs.sparkSession
    added = {f.name: F.lit(None).cast(f.dataType) for f in _ADDED}
    out = docs.withColumns(added)
    blocks = blocks_of(benchmark, block_chars, nameless)
    for items in blocks:
        vocabulary = {w for _, text in items for w in words_of(text)}
        held = spark.sparkContext.broadcast(Index(items, count_words(docs, vocabulary), size))
        out = out.mapInArrow(_joiner(held), out.schema)
    words = F.when(F.col("n_words").isNull(), F.lit(0)).otherwise(F.col("n_words"))
    return out.withColumns({"n_words": words, "hit_spans": F.coalesce("hit_spans", F.array().cast("array<array<int>>")), "item_ids": F.coalesce("item_ids", F.array().cast("array<string>"))})


def _joiner(held):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        for batch in batches:
            names = batch.schema.names
            spans_before = batch.column(names.index("hit_spans")).to_pylist()
            items_before = batch.column(names.index("item_ids")).to_pylist()
            counts, spans, items = [], [], []
            for text, s, ids in zip(bytes_column(batch.column(names.index("text"))), spans_before, items_before, strict=True):
                words = words_of(text)
                found = list(index.occurrences(words))
                counts.append(len(words))
                spans.append(merge_spans([*map(tuple, s or ()), *((a, b) for a, b, _ in found)]))
                items.append(sorted(set(ids or ()).union(*(x for _, _, x in found))))
            new = {"n_words": pa.array(counts, pa.int64()), "hit_spans": pa.array(spans, pa.list_(pa.list_(pa.int32()))), "item_ids": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(name, batch.column(i)) for i, name in enumerate(names)], names)

    return join


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no benchmark window occurs, with docs' columns.

    Where docs has no columns of the names that match adds, the rows that stay
    are the rows that came.
    """
    row = F.struct(*[F.col(c) for c in docs.columns])
    held = docs.select(row.alias("row"), F.col("text"))
    return match(held, benchmark, nameless=True).where(F.size("hit_spans") == 0).select("row.*")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ids_only(table(spark, sf_dir, "documents"), "doc_id", "text")
    found = match(docs, table(spark, sf_dir, "benchmark"), nameless=True)
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda acc, x: acc + (x[1] - x[0]).cast("long"))
    # UTF-8 strings sort by bytes in Python, Spark and DuckDB alike
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def brute_force(text: str | None, items: list[tuple[str, str]], size: int = WINDOW) -> tuple[int, int, list[str]]:
    """(n_words, n_hit, item ids) by comparing every window at every place."""
    words, hit, ids = words_of(text.encode() if text else None), set(), set()
    for item, other in items:
        for window in windows_of(words_of(other.encode()), size):
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit |= set(range(i, i + len(window)))
                    ids.add(item)
    return len(words), len(hit), sorted(ids)


def digest(ids: list[str]) -> str:
    return hashlib.sha256(",".join(ids).encode()).hexdigest()
