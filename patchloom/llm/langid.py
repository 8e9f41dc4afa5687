"""Language identification of mixed-language text.

Each word is scored for every learned language by its character trigrams. The
script of its letters narrows the candidates to the languages that were seen in
that script. A Viterbi pass over the words, with a penalty for each switch,
labels spans; a text's language is the one that holds most letters.

Learning counts trigrams (hashed, so bounded) of all training texts on the
executors. No id, source or label of a row is an input of its prediction.

Defined results: a null text, or one without a letter, is ``und`` with score 0
and no spans; so is every text if no training row has a language. Ties go to the
language that sorts first. Very long texts are read whole; a word of more than
``CACHED_LETTERS`` letters is scored each time it comes. Columns of the input
named like the added ones are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.llm.common import fold_of, ids_only, table

# fixed values: first and last code point of the scripts told apart
SCRIPTS = (
    ("latin", 0x0041, 0x02AF), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x06FF), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF),
    ("latin", 0x1E00, 0x1EFF), ("greek", 0x1F00, 0x1FFF), ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
)
NAMES = sorted({name for name, _, _ in SCRIPTS}) + ["other"]
_STARTS = np.array([a for _, a, _ in SCRIPTS])
_ENDS = np.array([b for _, _, b in SCRIPTS])
_CODE = np.array([NAMES.index(name) for name, _, _ in SCRIPTS])
_OTHER = len(NAMES) - 1

_WORD = re.compile(r"[^\W\d_]+")
BITS = 16
#: Letters of the longest word that a worker remembers, so its memory is bounded.
CACHED_LETTERS = 40
#: Distinct words that a learning task gathers before it counts their trigrams.
GATHERED_WORDS = 200_000


@dataclass(frozen=True)
class Config:
    folds: int = 3
    held_fold: int = 1
    switch_penalty: float = 12.0
    smoothing: float = 0.5
    #: Words that a Python worker remembers; the memory starts anew when full.
    cache_words: int = 200_000


@dataclass
class Model:
    config: Config
    langs: list[str]
    scores: np.ndarray  # (2 ** BITS, languages): log probability of a trigram
    allowed: np.ndarray  # (scripts, languages): seen in training
    #: The worker's memory: a word's row in known.
    cache: dict[str, int] = field(default_factory=dict)
    known: np.ndarray | None = None

    def __getstate__(self):
        return {**self.__dict__, "cache": {}, "known": None}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def script_of(word: str) -> int:
    code = ord(word[0])
    i = int(np.searchsorted(_STARTS, code, "right")) - 1
    return int(_CODE[i]) if i >= 0 and code <= _ENDS[i] else _OTHER


def trigram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the trigrams of ``<word>``, word after word, and the number
    of trigrams of each word (its number of letters)."""
    codes = np.frombuffer(f"<{'><'.join(words)}>".encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    h = codes[:-2] * np.uint32(0x85EBCA6B)
    h ^= codes[1:-1] * np.uint32(0xC2B2AE35)
    h = (h << np.uint32(13) | h >> np.uint32(19)) + codes[2:] * np.uint32(0x27D4EB2F)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    # a word of n letters takes n + 2 places; its last two begin no trigram of it
    ends = np.cumsum(lengths + 2)
    keep = np.ones(len(codes), bool)
    keep[ends - 1] = keep[ends - 2] = False
    return (h >> np.uint32(32 - BITS))[keep[:-2]].astype(np.int64), lengths


def fit(docs: DataFrame, config: Config = Config()) -> Model:
    """Learns from text and lang of the documents outside the held-out fold."""
    train = docs.where("lang IS NOT NULL AND text IS NOT NULL").where(fold_of("doc_id", config.folds) != config.held_fold)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}

        def add(lang: str, counted: Counter) -> None:
            """A distinct word's trigrams are hashed once, and count as often as it."""
            if lang not in grams:
                grams[lang], scripts[lang] = np.zeros(1 << BITS, np.int64), np.zeros(len(NAMES), np.int64)
            times = np.fromiter(counted.values(), np.int64, len(counted))
            buckets, lengths = trigram_buckets(list(counted))
            grams[lang] += np.bincount(buckets, np.repeat(times, lengths), minlength=1 << BITS).astype(np.int64)
            first = np.frombuffer("".join(w[0] for w in counted).encode("utf-32-le", "surrogatepass"), np.uint32)
            i = np.maximum(np.searchsorted(_STARTS, first, "right") - 1, 0)
            found = np.where((first >= _STARTS[i]) & (first <= _ENDS[i]), _CODE[i], _OTHER)
            scripts[lang] += np.bincount(found, times, minlength=len(NAMES)).astype(np.int64)
            counted.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if found := words_of(text):
                    mine = words.setdefault(lang, Counter())
                    mine.update(found)
                    if len(mine) > GATHERED_WORDS:
                        add(lang, mine)
        for lang, counted in words.items():
            if counted:
                add(lang, counted)
        for lang, vector in grams.items():
            both = np.concatenate([vector, scripts[lang]])
            at = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(both[at])], ["lang", "bucket", "n"])

    counted = ids_only(train, "text", "lang").mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    lang_of, bucket, n = counted.column("lang").to_pylist(), counted.column("bucket").to_numpy(), counted.column("n").to_numpy()
    langs = sorted(set(lang_of))
    place = {lang: i for i, lang in enumerate(langs)}
    counts = np.zeros(((1 << BITS) + len(NAMES), max(1, len(langs))))
    if langs:
        counts[bucket, [place[x] for x in lang_of]] = n
    grams, scripts = counts[: 1 << BITS], counts[1 << BITS :]
    scores = np.log((grams + config.smoothing) / (grams.sum(0) + config.smoothing * (1 << BITS)))
    return Model(config, langs, scores.astype(np.float32), scripts >= np.maximum(1, scripts.sum(0) * 1e-4))


def _scored(words: list[str], model: Model) -> np.ndarray:
    """(words, languages) log probabilities of distinct words."""
    buckets, lengths = trigram_buckets(words)
    sums = np.add.reduceat(model.scores[buckets], np.cumsum(lengths) - lengths, axis=0)
    ok = model.allowed[[script_of(w) for w in words]]
    # outside the candidates a word counts as one of unknown trigrams
    some = ok.any(axis=1, keepdims=True)
    return np.where(ok | ~some, sums, sums.min(axis=1, keepdims=True) - 8.0).astype(np.float32)


def word_scores(words: list[str], model: Model) -> np.ndarray:
    """(words, languages) log probabilities; words in the worker's memory aren't
    scored again. The memory starts anew when it is full."""
    place, size = model.cache, model.config.cache_words
    distinct = dict.fromkeys(words)
    new = [w for w in distinct if w not in place]
    if len(place) + len(new) > size:
        place.clear()
        new = list(distinct)
    if model.known is None:
        model.known = np.empty((size, len(model.langs)), np.float32)
    known = model.known
    if new:
        rows = _scored(new, model)
        if len(new) > size or max(map(len, new)) > CACHED_LETTERS:  # beside the memory
            old = [w for w in distinct if w in place]
            known = np.concatenate([rows, known[[place[w] for w in old]]]) if old else rows
            place = {w: i for i, w in enumerate([*new, *old])}
        else:
            at = len(place)
            known[at : at + len(new)] = rows
            place.update((w, at + i) for i, w in enumerate(new))
    return known[np.fromiter(map(place.__getitem__, words), np.int64, len(words))]


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """Best language of each word, with a penalty for each switch.

    One label for all words is optimal, and no table is filled, if against the
    language that is best overall (1) no stretch of words gains more than the
    penalty in another language and (2) the best beginning and the best ending
    don't do so together. For, of a path's foreign stretches, m side by side
    cost m switches or more wherever they touch a word in the best language,
    and gain at most as much by (1). Only m of 2 or more that fill the text cost
    m - 1: the inner ones gain at most m - 2 penalties by (1), and the first and
    the last one by (2).
    """
    n, k = scores.shape
    best = int(scores.sum(0, dtype=np.float64).argmax())
    gains = np.zeros((n + 1, k))
    np.cumsum(scores - scores[:, best : best + 1], axis=0, dtype=np.float64, out=gains[1:])
    stretch = (gains - np.minimum.accumulate(gains, axis=0)).max()
    if stretch <= penalty and gains.max() + (gains[-1] - gains).max() <= penalty:
        return np.full(n, best)
    # few languages: plain lists are quicker than arrays of their number
    rows, back = scores.astype(np.float64).tolist(), []
    total = rows[0]
    for row in rows[1:]:
        most = max(total)
        floor, top = most - penalty, total.index(most)
        back.append([top if t < floor else -1 for t in total])  # -1: no switch
        total = [(floor if t < floor else t) + s for t, s in zip(total, row, strict=True)]
    at = total.index(max(total))
    path = [at]
    for before in reversed(back):
        at = at if before[at] < 0 else before[at]
        path.append(at)
    return np.array(path[::-1])


def label(text: str | None, model: Model) -> tuple[str, float, list[tuple[int, int, str]]]:
    """(language, score, spans of words [start, end, language))."""
    words = words_of(text)
    if not words or not model.langs or not any(map(str.isalpha, words)):
        return "und", 0.0, []
    scores = word_scores(words, model)
    path = viterbi(scores, model.config.switch_penalty)
    letters = np.bincount(path, np.fromiter(map(len, words), np.float64, len(words)), minlength=len(model.langs))
    lang = int(letters.argmax())
    cuts = np.flatnonzero(np.diff(path)) + 1
    bounds = [0, *cuts.tolist(), len(words)]
    spans = [(a, b, model.langs[path[a]]) for a, b in zip(bounds, bounds[1:], strict=False)]
    # how sure: the share of letters times the probability against the others
    margin = scores[path == lang].sum(0, dtype=np.float64)
    sure = 1 / np.exp(np.clip(margin - margin[lang], -50, 50)).sum()
    return model.langs[lang], float(sure * letters[lang] / letters.sum()), spans


def identify(docs: DataFrame, model: Model, with_spans: bool = True) -> DataFrame:
    """docs with lang_pred, score, n_spans and (unless switched off) spans, the
    stretches [start, end) of words in one language."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("lang_pred", "score", "n_spans", "spans")
    span = "array<struct<start:int,end:int,lang:string>>"
    added = {"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0), "n_spans": F.lit(0)} | ({"spans": F.lit(None).cast(span)} if with_spans else {})
    new_names = list(added)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            found = [label(t, held.value) for t in batch.column(names.index("text")).to_pylist()]
            columns = [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([len(x[2]) for x in found], pa.int32())]
            if with_spans:
                columns.append(pa.array([[dict(zip(("start", "end", "lang"), s, strict=True)) for s in x[2]] for x in found], kind))
            yield pa.RecordBatch.from_arrays(columns, [*names, *new_names])

    return kept.mapInArrow(run, kept.withColumns(added).schema)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = Config()
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, config)
    held_out = fold_of("doc_id", config.folds) == config.held_fold
    return identify(ids_only(docs, "doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "n_spans", "spans")
