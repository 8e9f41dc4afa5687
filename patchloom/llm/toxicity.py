"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes
log-count ratios, trained on labelled text.

A text's features are the distinct hashed character n-grams of its lower-cased
whole text. Each is scaled by the log ratio of its smoothed share among toxic
and other training texts; logistic regression is fitted on the scaled features.
A feature counts if its two shares differ by more than ``least_errors`` standard
errors: less is what chance does, at any size of the sample. No other feature is
left out, and their number follows the texts.

Labelled training rows are bounded by ``Config.rows_per_class`` for each class,
those with the smallest hash of their id; this bound makes the ids safe to
broadcast, and the fit, which runs on the driver, as long at every size of the
input. Everything else covers all rows and whole texts.

Defined results: a null or empty text has no n-grams and gets the model's
intercept; null labels are ignored; an id labelled twice counts as toxic if one
label says so; without training rows of both classes every score is 0.5 (no
toxic text is known) and nothing is predicted toxic.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.llm.common import fold_of, ids_only, materialise, table


#: Features of training rows that the fit works on at once.
HELD = 1_000_000


@dataclass(frozen=True)
class Config:
    orders: tuple[int, ...] = (3, 4, 5)
    bits: int = 18
    rows_per_class: int = 3000
    least_errors: float = 1.75
    smoothing: float = 1.0
    l2: float = 2e-3
    steps: int = 300
    folds: int = 3
    held_fold: int = 1
    threshold: float = 0.7


@dataclass(frozen=True)
class Model:
    """Weight of each hash bucket (0: not a feature) and the intercept."""

    config: Config
    weights: np.ndarray
    intercept: float


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, end to end, and their offsets."""
    parts = [f" {t.lower()} " if t else "" for t in texts]
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def _buckets(codes: np.ndarray, order: int, bits: int) -> np.ndarray:
    """Bucket of the n-gram that begins at each place (the last ones are cut)."""
    h = np.full(len(codes) - order + 1, 0x9E3779B9 * order & 0xFFFFFFFF, np.uint32)
    for i in range(order):
        h ^= codes[i : len(h) + i]
        h *= np.uint32(0x01000193)
        h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(32 - bits)


def _present(texts: list[str | None], config: Config, wanted: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) pairs, each once, of the wanted buckets in each text."""
    codes, offsets = _codes(texts)
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(offsets))
    keys = []
    for order in config.orders:
        if len(codes) < order:
            continue
        bucket = _buckets(codes, order, config.bits)
        n = len(bucket)
        inside = owner[:n] == owner[order - 1 :]
        at = np.flatnonzero(inside if wanted is None else inside & wanted[bucket])
        keys.append(owner[at] << config.bits | bucket[at].astype(np.int64))
    found = np.unique(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
    return found >> config.bits, found & ((1 << config.bits) - 1)


def _sample(docs: DataFrame, labels: DataFrame, config: Config) -> DataFrame:
    """text, toxic of the bounded training rows, written once."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where((fold_of("doc_id", config.folds) != config.held_fold) & F.col("toxic").isin(0, 1))
    rank = F.xxhash64("doc_id")
    picked = [known.where(F.col("toxic") == c).orderBy(rank, "doc_id").limit(config.rows_per_class) for c in (0, 1)]
    # at most 2 * rows_per_class ids: a fixed size, whatever the input
    return materialise(docs.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id").select("text", "toxic"), "toxicity-sample")


def _count(sample: DataFrame, config: Config) -> tuple[np.ndarray, np.ndarray]:
    """Texts of each class that hold a bucket: two vectors of 2 ** bits."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << config.bits), np.int64)
        for batch in batches:
            row, bucket = _present(batch.column(0).to_pylist(), config, None)
            label = np.asarray(batch.column(1).to_pylist(), np.int64)
            for c in (0, 1):
                total[c] += np.bincount(bucket[label[row] == c], minlength=1 << config.bits)
        at = np.flatnonzero(total.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], ["bucket", "clean", "toxic"])

    rows = sample.mapInArrow(count, "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    out = np.zeros((2, 1 << config.bits))
    at = rows.column("bucket").to_numpy()
    out[0, at], out[1, at] = rows.column("clean").to_numpy(), rows.column("toxic").to_numpy()
    return out[0], out[1]


def _features(sample: DataFrame, config: Config, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature) of the wanted features that training rows hold, features
    numbered by bucket, and the rows' labels."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, bucket = _present(batch.column(0).to_pylist(), config, wanted)
            cuts = np.searchsorted(row, np.arange(batch.num_rows + 1))
            held = [bucket[a:b].astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(held, pa.binary())], ["toxic", "held"])

    got = sample.mapInArrow(rows, "toxic int, held binary").orderBy("toxic", "held").toArrow()
    held, y = got.column("held").to_pylist(), got.column("toxic").to_numpy().astype(np.float64)
    del got
    row = np.repeat(np.arange(len(held), dtype=np.int32), [len(x) // 4 for x in held])
    feature = np.frombuffer(b"".join(held), np.int32)
    del held
    return row, (np.cumsum(wanted, dtype=np.int32) - 1)[feature], y


def fit(docs: DataFrame, labels: DataFrame, config: Config = Config()) -> Model:
    """Learns from labelled rows outside the held-out fold."""
    weights = np.zeros(1 << config.bits, np.float32)
    sample = _sample(docs, labels, config)
    clean, toxic = _count(sample, config)
    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Model(config, weights, 0.0)
    a = config.smoothing
    p, q = (toxic + a) / (sizes[1] + 2 * a), (clean + a) / (sizes[0] + 2 * a)
    ratio = np.log(p / q)
    spread = np.abs(p - q) / np.sqrt(p * (1 - p) / sizes[1] + q * (1 - q) / sizes[0] + 1e-9)
    wanted = spread > config.least_errors
    row, feature, y = _features(sample, config, wanted)
    n, k = len(y), int(wanted.sum())
    scale = ratio[wanted]
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    w, b, gw, gb = np.zeros(k), 0.0, np.full(k, 1e-8), 1e-8
    parts = [slice(at, at + HELD) for at in range(0, len(row), HELD)]
    for _ in range(config.steps):
        scaled, z, dw = w * scale, np.full(n, b), np.zeros(k)
        for p in parts:
            z += np.bincount(row[p], scaled[feature[p]], minlength=n)
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * share
        for p in parts:
            dw += np.bincount(feature[p], err[row[p]], minlength=k)
        dw, db = dw * scale + config.l2 * w, float(err.sum())
        gw += dw * dw
        gb += db * db
        w -= 0.1 * dw / np.sqrt(gw)
        b -= 0.1 * db / np.sqrt(gb)
    weights[wanted] = w * ratio[wanted]
    return Model(config, weights, float(b))


def score_texts(texts: list[str | None], model: Model) -> np.ndarray:
    row, bucket = _present(texts, model.config, model.weights != 0)
    z = np.bincount(row, model.weights[bucket], minlength=len(texts)) + model.intercept
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with ``score`` (0 to 1, higher: likelier toxic), row by row."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("score")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            text = batch.column(names.index("text"))
            found = np.concatenate([score_texts(text.slice(i, 512).to_pylist(), held.value) for i in range(0, len(text), 512)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*names, "score"])

    return kept.mapInArrow(run, kept.withColumn("score", F.lit(0.0)).schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = Config()
    docs = ids_only(table(spark, sf_dir, "documents"), "doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), config)
    held_out = fold_of("doc_id", config.folds) == config.held_fold
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= config.threshold).cast("int").alias("predicted"))
