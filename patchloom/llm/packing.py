"""Training-order materialisation of token ids in fixed-stride shards.

Whole texts are tokenised, closed with the end id and cut into sequences of
``Config.length`` ids. The sequences are written once; a row's place in that
table is its index. A keyed Feistel network over the next even number of bits,
walked on until it falls below the number of sequences, permutes the indices:
every sequence has one slot and every slot one sequence. Slots are dealt to
shards by range, sorted there, and have the same number of bytes each, so a
reader finds slot s at ``(s % per_shard) * stride`` of shard ``s // per_shard``
and can go on from any slot.

Defined results: null and empty texts have no sequences; a short last sequence
is padded with the end id (``n_ids`` tells how many ids are real); repeated rows
are separate sequences; an empty table gives no shards. Long runs of white space
are cut out before the pattern sees them, just where the pattern would cut, as
its engine gives up on runs of some hundred thousand characters.
"""

from __future__ import annotations

import base64
import os
import posixpath
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.llm.common import ids_only, materialise, table

RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: how the vocabulary's texts are cut before merging
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: White space from which on a run is cut by hand: such a run is one piece but
#: for its last character, unless the text ends with it.
LONG_RUN = 2048
# fixed value: the code points of the pattern's \s, fewer than those of Python's
_LONG_RUN = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


@dataclass(frozen=True)
class Config:
    length: int = 512
    per_shard: int = 8192
    key: int = 0x5EED5EED5EED5EED
    rounds: int = 6
    end_id: int = 50256

    @property
    def stride(self) -> int:
        """Bytes of a sequence: ids are little-endian uint16."""
        return 2 * self.length


def load_ranks(path: str = RANKS_PATH) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


_encoders: dict[int, object] = {}


def _encoder(held):
    """The worker's tokenizer of a broadcast vocabulary."""
    if held.id not in _encoders:
        import tiktoken

        _encoders.clear()
        _encoders[held.id] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=held.ranks, special_tokens={})
    return _encoders[held.id]


def ids_of(encoder, text: str) -> list[int]:
    """The text's ids, with long runs of white space cut out by hand."""
    ids, at = [], 0
    for run in _LONG_RUN.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoder.encode_ordinary(text[at : run.start()])
        ids += encoder._encode_single_piece(text[run.start() : end])
        at = end
    return ids + encoder.encode_ordinary(text[at:]) if at else encoder.encode_ordinary(text)


class _Held:
    """A broadcast vocabulary and the name under which workers keep it."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.id = ranks, uuid.uuid4().int


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: int, config: Config = Config()) -> np.ndarray:
    """Slots of the indices: a bijection of range(n) that the key picks."""
    half = max(1, -(-(n - 1).bit_length() // 2))
    low, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = _mix(np.arange(1, config.rounds + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ np.uint64(config.key))

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> shift, x & low
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & low)
        return left << shift | right

    slots = network(index.astype(np.uint64))
    while (out := np.flatnonzero(slots >= n)).size:  # cycle-walking
        slots[out] = network(slots[out])
    return slots.astype(np.int64)


def sequences(docs: DataFrame, ranks: dict[bytes, int], config: Config = Config()) -> DataFrame:
    """doc_id, part, n_ids, ids (unpadded uint16 bytes) of every text."""
    held = docs.sparkSession.sparkContext.broadcast(_Held(ranks))
    kind = docs.schema["doc_id"].dataType
    end, stride = np.array([config.end_id], np.uint16).tobytes(), config.stride

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                rows, parts, held_ids = [], [], []
                for i, text in enumerate(batch.column(1).to_pylist()):
                    if not text:
                        continue
                    data = np.array(ids_of(encoder, text), np.uint16).tobytes() + end
                    for part, start in enumerate(range(0, len(data), stride)):
                        rows.append(i)
                        parts.append(part)
                        held_ids.append(data[start : start + stride])
                sizes = pa.array([len(x) // 2 for x in held_ids], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(parts, pa.int32()), sizes, pa.array(held_ids, pa.binary())], ["doc_id", "part", "n_ids", "ids"])

    return ids_only(docs, "doc_id", "text").mapInArrow(cut, f"doc_id {kind.simpleString()}, part int, n_ids int, ids binary")


def in_training_order(docs: DataFrame, ranks: dict[bytes, int], config: Config = Config()) -> DataFrame:
    """Every sequence with its slot, shard and byte offset; one partition for
    each shard, sorted by slot, ids padded to the stride.

    The index of a sequence is its file's first index plus its row in the file.
    Files are counted on the executors, a row for each file.
    """
    written = materialise(sequences(docs, ranks, config), "sequences")
    placed = written.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    files = sorted((r.file, r.n) for r in placed.groupBy("file").agg(F.count(F.lit(1)).alias("n")).collect())
    first = dict(zip((f for f, _ in files), np.cumsum([0, *(n for _, n in files)]).tolist(), strict=False))
    n = sum(x for _, x in files)
    held = docs.sparkSession.sparkContext.broadcast(first)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            starts = np.array([held.value[f] for f in batch.column(names.index("file")).to_pylist()], np.int64)
            slots = permute(starts + batch.column(names.index("row")).to_numpy(), n, config)
            yield pa.RecordBatch.from_arrays([*[batch.column(names.index(c)) for c in ("doc_id", "part", "n_ids", "ids")], pa.array(slots)], ["doc_id", "part", "n_ids", "ids", "slot"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    dealt = placed.mapInArrow(deal, f"doc_id {kind}, part int, n_ids int, ids binary, slot long")
    shards = max(1, -(-n // config.per_shard))
    shard = (F.col("slot") / config.per_shard).cast("int")
    ordered = dealt.withColumn("shard", shard).repartitionById(shards, F.col("shard")).sortWithinPartitions("slot")
    pad = np.array([config.end_id], "<u2").tobytes() * config.length
    missing = F.substring(F.lit(pad), F.lit(1), F.lit(config.stride) - F.octet_length("ids"))
    return ordered.select("slot", "shard", ((F.col("slot") % config.per_shard) * config.stride).alias("offset"), "doc_id", "part", "n_ids", F.concat("ids", missing).alias("ids"))


def write_shards(ordered: DataFrame, folder: str) -> DataFrame:
    """Raw shard files in a folder that all executors share; returns their
    manifest (shard, first_slot, n, bytes, crc32).

    A file is written beside its final name and renamed, so a task that is run
    again, or twice at once, leaves one whole file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple[int, int, int, int, int]] = []
        out, shard, first, n, size, crc, temp = None, None, 0, 0, 0, 0, ""

        def close() -> None:
            if out is not None:
                out.flush()
                os.fsync(out.fileno())
                out.close()
                os.replace(temp, posixpath.join(folder, f"shard-{shard:08d}.bin"))
                done.append((shard, first, n, size, crc))

        for batch in batches:
            for slot, mine, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if mine != shard:
                    close()
                    os.makedirs(folder, exist_ok=True)
                    shard, first, n, size, crc = mine, slot, 0, 0, 0
                    temp = posixpath.join(folder, f".{uuid.uuid4().hex}")
                    out = open(temp, "wb")  # noqa: SIM115
                out.write(ids)
                n, size, crc = n + 1, size + len(ids), zlib.crc32(ids, crc)
        close()
        names = ["shard", "first_slot", "n", "bytes", "crc32"]
        columns = list(zip(*done, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return ids_only(ordered, "slot", "shard", "ids").mapInArrow(write, "shard long, first_slot long, n long, bytes long, crc32 long")


def read_slots(folder: str, start: int, count: int, config: Config = Config()) -> np.ndarray:
    """Sequences of slots start to start + count: one seek for each shard."""
    out = []
    while count > 0:
        shard, at = divmod(start, config.per_shard)
        n = min(count, config.per_shard - at)
        with open(posixpath.join(folder, f"shard-{shard:08d}.bin"), "rb") as f:
            f.seek(at * config.stride)
            out.append(np.frombuffer(f.read(n * config.stride), "<u2").reshape(-1, config.length))
        if len(out[-1]) < n:
            break
        start, count = start + n, count - n
    return np.concatenate(out) if out else np.zeros((0, config.length), "<u2")


def op8_token_shards(spark: SparkSession, sf_dir: str, path: str = RANKS_PATH) -> DataFrame:
    return in_training_order(table(spark, sf_dir, "documents"), load_ranks(path))
