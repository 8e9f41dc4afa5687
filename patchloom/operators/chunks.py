"""Overlapping token windows of long texts and which of them to keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def windows(tokens: Column, capacity: int, overlap: int) -> Column:
    """Array of (chunk_index from 1, token_start, token_end) over a token array;
    the last window is the first that reaches the end."""
    if not 0 <= overlap < capacity:
        raise ValueError("overlap must be at least 0 and below the capacity")
    step, n = capacity - overlap, F.size(tokens)
    last = F.greatest(F.ceil((n - capacity) / step), F.lit(0)).cast("int")
    made = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct((i + 1).alias("chunk_index"), (i * step).alias("token_start"), F.least(i * step + capacity, n).alias("token_end")))
    return F.when(n > 0, made).otherwise(F.slice(made, 1, 0))


def overlaps(start: Column, end: Column, low: Column, high: Column) -> Column:
    """Whether [start, end) meets [low, high); an empty region is an anchor that
    a chunk meets with its ends included."""
    return F.when(low == high, (start <= low) & (low <= end)).otherwise((start < high) & (low < end))


def contains(start: Column, end: Column, low: Column, high: Column) -> Column:
    return F.when(low == high, (start <= low) & (low <= end)).otherwise((start <= low) & (high <= end))


def sliced(code: Column, offsets: Column, max_tokens: int, overlap: int, special: int = 2) -> Column:
    """Array of the chunks of one text: windows over its token offsets (start,
    end), with the text between and its token count, special tokens included."""
    made = windows(offsets, max_tokens - special, overlap)

    def chunk(w: Column) -> Column:
        start, end = F.get(offsets, w["token_start"])["start"], F.get(offsets, w["token_end"] - 1)["end"]
        return F.struct(
            w["chunk_index"].alias("chunk_index"), w["token_start"].alias("token_start"), w["token_end"].alias("token_end"),
            start.alias("char_start"), end.alias("char_end"), F.substring(code, start + 1, end - start).alias("chunk_code"),
            (w["token_end"] - w["token_start"] + special).cast("int").alias("chunk_token_count"),
        )

    return F.transform(made, chunk)


def fit_to_limit(code: Column, offsets: Column, max_tokens: int, special: int = 2) -> Column:
    """The text cut behind the last token that still fits."""
    room = max_tokens - special
    return F.when(F.size(offsets) <= room, code).otherwise(F.substring(code, F.lit(1), F.get(offsets, F.lit(room - 1))["end"]))


def with_regions(made: Column, regions: Column) -> Column:
    """The chunks with contains_patch and redundant: all the regions that a
    chunk touches lie whole in a better chunk of the text, one with more whole
    regions, or as many and a smaller index. Chunks are compared with all that
    touch a region, redundant ones too; nothing leaves the row."""

    def scored(c: Column) -> Column:
        touched = F.filter(regions, lambda r: overlaps(c["char_start"], c["char_end"], r["char_start"], r["char_end"]))
        whole = F.filter(regions, lambda r: contains(c["char_start"], c["char_end"], r["char_start"], r["char_end"]))
        return F.struct(c.alias("c"), touched.alias("touched"), whole.alias("whole"))

    def marked(all_chunks: Column) -> Column:
        def better(s: Column, o: Column) -> Column:
            a, b = F.size(o["whole"]), F.size(s["whole"])
            ahead = (a > b) | ((a == b) & (o["c"]["chunk_index"] < s["c"]["chunk_index"]))
            return (o["c"]["chunk_index"] != s["c"]["chunk_index"]) & ahead & (F.size(F.array_except(s["touched"], o["whole"])) == 0)

        patched = F.filter(all_chunks, lambda s: F.size(s["touched"]) > 0)
        return F.transform(all_chunks, lambda s: F.struct(
            s["c"].alias("c"), (F.size(s["touched"]) > 0).alias("contains_patch"),
            ((F.size(s["touched"]) > 0) & F.exists(patched, lambda o: better(s, o))).alias("redundant")))

    return F.transform(F.array(F.transform(made, scored)), marked)[0]


def prune_dominated(chunks: DataFrame, group: list[str], regions: str) -> DataFrame:
    """Drops redundant chunks (see with_regions) of a table of chunks. A group is
    the chunks of one text, whose number its length bounds."""
    fields = [c for c in chunks.columns if c not in (*group, regions)]
    gathered = chunks.groupBy(*group).agg(F.collect_list(F.struct(*fields)).alias("_made"), F.first(regions).alias(regions))
    marked = gathered.select(*group, regions, F.explode(with_regions(F.col("_made"), F.col(regions))).alias("_m")).where("NOT _m.redundant")
    return marked.select(*[F.col(c) if c in (*group, regions) else F.col(f"_m.c.{c}") for c in chunks.columns])


def both_sides_survive(chunks: DataFrame, parent: str, variant: str, eligible: Column) -> DataFrame:
    """chunks with ``chunk_status``: MODEL_READY where the parent keeps an
    eligible chunk on both sides, else MANUAL_REVIEW."""
    own = Window.partitionBy(parent)
    sides = [F.max(F.when((F.col(variant) == v) & eligible, 1).otherwise(0)).over(own) for v in ("before", "after")]
    return chunks.withColumn("chunk_status", F.when(sides[0] + sides[1] == 2, "MODEL_READY").otherwise("MANUAL_REVIEW"))


def only_reason(reasons: Column, reason: str) -> Column:
    return F.array_distinct(reasons) == F.array(F.lit(reason))


def check_result(chunks: DataFrame, records: DataFrame, max_tokens: int) -> DataFrame:
    """One row of violation counts of the chunking invariants."""
    sized = chunks.agg(F.count_if(F.col("token_count") > max_tokens).alias("over_limit"), (F.count(F.lit(1)) - F.count_distinct("chunk_id")).alias("repeated_ids"), F.count_if(F.col("eligible_for_training") & ~F.col("overlaps_patch")).alias("training_without_patch"))
    orphans = chunks.join(records, F.col("parent_sample_id") == F.col("sample_id"), "left_anti").agg(F.count(F.lit(1)).alias("orphans"))
    return sized.crossJoin(F.broadcast(orphans))
