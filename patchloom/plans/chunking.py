"""Long pairs to training chunks around their patch.

A record is read once and its chunks are built, marked and pruned inside its row;
only whole chunks are exploded at the end, so nothing is shuffled here.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions import keys as K
from patchloom.functions.diffs import patch_regions
from patchloom.operators import chunks as C
from patchloom.operators import summaries

LONG = "manual_review_long_code"
# fixed values: what a chunk takes over from its record, with its type
CARRIED = {
    "pair_id": "string", "schema_version": "string", "source_dataset": "string", "source_dataset_url": "string", "source_license": "string",
    "source_record_id": "string", "advisory_ids": "array<string>", "source_line": "int", "repository": "string", "repository_id": "string",
    "commit": "string", "commit_url": "string", "file_path": "string", "function_name": "string", "start_line_before": "int", "end_line_before": "int",
    "start_line_after": "int", "end_line_after": "int", "language": "string", "cwes": "array<string>", "labels": "array<string>", "owasp_2025": "array<string>",
}


class Chunked(NamedTuple):
    """chunks: all of them; remaining: records left to people, with a reason;
    outcomes: one row for each record."""

    chunks: DataFrame
    remaining: DataFrame
    outcomes: DataFrame

    def training(self) -> DataFrame:
        return self.chunks.where("eligible_for_training")


def field(df: DataFrame, name: str, kind: str, *others: str) -> Column:
    """The first column of df among name and others that isn't null; a typed
    null (an empty array) where df has none."""
    found = [F.col(c) for c in (name, *others) if c in df.columns]
    value = F.coalesce(*found) if found else F.lit(None)
    return F.coalesce(value.cast(kind), F.array().cast(kind)) if kind.startswith("array") else value.cast(kind)


def _judged(records: DataFrame, offsets: Callable[[Column], Column], max_tokens: int, overlap: int, special: int) -> DataFrame:
    """records with _outcome: why a record can't be chunked, or its chunks."""
    if not 0 <= overlap < max_tokens - special:
        raise ValueError("the overlap must be at least 0 and below the capacity")
    before, after = (K.text(F.col(c)) for c in ("code_before", "code_after"))
    blank_b, blank_a = F.trim(before) == "", F.trim(after) == ""
    long_only = C.only_reason(F.coalesce("reason_codes", F.array().cast("array<string>")), LONG)
    work = long_only & ~blank_b & ~blank_a
    # what the workers give stands as it is: a condition around it would be copied to
    # wherever the value is used, down into the loops over chunks
    parsed = records.withColumns({
        "_long": long_only, "_work": work,
        "_regions": patch_regions(F.when(work, before), F.when(work, after)),
        "_tokens_before": offsets(F.when(work, before)), "_tokens_after": offsets(F.when(work, after)),
    })
    reason = (
        F.when(~F.col("_long"), "manual_review_chunk_other_reasons")
        .when(blank_b, "manual_review_chunk_tokenization_error")
        .when(blank_a, "manual_review_chunk_missing_pair")
        .when((F.size("_regions.before") == 0) & (F.size("_regions.after") == 0), "manual_review_chunk_patch_not_found")
        .when((F.size("_tokens_before") == 0) | (F.size("_tokens_after") == 0), "manual_review_chunk_tokenization_error")
    )
    sides = {f"_{s}": C.with_regions(C.sliced(code, F.col(f"_tokens_{s}"), max_tokens, overlap, special), F.col(f"_regions.{s}")) for s, code in (("before", before), ("after", after))}
    made = parsed.withColumn("_reason", reason).withColumns({n: F.when(F.col("_reason").isNull(), c) for n, c in sides.items()})
    survives = [F.exists(f"_{s}", lambda c: c["contains_patch"] & ~c["redundant"]) for s in ("before", "after")]
    counts = [F.size(f"_tokens_{s}") + special for s in ("before", "after")]
    return made.withColumns({
        "_ready": F.coalesce(survives[0] & survives[1], F.lit(False)),
        "_within": F.coalesce(F.col("_work") & (counts[0] <= max_tokens) & (counts[1] <= max_tokens), F.lit(False)),
    })


def chunk_records(records: DataFrame, offsets: Callable[[Column], Column], tokenizer: str, max_tokens: int = 512, overlap: int = 128, special: int = 2) -> Chunked:
    """Records with reason_codes, code_before, code_after, sample_id and what
    CARRIED names. offsets: token places of a text, as array<struct<start,end>>;
    special: tokens that the tokenizer puts around a text. A record is few bytes and
    much work, so a small file of many should be spread first (joins.spread)."""
    judged = _judged(records, offsets, max_tokens, overlap, special)
    parent = F.coalesce(F.nullif(field(records, "sample_id", "string"), F.lit("")), F.concat(F.lit("SOURCE_LINE_"), F.coalesce(field(records, "source_line", "string"), F.lit("UNKNOWN"))))
    sides = F.array(*[F.struct(F.lit(s).alias("variant"), F.col(f"_{s}").alias("made"), F.size(f"_tokens_{s}").alias("tokens"), F.col(f"_regions.{s}").alias("regions")) for s in ("before", "after")])
    by_side = judged.where("_reason IS NULL").select("*", F.explode(sides).alias("_side"))
    rows = by_side.select("*", F.explode("_side.made").alias("_m"))
    patched, redundant, ready = F.col("_m.contains_patch"), F.col("_m.redundant"), F.col("_ready")
    status = F.when(~ready, "MANUAL_REVIEW").when(patched & ~redundant, "MODEL_READY").otherwise("CONTEXT_ONLY")
    why = F.when(~ready, "manual_review_chunk_patch_not_found").when(~patched, "context_chunk_without_patch").when(redundant, "context_redundant_patch_chunk").otherwise("accepted_chunk_contains_patch")
    variant = F.col("_side.variant")
    chunks = rows.select(
        F.format_string("%s_%s_CHUNK_%03d", parent, F.upper(variant), F.col("_m.c.chunk_index")).alias("chunk_id"),
        parent.alias("parent_sample_id"),
        *[field(records, n, k).alias(n) for n, k in CARRIED.items()],
        field(records, "advisory_url", "string", "report_link").alias("advisory_url"),
        field(records, "commit_id", "string", "commit").alias("commit_id"),
        F.coalesce(field(records, "unit_type", "string"), F.lit("function")).alias("unit_type"),
        variant.alias("variant"),
        (variant == "before").alias("is_vulnerable_for_target_cwe"),
        F.coalesce(field(records, "has_paired_negative", "boolean"), F.lit(False)).alias("has_paired_negative"),
        F.col("_m.c.chunk_code").alias("chunk_code"),
        F.col("_m.c.chunk_index").cast("int").alias("chunk_index"),
        F.size("_side.made").alias("chunk_count"),
        F.col("_m.c.chunk_token_count").alias("chunk_token_count"),
        (F.col("_side.tokens") + special).alias("original_token_count"),
        *[F.col(f"_m.c.{c}").alias(c) for c in ("char_start", "char_end", "token_start", "token_end")],
        patched.alias("contains_patch"),
        (ready & patched & ~redundant).alias("eligible_for_training"),
        F.col("_side.regions").alias("patch_regions"),
        F.lit("patch_aware_sliding_window").alias("chunking_method"),
        F.lit(tokenizer).alias("tokenizer"),
        F.lit(max_tokens).alias("max_tokens"),
        F.lit(overlap).alias("stride"),
        field(records, "status", "string").alias("source_status"),
        F.col("reason_codes").alias("source_reason_codes"),
        status.alias("chunk_status"),
        F.array(why).alias("chunk_reason_codes"),
    )
    left = F.coalesce("_reason", F.when(~F.col("_ready"), "manual_review_chunk_patch_not_found"))
    remaining = judged.where(left.isNotNull()).select(*records.columns, F.lit("MANUAL_REVIEW").alias("chunking_status"), F.array(left).alias("chunking_reason_codes"))
    both = F.concat(F.coalesce("_before", F.slice("_after", 1, 0)), "_after")
    number = [F.coalesce(c, F.lit(0)).cast("long") for c in (F.size(both), F.size(F.filter(both, lambda m: m["contains_patch"] & ~m["redundant"])), F.array_max(F.transform(both, lambda m: m["c"]["chunk_token_count"])))]
    outcomes = judged.select(
        field(records, "sample_id", "string").alias("sample_id"),
        field(records, "cwes", "array<string>").alias("cwes"),
        F.col("_long").alias("eligible_long_only"),
        F.col("_within").alias("within_limit"),
        F.col("_ready").alias("chunked_model_ready"),
        number[0].alias("chunks_created"),
        F.when(F.col("_ready"), number[1]).otherwise(F.lit(0)).cast("long").alias("training_chunks"),
        number[2].alias("max_chunk_token_count"),
        F.coalesce(F.size(F.filter(both, lambda m: ~m["contains_patch"])), F.lit(0)).cast("long").alias("non_patch_chunks"),
        left.isNotNull().alias("remains"),
    )
    return Chunked(chunks, remaining, outcomes)


def chunk_summary(outcomes: DataFrame) -> DataFrame:
    """One row for each weakness that was seen, and TOTAL, from the records'
    outcomes alone: a record with several weaknesses counts once in the total."""
    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    counts = {
        "input_manual_samples": F.count(F.lit(1)),
        "eligible_long_only_functions": F.count_if("eligible_long_only"),
        "functions_within_limit": F.count_if("within_limit"),
        "long_functions": F.count_if(F.col("eligible_long_only") & ~F.col("within_limit")),
        "chunked_model_ready_functions": F.count_if("chunked_model_ready"),
        "chunks_created": total("chunks_created"),
        "training_chunks": total("training_chunks"),
        "non_patch_chunks": total("non_patch_chunks"),
        "remaining_manual_review": F.count_if("remains"),
        "max_chunk_token_count": F.coalesce(F.max("max_chunk_token_count"), F.lit(0)),
    }
    return summaries.with_total(outcomes, "cwe", F.array_distinct("cwes"), counts)
