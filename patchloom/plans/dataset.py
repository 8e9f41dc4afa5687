"""Model samples from accepted pairs and from chunks: validation, duplicates,
label conflicts and the build's summary."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions import keys as K
from patchloom.operators import dedup, rules, samples, summaries
from patchloom.plans.chunking import field

ADVISORIES = "GitHub Advisory Database"
_SPAN = "array<struct<start_line:int,end_line:int>>"
# fixed values: what a sample takes over from its record, with its type
COMMON = {
    "source_record_id": "string", "repository": "string", "commit_url": "string", "file_path": "string", "function_name": "string",
    "start_line_before": "int", "end_line_before": "int", "start_line_after": "int", "end_line_after": "int", "cwes": "array<string>",
    "advisory_cwes": "array<string>", "cwe_isolation_evidence": "string", "labels": "array<string>", "tokenizer": "string", "platform": "string",
    "vulnerability_scope": "string", "domain": "string", "curation_status": "string", "curation_notes": "string",
}


class Built(NamedTuple):
    kept: DataFrame
    duplicates: DataFrame
    conflicts: DataFrame
    invalid: DataFrame


def _shared(df: DataFrame) -> dict[str, Column]:
    return {n: field(df, n, k) for n, k in COMMON.items()} | {
        "model_schema_version": F.lit("1.0"),
        "commit_id": field(df, "commit_id", "string", "commit"),
        "unit_type": F.coalesce(field(df, "unit_type", "string"), F.lit("function")),
    }


def full_samples(accepted: DataFrame, line: str = "source_line") -> DataFrame:
    """Two samples of each accepted pair; a side with blank code or without a
    token count gives none. Module blocks keep their spans on each side."""
    parent = K.text(field(accepted, "sample_id", "string"))
    unit = field(accepted, "unit_type", "string")
    rows = accepted.select(
        parent.alias("parent_sample_id"),
        F.coalesce(F.nullif(field(accepted, "pair_id", "string"), F.lit("")), parent).alias("group_id"),
        *[c.alias(n) for n, c in _shared(accepted).items()],
        F.coalesce(F.nullif(field(accepted, "source_dataset", "string"), F.lit("")), F.lit("unknown")).alias("source_dataset"),
        F.when(unit == "module_block", "module_block").otherwise("full_function").alias("source_type"),
        *[field(accepted, f"source_spans_{s}", _SPAN).alias(f"source_spans_{s}") for s in ("before", "after")],
        F.col("code_before"), F.col("code_after"), F.col("token_count_before"), F.col("token_count_after"),
        field(accepted, line, "long").alias("source_ordinal"),
    )
    carried = [c for c in rows.columns if c not in ("code_before", "code_after", "token_count_before", "token_count_after")]
    both = samples.pair_to_samples(rows, carried)
    own = {n: F.when(F.col("variant") == "before", F.col(f"{n}_before")).otherwise(F.col(f"{n}_after")) for n in ("start_line", "end_line", "source_spans")}
    return both.withColumns(own)


def chunk_samples(chunks: DataFrame, fallback_source: str, line: str = "source_line") -> DataFrame:
    """Chunks that are ready and eligible and hold code, as samples."""
    ready = chunks.where(F.col("eligible_for_training") & (F.col("chunk_status") == "MODEL_READY") & (F.trim(K.text(F.col("chunk_code"))) != ""))
    parent = K.text(F.col("parent_sample_id"))
    return ready.select(
        K.text(F.col("chunk_id")).alias("model_sample_id"),
        parent.alias("parent_sample_id"),
        F.coalesce(F.nullif(field(chunks, "pair_id", "string"), F.lit("")), parent).alias("group_id"),
        *[c.alias(n) for n, c in _shared(chunks).items()],
        F.coalesce(F.nullif(field(chunks, "source_dataset", "string"), F.lit("")), F.lit(fallback_source)).alias("source_dataset"),
        F.lit("long_chunk").alias("source_type"),
        F.col("chunk_code").alias("code"),
        F.col("variant"),
        F.col("is_vulnerable_for_target_cwe").alias("is_vulnerable"),
        F.col("chunk_token_count").alias("token_count"),
        F.col("chunk_index"),
        F.col("contains_patch"),
        K.content_hash(F.col("chunk_code")).alias("code_sha256"),
        field(chunks, line, "long").alias("source_ordinal"),
    )


def fallback_label(path: Column, primary: str) -> Column:
    """The data set of a chunk file without one, by its path: that of advisories
    in a folder of supplements, else the primary one."""
    return F.when(F.array_contains(F.split(path, "/"), "supplement"), ADVISORIES).otherwise(primary)


def build(accepted: list[DataFrame], chunks: list[tuple[DataFrame, str]], max_tokens: int = 512) -> Built:
    """Samples of all inputs in listed order. Rows that fail validation are set
    aside first, so they can't cause conflicts; of equal code with equal labels
    the first stays, and with different labels none does."""
    frames = [full_samples(a) for a in accepted] + [chunk_samples(c, source) for c, source in chunks]
    rows = samples.union_in_order(frames)
    checked = rows.withColumn("validation_errors", rules.sample_errors(rows, max_tokens))
    bad = F.size("validation_errors") > 0
    signature = F.concat_ws("|", F.col("is_vulnerable").cast("string"), F.array_join(F.array_sort("cwes"), ","))
    order = [F.col("source_ord"), F.coalesce("source_ordinal", F.lit(0)), F.col("variant") == "after", F.col("model_sample_id")]
    judged = dedup.conflicts_and_duplicates(checked.where(~bad).drop("validation_errors"), F.col("code_sha256"), signature, order)
    kept = judged.where("verdict = 'kept'").drop("verdict")
    first = kept.select(F.col("code_sha256"), F.col("model_sample_id").alias("duplicate_of"))
    return Built(
        kept,
        judged.where("verdict = 'duplicate'").drop("verdict").join(first, "code_sha256"),
        judged.where("verdict = 'conflict'").drop("verdict").withColumn("conflict_code_sha256", F.col("code_sha256")),
        checked.where(bad),
    )


def build_summary(built: Built) -> DataFrame:
    """(metric, value) of a build: samples, parents by unit, groups, what was
    taken out, and samples of each weakness."""
    kept = built.kept

    def parents(unit: str | None) -> Column:
        of = F.col("parent_sample_id") if unit is None else F.when(F.col("unit_type") == unit, F.col("parent_sample_id"))
        return F.count_distinct(of)

    one = kept.agg(
        F.count(F.lit(1)).alias("model_samples"), parents("function").alias("unique_parent_functions"), parents("module_block").alias("unique_parent_module_blocks"),
        parents(None).alias("unique_parent_units"), F.count_distinct("group_id").alias("unique_groups"),
    )
    table = summaries.metric_table(one, one.columns)
    for name, rows in (("duplicates_removed", built.duplicates), ("label_conflicts_removed", built.conflicts), ("invalid_removed", built.invalid)):
        table = table.unionByName(rows.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value"))
    by_cwe = kept.select(F.explode("cwes").alias("cwe")).groupBy("cwe").agg(F.count(F.lit(1)).alias("value"))
    return table.unionByName(by_cwe.select(F.concat(F.lit("samples_"), "cwe").alias("metric"), "value"))
