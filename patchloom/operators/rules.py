"""Ordered rules that only raise a record's status and collect reasons.

A rule is (status, reason, predicate); a null predicate is false. The status is
the highest of the rules that hold, the reasons are theirs in order, each once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions import keys as K

STATUSES = ("ACCEPTED", "MANUAL_REVIEW", "REJECTED")
ACC, MAN, REJ = 0, 1, 2
Rule = tuple[int, str, Column]

# fixed values: keys that an external pair and a model sample must have
PAIR_REQUIRED = (
    "schema_version", "sample_id", "source_dataset", "source_dataset_url", "source_record_id", "repository", "commit_id",
    "commit_url", "file_path", "function_name", "language", "cwes", "code_before", "code_after",
)
SAMPLE_REQUIRED = ("model_sample_id", "parent_sample_id", "group_id", "source_dataset", "repository", "commit_id", "file_path", "function_name", "code", "cwes", "labels", "tokenizer")


def apply_rules(df: DataFrame, rules: list[Rule], accepted: str = "accepted_exact_target_cwe", unspecified: str = "manual_review_unspecified") -> DataFrame:
    """df with status and reason_codes; one projection, no shuffle."""
    held = [F.coalesce(p, F.lit(False)) for _, _, p in rules]
    rank = F.greatest(*[F.when(h, F.lit(r)).otherwise(F.lit(ACC)) for h, (r, _, _) in zip(held, rules, strict=True)], F.lit(ACC))
    reasons = F.array_distinct(F.array_compact(F.array(*[F.when(h, F.lit(n)) for h, (_, n, _) in zip(held, rules, strict=True)])))
    marked = df.withColumns({"_rank": rank, "_reasons": reasons})
    final = F.when(F.size("_reasons") > 0, F.col("_reasons")).otherwise(F.when(F.col("_rank") == ACC, F.array(F.lit(accepted))).otherwise(F.array(F.lit(unspecified))))
    return marked.withColumns({"status": F.array(*[F.lit(s) for s in STATUSES])[F.col("_rank")], "reason_codes": final}).drop("_rank", "_reasons")


def raise_status(df: DataFrame, when: Column, status: int, reason: str) -> DataFrame:
    """A later rule on classified rows: the status can't fall."""
    rank = F.array_position(F.array(*[F.lit(s) for s in STATUSES]), F.col("status")) - 1
    higher = F.array(*[F.lit(s) for s in STATUSES])[F.greatest(rank, F.lit(status)).cast("int")]
    kept = F.filter("reason_codes", lambda r: ~r.startswith("accepted_"))
    held = F.coalesce(when, F.lit(False))
    return df.withColumns({"status": F.when(held, higher).otherwise(F.col("status")), "reason_codes": F.when(held, F.array_union(kept, F.array(F.lit(reason)))).otherwise(F.col("reason_codes"))})


def primary_rules(max_tokens: int = 512) -> list[Rule]:
    """Rules of the primary function rows; the columns are those of
    plans.curation.prepare_primary."""
    c = F.col
    targets = F.size(F.array_intersect(c("cwes"), F.array(*[F.lit(t) for t in K.TARGETS])))
    related = F.arrays_overlap(c("cwes"), F.array(*[F.lit(t) for t in K.RELATED]))
    blank = F.trim(F.coalesce(c("code_before"), F.lit(""))) == ""
    python, after = c("language_is.is_python"), F.trim(F.coalesce(c("code_after"), F.lit(""))) != ""
    return [
        (MAN, "manual_review_label_conflict", (F.size("cwes_embedded") > 0) & (F.size("cwes_mapped") > 0) & (F.array_sort("cwes_embedded") != F.array_sort("cwes_mapped"))),
        (REJ, "rejected_missing_cwe", F.size("cwes") == 0),
        (MAN, "manual_review_related_cwe", (F.size("cwes") > 0) & (targets == 0) & related),
        (REJ, "rejected_non_target_cwe", (F.size("cwes") > 0) & (targets == 0) & ~related),
        (MAN, "manual_review_multiple_cwes", targets > 1),
        (REJ, "rejected_missing_vulnerable_code", c("code_before").isNull()),
        (REJ, "rejected_empty_code", c("code_before").isNotNull() & blank),
        (REJ, "rejected_binary_code", ~blank & K.has_binary_controls(c("code_before"))),
        (MAN, "manual_review_language_conflict", c("language_is.conflict")),
        (MAN, "manual_review_language_unknown", ~c("language_is.conflict") & c("language_is.unknown")),
        (REJ, "rejected_non_python", ~c("language_is.conflict") & ~c("language_is.unknown") & ~python),
        (MAN, "manual_review_ast_error", python & ~blank & (~c("before_is.valid") | (after & ~c("after_is.valid")))),
        (MAN, "manual_review_missing_context", python & ~blank & ((c("before_is.valid") & ~c("before_is.has_function")) | (after & c("after_is.valid") & ~c("after_is.has_function")))),
        (REJ, "rejected_missing_function_identifier", K.is_missing(c("function_name"))),
        (MAN, "manual_review_missing_provenance", c("commit.repository").isNull() | c("commit.commit_id").isNull() | c("path").isNull()),
        (MAN, "manual_review_commit_not_indexed", (c("commit.raw") != "") & ~c("indexed")),
        (MAN, "manual_review_test_or_generated_code", c("path").isNotNull() & K.is_review_path(c("path"))),
        (REJ, "rejected_unchanged_pair", after & (c("code_before") == c("code_after"))),
        (MAN, "manual_review_nonsemantic_change", after & (c("code_before") != c("code_after")) & (c("before_is.normalized") != "") & (c("before_is.normalized") == c("after_is.normalized"))),
        (MAN, "manual_review_tokenizer_unavailable", ~blank & ~c("tokens_exact")),
        (MAN, "manual_review_long_code", (c("tokens_before") > max_tokens) | (after & (c("tokens_after") > max_tokens))),
    ]


def external_rules(max_tokens: int = 512) -> list[Rule]:
    """Rules of externally extracted pairs; columns of prepare_external."""
    c = F.col
    module = F.coalesce(c("unit_type") == "module_block", F.lit(False))
    one = (F.size("cwes") == 1) & c("cwes")[0].isin(*K.TARGETS)
    exempt = module & F.array_contains("cwes", "CWE-798") & (F.trim(F.coalesce(c("cwe_isolation_evidence"), F.lit(""))) != "")
    lines = ("start_line_before", "start_line_after", "end_line_before", "end_line_after")
    binding = F.lower(c("function_name"))

    def secrets(facts: str) -> Column:
        return F.filter(F.col(facts)["credentials"], lambda x: ~module | (x["name"] == binding))

    removed = F.array_except(secrets("before_is"), secrets("after_is"))
    secret = one & (c("cwes")[0] == "CWE-798") & c("before_is.valid") & c("after_is.valid")
    scope = ~F.array_contains("cwes", "CWE-798") | K.is_missing(c("cwe_isolation_evidence"))
    return [
        (REJ, "rejected_schema_required_field_missing", F.size("missing_required_fields") > 0),
        (REJ, "rejected_schema_version", c("schema_version") != "1.0"),
        (REJ, "rejected_non_python", (F.lower(c("language")) != "python") | ~c("file_path").endswith(".py")),
        (MAN, "manual_review_non_exact_target_cwe", ~one),
        (MAN, "manual_review_multi_cwe_without_isolation_evidence", (F.size("advisory_cwes") > 1) & ~exempt),
        (MAN, "manual_review_ast_error", ~c("before_is.valid") | ~c("after_is.valid")),
        (MAN, "manual_review_invalid_module_scope", module & scope),
        (MAN, "manual_review_missing_module_binding", module & ~scope & ~c("bound")),
        (MAN, "manual_review_missing_source_lines", module & ~scope & c("bound") & F.coalesce(*[F.when(c(x).isNull(), F.lit(True)) for x in lines], F.lit(False))),
        (MAN, "manual_review_missing_function_context", ~module & (~(F.coalesce(c("unit_type"), F.lit("function")) == "function") | ~c("before_is.has_function") | ~c("after_is.has_function"))),
        (REJ, "rejected_unchanged_pair", c("code_before") == c("code_after")),
        (MAN, "manual_review_nonsemantic_change", (c("code_before") != c("code_after")) & (c("before_is.normalized") == c("after_is.normalized"))),
        (MAN, "manual_review_test_or_generated_code", K.is_review_path(c("file_path"))),
        (MAN, "manual_review_tokenizer_unavailable", ~c("tokens_exact")),
        (MAN, "manual_review_cwe798_semantic_evidence", secret & (F.size(removed) == 0)),
        (MAN, "manual_review_cwe798_residual_hardcoded_credential", secret & (F.size(removed) > 0) & (F.size(secrets("after_is")) > 0)),
        (MAN, "manual_review_long_code", (c("tokens_before") > max_tokens) | (c("tokens_after") > max_tokens)),
    ]


def missing_fields(df: DataFrame, required: tuple[str, ...]) -> Column:
    """Sorted names of the required columns that are absent or empty."""
    kinds = dict(df.dtypes)
    found = [F.lit(n) if n not in kinds else F.when(K.is_missing(F.col(n), kinds[n]), F.lit(n)) for n in sorted(required)]
    return F.array_compact(F.array(*found))


def sample_errors(df: DataFrame, max_tokens: int = 512) -> Column:
    """Validation errors of model samples, an array per row."""
    missing = F.transform(missing_fields(df, SAMPLE_REQUIRED), lambda n: F.concat(F.lit("missing_"), n))
    bad = [
        F.when(F.coalesce(~F.col("variant").isin("before", "after"), F.lit(True)), F.lit("invalid_variant")),
        F.when(F.coalesce(~F.col("token_count").between(1, max_tokens), F.lit(True)), F.lit("invalid_token_count")),
        F.when(~K.text(F.col("file_path")).endswith(".py"), F.lit("non_python_path")),
    ]
    return F.concat(missing, F.array_compact(F.array(*bad)))
