"""The filter plans: scans and lookups, facts of code, rules, duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.functions import keys as K
from patchloom.functions.pycode import binds, code_facts
from patchloom.operators import dedup, joins, numbering, rules, summaries
from patchloom.plans.chunking import field
from patchloom.sources import jsonl

# fixed values: where a row may hold its path, name and commit, in order
PATHS = ("file_path", "filename", "old_path", "new_path")
NAMES = ("function_name", "method_name")
COMMITS = ("commit", "commit_url", "commit_hash")
CWES = ("cwe", "cwes", "CWE", "cwe_id")
#: Counts of the tokens of code_before and code_after by the model's tokenizer.
Counts = tuple[Column, Column]


def _first(df: DataFrame, names: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.nullif(F.trim(K.text(F.col(n))), F.lit("")) for n in names if n in df.columns], F.lit(None).cast("string"))


def _counted(df: DataFrame, tokens: Counts | None) -> DataFrame:
    """df with token counts: the given exact ones, else estimates, which the
    rules never accept. A null exact count is an estimate too."""
    given = tokens or (F.lit(None), F.lit(None))
    blank = [F.trim(K.text(F.col(f"code_{s}"))) == "" for s in ("before", "after")]
    exact = [c.isNotNull() | b for c, b in zip(given, blank, strict=True)]
    counts = {f"tokens_{s}": F.coalesce(c.cast("long"), K.approx_tokens(F.col(f"code_{s}"))) for s, c in zip(("before", "after"), given, strict=True)}
    return df.withColumns(counts | {"tokens_exact": exact[0] & exact[1]})


def prepare_primary(rows: DataFrame, cwe_map: DataFrame, commit_index: DataFrame, metadata: DataFrame, tokens: Counts | None = None) -> DataFrame:
    """Rows (source_line, commit, cwe, function_name, code_before, code_after,
    programming_language, file_change_id, file_path, or their other names; and
    repository) with all that the rules read. Without exact token counts of both
    sides no row can be accepted."""
    parts = K.with_repository(K.commit_parts(_first(rows, COMMITS)), field(rows, "repository", "string"))
    own = [F.col(c) for c in PATHS if c in rows.columns] or [F.lit(None).cast("string")]
    embedded = K.source_cwes(*[F.col(c) for c in CWES if c in rows.columns] or [F.lit("")])
    base = rows.withColumns({"_own": K.resolve_path(own, []), "_embedded": embedded, "_name": _first(rows, NAMES), "_parts": parts})
    keyed = base.withColumns({"commit": F.col("_parts"), "function_name": F.col("_name"), "cwes_embedded": F.col("_embedded")}).withColumn("_keys", K.lookup_keys(F.col("commit")))
    map_keys = cwe_map.select(F.explode(K.lookup_keys(K.commit_parts(F.col("key")))).alias("key"), "value")
    index_keys = commit_index.select(F.explode(K.lookup_keys(K.commit_parts(F.col("value")))).alias("key")).distinct()
    mapped = joins.melted_lookup(keyed, "source_line", F.col("_keys"), map_keys, "key", "value")
    found = joins.indexed(mapped, "source_line", F.col("_keys"), index_keys, "key", "indexed")
    given = [F.col(c) for c in PATHS if c in metadata.columns]
    paths = metadata.select(F.col("file_change_id").cast("string").alias("file_change_id"), K.resolve_path(given, []).alias("_path"))
    joined = found.withColumn("file_change_id", F.col("file_change_id").cast("string")).join(joins.small(paths), "file_change_id", "left")
    facts = joined.withColumns({"cwes_mapped": K.source_cwes(F.array_join("hits", " ")), "path": F.coalesce("_own", "_path"), "before_is": code_facts("code_before"), "after_is": code_facts("code_after")})
    named = facts.withColumns({
        "cwes": K.source_cwes(F.array_join("cwes_embedded", " "), F.array_join("cwes_mapped", " ")),
        "language_is": K.language_decision(F.col("programming_language"), F.col("path"), F.col("before_is.valid")),
        "pair_id": K.pair_id(F.col("commit.repository_id"), F.col("commit.commit_id"), F.col("path"), F.col("file_change_id"), F.col("function_name")),
    })
    return _counted(named, tokens).drop("_keys", "_path", "_own", "_embedded", "_name", "_parts", "hits")


def malformed(errors: DataFrame, like: DataFrame) -> DataFrame:
    """Error rows (source_line, error) of a tolerant scan as rows of like: all
    null but their line, and no weakness."""
    given = {"source_line": F.col("source_line"), "cwes": F.array().cast("array<string>"), "invalid_json": F.col("error")}
    return errors.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in like.withColumn("invalid_json", F.lit("")).schema])


def with_sample_ids(rows: DataFrame) -> DataFrame:
    """rows with sample_id, numbered by line for each first target weakness; a
    malformed row takes a number of the unmapped ones and has an id of its own."""
    target = F.get(F.filter("cwes", lambda c: c.isin(*K.TARGETS)), F.lit(0))
    bucketed = rows.withColumn("_target", F.coalesce(target, F.lit("UNMAPPED")))
    ranked = numbering.rank_within(bucketed, ["_target"], [F.col("source_line")], numbering.by_number("source_line"), "_number")
    own = F.format_string("%s_%06d", F.translate("_target", "-", "_"), "_number")
    invalid = F.format_string("INVALID_%06d", F.col("source_line").cast("long"))
    return ranked.withColumn("sample_id", F.when(F.col("invalid_json").isNotNull(), invalid).otherwise(own)).drop("_target", "_number")


def filter_primary(prepared: DataFrame, max_tokens: int = 512, errors: DataFrame | None = None) -> DataFrame:
    """Classified rows with sample ids and resolved duplicates; errors, the bad
    lines of a tolerant scan, are emitted as rejected rows."""
    rows = prepared.withColumn("invalid_json", F.lit(None).cast("string"))
    named = with_sample_ids(rows if errors is None else rows.unionByName(malformed(errors, prepared)))
    good, bad = F.col("invalid_json").isNull(), F.col("invalid_json").isNotNull()
    code = F.coalesce(F.nullif(F.col("before_is.normalized"), F.lit("")), F.nullif(F.col("code_before"), F.lit("")))
    over = (F.col("tokens_before") > max_tokens) | (F.col("tokens_after") > max_tokens)
    ruled = [(rank, reason, good & when) for rank, reason, when in rules.primary_rules(max_tokens)] + [(rules.REJ, "rejected_invalid_json", bad)]
    classified = rules.apply_rules(named, ruled).withColumns({"code_key": K.content_hash(code), "exceeds_model_limit": F.coalesce(over, F.lit(False)), "has_paired_negative": F.trim(K.text(F.col("code_after"))) != ""})
    linked = dedup.resolve_components(classified, "source_line", ["code_key", "pair_id"], F.array_join("cwes", ","), ["sample_id", "source_line"])
    conflict = rules.raise_status(linked, F.col("component_conflict"), rules.MAN, "manual_review_label_conflict")
    duplicate = ~F.col("is_primary") & ~F.col("component_conflict")
    return rules.raise_status(conflict.withColumn("is_duplicate", duplicate), duplicate, rules.REJ, "rejected_duplicate")


def filter_file(spark: SparkSession, path: str, schema: str, cwe_map: DataFrame, commit_index: DataFrame, metadata: DataFrame, tokens: Counts | None = None, max_tokens: int = 512) -> DataFrame:
    """The filter over a file of JSON lines: every line that isn't blank is
    emitted, the malformed ones too."""
    scanned = jsonl.read_tolerant(spark, path, schema)
    good = scanned.where("error IS NULL").select("source_line", "record.*")
    bad = scanned.where("error IS NOT NULL").select("source_line", "error")
    return filter_primary(prepare_primary(good, cwe_map, commit_index, metadata, tokens), max_tokens, bad)


def filter_summary(records: DataFrame) -> DataFrame:
    """One row for each target weakness, zeros kept; a row with several targets
    counts for each of them."""
    spark = records.sparkSession
    dim = spark.createDataFrame([(c, *v) for c, v in K.TARGETS.items()], "cwe string, label string, owasp_2025 string")

    def when(condition: Column | str) -> Column:
        return F.count_if(condition)

    pair = F.when(F.col("has_paired_negative"), F.col("pair_id"))
    counts = {
        "total_raw": F.count(F.lit(1)), "python_samples": when(F.col("language_is.is_python")), "accepted": when("status = 'ACCEPTED'"),
        "manual_review": when("status = 'MANUAL_REVIEW'"), "rejected": when("status = 'REJECTED'"), "unique_repositories": F.count_distinct("commit.repository_id"),
        "unique_commits": F.count_distinct("commit.commit_id"), "vulnerable_fixed_pairs": F.count_distinct(pair), "duplicates": when("is_duplicate"), "over_token_limit": when("exceeds_model_limit"),
    }
    return summaries.over_dimension(dim, records.withColumn("cwe", F.explode(F.array_distinct("cwes"))), "cwe", counts)


def filter_external(pairs: DataFrame, max_tokens: int = 512, tokens: Counts | None = None) -> DataFrame:
    """Classified external pairs; the first of equal weaknesses and code wins.
    Without exact token counts of both sides no pair can be accepted."""
    known = dict(pairs.dtypes)
    optional = {n: F.lit(None).cast(t) for n, t in (("unit_type", "string"), ("cwe_isolation_evidence", "string"), ("advisory_cwes", "array<string>"), *((f"{e}_line_{s}", "int") for e in ("start", "end") for s in ("before", "after"))) if n not in known}
    full = pairs.withColumns(optional) if optional else pairs
    full = full.withColumns({"missing_required_fields": rules.missing_fields(full, rules.PAIR_REQUIRED), "advisory_cwes": F.coalesce("advisory_cwes", "cwes"), "before_is": code_facts("code_before"), "after_is": code_facts("code_after")})
    # only blocks have to bind their name, so only they are parsed for it
    block = F.coalesce(F.col("unit_type") == "module_block", F.lit(False))
    name = K.text(F.col("function_name"))
    full = full.withColumns({
        "bound": block & binds(F.when(block, K.text(F.col("code_before"))), name) & binds(F.when(block, K.text(F.col("code_after"))), name),
        "pair_id": K.external_pair_id(F.col("repository"), F.col("commit_id"), F.col("file_path"), F.col("function_name")),
        "owasp_2025": K.labels_of(F.col("cwes"), 1), "labels": K.labels_of(F.col("cwes")),
    })
    classified = rules.apply_rules(_counted(full, tokens), rules.external_rules(max_tokens))
    key = F.array_join(F.array_sort("cwes"), ","), K.content_hash(F.col("before_is.normalized"))
    flagged = dedup.first_wins(classified, list(key), [F.col("source_line")])
    return rules.raise_status(flagged, ~F.col("is_first"), rules.REJ, "rejected_duplicate").drop("is_first")
