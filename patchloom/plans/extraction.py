"""Function and module-block pairs of fix commits from cached diffs and sources."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions import keys as K
from patchloom.functions.diffs import diff_numbers
from patchloom.functions.pycode import parses, slice_of, spans_of
from patchloom.operators import joins, numbering
from patchloom.plans.chunking import field

READY = "READY_FOR_EXTRACTION"
CREDENTIALS = "CWE-798"
# fixed values: the record's provenance
DATASET, DATASET_URL = "GitHub Advisory Database", "https://github.com/advisories"
LICENSE = "CC-BY-4.0 advisory metadata; source code retains repository license"
# fixed values: what a curator may add to a candidate, with its type
CURATED = {
    "cve_id": "string", "summary": "string", "advisory_url": "string", "isolated_target_cwe": "string", "cwe_isolation_evidence": "string", "platform": "string",
    "vulnerability_scope": "string", "domain": "string", "curation_status": "string", "curation_notes": "string",
    "include_functions": "array<string>", "include_module_bindings": "array<string>", "include_module_files": "array<string>",
}
#: What a review row tells, beside its reason.
REVIEW = ("ghsa_id", "cve_id", "repository", "commit_id", "commit_url", "file_path", "function_name")


class Extracted(NamedTuple):
    pairs: DataFrame
    review: DataFrame


def production(files: DataFrame) -> DataFrame:
    """Python files on both sides that aren't tests or the like."""
    return files.where(F.col("old_path").endswith(".py") & F.col("new_path").endswith(".py") & ~K.is_review_path(F.col("new_path")))


def touched(sources: DataFrame, lines: DataFrame, side: str, on: list[str]) -> DataFrame:
    """(on, qname, start, end, code) of the functions of one side that hold a
    changed line; of equal names the last counts. lines: on, line."""
    spans = sources.select(*on, F.explode(spans_of(side)).alias("s")).select(*on, "s.*")
    hit = joins.interval_join(lines, spans, on, "line", "start", "end").select(*on, "qname", "start", "end", "code").distinct()
    last = hit.groupBy(*on, "qname").agg(F.max_by(F.struct("start", "end", "code"), "start").alias("s"))
    return last.select(*on, "qname", F.col("s.start").alias(f"start_line_{side}"), F.col("s.end").alias(f"end_line_{side}"), F.col("s.code").alias(f"code_{side}"))


def changed_functions(diffs: DataFrame, sources: DataFrame) -> DataFrame:
    """(commit, path, qname, code and lines of both sides) of functions that a
    diff touches on both sides and whose text differs.

    diffs: commit, diff_text; sources: commit, path, before, after. Changed lines
    meet function spans by commit and file.
    """
    on = ["commit", "path"]
    files = diffs.select("commit", F.explode(diff_numbers("diff_text")).alias("f")).select("commit", "f.*")
    kept = production(files).withColumn("path", F.col("new_path"))
    held = sources.join(kept.select(*on), on, "left_semi")
    sides = [touched(held, kept.select(*on, F.explode(lines).alias("line")), side, on) for side, lines in (("before", "old_lines"), ("after", "new_lines"))]
    return sides[0].join(sides[1], [*on, "qname"]).where("code_before <> code_after")


def gate(candidates: DataFrame) -> Column:
    """Why a candidate's scope rules it out, or null: an isolated weakness needs
    module bindings, and bindings need credentials as the only weakness, or
    evidence that a curator has approved."""
    c = F.col
    cwes = F.array_sort(F.array_distinct("cwes"))
    isolated = K.text(c("isolated_target_cwe"))
    bindings = F.size("include_module_bindings") > 0
    exact = (cwes == F.array(F.lit(CREDENTIALS))) & (isolated == "")
    curated = (
        (F.size(cwes) > 1) & F.array_contains(cwes, CREDENTIALS) & (isolated == CREDENTIALS) & (c("target_cwe") == CREDENTIALS)
        & (K.text(c("curation_status")) == "APPROVED_FOR_STAGING") & (F.trim(K.text(c("cwe_isolation_evidence"))) != "") & (F.size("include_module_files") > 0)
    )
    return F.when((isolated != "") & ~bindings, "rejected_isolated_cwe_requires_module_binding_scope").when(bindings & ~F.coalesce(exact | curated, F.lit(False)), "rejected_module_scope_without_cwe798_isolation_evidence")


def _review(df: DataFrame, reason: Column | str) -> DataFrame:
    why = F.lit(reason) if isinstance(reason, str) else reason
    return df.select(*[field(df, c, "string").alias(c) for c in REVIEW], why.alias("reason"))


def extract(candidates: DataFrame, commits: DataFrame, diffs: DataFrame, sources: DataFrame) -> Extracted:
    """Pairs of the candidates that are ready, and review rows with the reason of
    everything that gave none.

    candidates: ordinal (unique), ghsa_id, candidate_status, target_cwe, cwes,
    fix_commits and what CURATED names; commits: repository, commit_id, parents,
    message; diffs: repository, commit_id, diff_text; sources: repository, rev,
    path, source. The last three are caches that other jobs fill: a row that is
    missing there is a download error.
    """
    full = candidates.withColumns({n: field(candidates, n, k) for n, k in CURATED.items()}).where(F.col("candidate_status") == READY)
    judged = full.withColumn("_gate", gate(full))
    review = [_review(judged.where("_gate IS NOT NULL").select("ghsa_id", "_gate"), F.col("_gate"))]

    fixes = judged.where("_gate IS NULL").select("*", F.posexplode("fix_commits").alias("_fix_at", "_fix")).select("*", "_fix.repository", "_fix.commit_id", "_fix.commit_url")
    on = ["repository", "commit_id"]
    known = fixes.join(commits.select(*on, "parents", "message"), on, "left").join(diffs.select(*on, "diff_text"), on, "left")
    parent = F.when(F.size("parents") == 1, F.get("parents", F.lit(0)))
    missing = F.col("parents").isNull() | (parent.isNotNull() & F.col("diff_text").isNull())
    route = F.when(missing, "manual_review_download_or_parse_error").when(parent.isNull(), "manual_review_non_single_parent_commit")
    routed = known.withColumns({"_parent": parent, "_route": route})
    review.append(_review(routed.where("_route IS NOT NULL"), F.col("_route")))

    row = ["ordinal", "_fix_at"]
    parsed = routed.where("_route IS NULL").withColumn("_files", diff_numbers("diff_text")).drop("diff_text")
    good = F.filter("_files", lambda f: F.coalesce(f["old_path"].endswith(".py") & f["new_path"].endswith(".py") & ~K.is_review_path(f["new_path"]), F.lit(False)))
    counted = parsed.withColumn("_files", good)
    review.append(_review(counted.where(F.size("_files") == 0), "rejected_no_production_python_file"))
    worked = counted.where(F.size("_files") > 0)
    files = worked.select("*", F.posexplode("_files").alias("_file_at", "_f")).select("*", "_f.old_path", "_f.new_path", "_f.old_lines", "_f.new_lines").withColumn("file_path", F.col("new_path")).drop("_files", "_f", "_fix", "fix_commits")
    files = files.where((F.size("include_module_files") == 0) | F.array_contains("include_module_files", F.col("new_path")))
    texts = [sources.select("repository", F.col("rev").alias(rev), F.col("path").alias(path), F.col("source").alias(side)) for rev, path, side in (("_parent", "old_path", "before"), ("commit_id", "new_path", "after"))]
    read = files.join(texts[0], ["repository", "_parent", "old_path"], "left").join(texts[1], ["repository", "commit_id", "new_path"], "left")
    checked = read.withColumn("_valid", F.coalesce(parses("before") & parses("after"), F.lit(False)))
    review.append(_review(checked.where("NOT _valid"), "manual_review_source_or_ast_error"))
    valid = checked.where("_valid")
    module = F.size("include_module_bindings") > 0
    place = [*row, "_file_at"]

    functions = valid.where(~module)
    sides = [touched(functions.select(*place, side), functions.select(*place, F.explode(lines).alias("line")), side, place) for side, lines in (("before", "old_lines"), ("after", "new_lines"))]
    both = sides[0].join(sides[1], [*place, "qname"])
    review.append(_review(functions.join(both.select(*place), place, "left_anti"), "manual_review_no_paired_changed_function"))
    carried = [c for c in functions.columns if c not in ("before", "after")]
    changed = both.where("code_before <> code_after").join(functions.select(*carried), place).withColumn("function_name", F.col("qname"))
    listed = (F.size("include_functions") == 0) | F.array_contains("include_functions", F.col("qname"))
    review.append(_review(changed.where(~listed), "excluded_by_batch_function_allowlist"))

    bindings = valid.where(module).select("*", F.explode(F.array_sort(F.array_distinct("include_module_bindings"))).alias("_binding"))
    cut = bindings.withColumns({"_b": slice_of("before", F.col("_binding")), "_a": slice_of("after", F.col("_binding"))})
    found = F.col("_b.qname").isNotNull() & F.col("_a.qname").isNotNull()
    review.append(_review(cut.where(~found).withColumn("function_name", F.col("_binding")), "manual_review_missing_module_binding"))

    def envelope(lines: str, block: str) -> Column:
        return F.exists(lines, lambda n: n.between(F.col(f"{block}.start"), F.col(f"{block}.end")))

    blocks = cut.where(found).where(envelope("old_lines", "_b") & envelope("new_lines", "_a") & (F.col("_b.code") != F.col("_a.code")))

    def spans(block: str) -> Column:
        return F.transform(F.col(f"{block}.spans"), lambda s: F.struct(s[0].alias("start_line"), s[1].alias("end_line")))

    def lone(start: str, end: str) -> Column:
        return F.array(F.struct(F.col(start).alias("start_line"), F.col(end).alias("end_line")))

    kept = [c for c in changed.columns if c in carried]
    one = changed.where(listed).select(*kept, "qname", *[f"{n}_{s}" for n in ("start_line", "end_line", "code") for s in ("before", "after")], F.lit("function").alias("unit_type"), lone("start_line_before", "end_line_before").alias("source_spans_before"), lone("start_line_after", "end_line_after").alias("source_spans_after"))
    two = blocks.select(
        *kept, F.col("_binding").alias("qname"), F.col("_b.start").alias("start_line_before"), F.col("_a.start").alias("start_line_after"), F.col("_b.end").alias("end_line_before"), F.col("_a.end").alias("end_line_after"),
        F.col("_b.code").alias("code_before"), F.col("_a.code").alias("code_after"), F.lit("module_block").alias("unit_type"), spans("_b").alias("source_spans_before"), spans("_a").alias("source_spans_after"),
    )
    found_pairs = one.unionByName(two)
    review.append(_review(worked.join(found_pairs.select(*row), row, "left_anti").drop("file_path"), "manual_review_commit_produced_no_pair"))
    out = review[0]
    for r in review[1:]:
        out = out.unionByName(r)
    return Extracted(assembled(found_pairs), out)


def assembled(pairs: DataFrame) -> DataFrame:
    """Pair records, numbered by candidate, fix, file, kind and name."""
    order = [F.col(c) for c in ("ordinal", "_fix_at", "_file_at", "unit_type", "qname")]
    numbered = numbering.rank_within(pairs.withColumn("_all", F.lit(0)), ["_all"], order, numbering.by_number("ordinal"), "_number")
    isolated, target = K.text(F.col("isolated_target_cwe")), K.text(F.col("target_cwe"))
    advisory = F.array_sort(F.array_distinct("cwes"))
    none = F.array().cast("array<string>")
    cwes = F.when(isolated != "", F.array(isolated)).when(F.size(advisory) > 0, advisory).otherwise(F.when(target != "", F.array(target)).otherwise(none))
    identity = F.concat(F.col("repository"), F.lit("@"), F.col("commit_id"), F.lit(":"), F.col("new_path"), F.lit(":"), F.col("qname"))
    bucket = F.coalesce(F.nullif(F.translate(target, "-", ""), F.lit("")), F.lit("CWE_UNKNOWN"))
    sides = [F.col(f"{n}_{s}") for n in ("start_line", "end_line", "source_spans", "code") for s in ("before", "after")]
    return numbered.select(
        F.lit("1.0").alias("schema_version"),
        sample_id(bucket, F.col("_number"), identity).alias("sample_id"),
        F.lit(DATASET).alias("source_dataset"), F.lit(DATASET_URL).alias("source_dataset_url"), F.lit(LICENSE).alias("source_license"),
        F.coalesce("ghsa_id", F.lit("UNKNOWN")).alias("source_record_id"),
        F.array_compact(F.array(F.coalesce("ghsa_id", F.lit("UNKNOWN")), F.nullif(F.col("cve_id"), F.lit("")))).alias("advisory_ids"),
        "advisory_url", "repository", F.col("_parent").alias("parent_commit_id"), "commit_id",
        F.concat(F.lit("https://github.com/"), "repository", F.lit("/commit/"), "commit_id").alias("commit_url"),
        F.col("new_path").alias("file_path"), F.col("qname").alias("function_name"), "unit_type", *sides,
        F.lit("Python").alias("language"), cwes.alias("cwes"), advisory.alias("advisory_cwes"),
        F.when(isolated != "", F.col("cwe_isolation_evidence")).alias("cwe_isolation_evidence"), K.labels_in_order(cwes).alias("labels"),
        F.array_sort("old_lines").alias("changed_lines_before"), F.array_sort("new_lines").alias("changed_lines_after"),
        F.nullif(F.col("message"), F.lit("")).alias("commit_message"), F.col("summary").alias("description"),
        F.when(F.col("unit_type") == "module_block", "fix_commit_changed_module_block").otherwise("fix_commit_changed_function").alias("extraction_method"),
        "platform", "vulnerability_scope", "domain", "curation_status", "curation_notes",
    )


def sample_id(bucket: Column, number: Column, identity: Column) -> Column:
    return F.concat(F.lit("GHSA_"), bucket, F.lit("_"), F.lpad(number.cast("string"), F.greatest(F.lit(4), F.length(number.cast("string"))), F.lit("0")), F.lit("_"), F.substring(F.sha2(identity, 256), 1, 16))


def extraction_summary(extracted: Extracted) -> DataFrame:
    """(metric, value): pairs, review rows, repositories and commits."""
    one = extracted.pairs.agg(F.count(F.lit(1)).alias("normalized_function_pairs"), F.count_distinct("repository").alias("unique_repositories"), F.count_distinct("commit_id").alias("unique_commits"))
    rows = one.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in one.columns])).alias("x")).select("x.*")
    return rows.unionByName(extracted.review.agg(F.count(F.lit(1)).alias("value")).select(F.lit("review_records").alias("metric"), "value"))
