"""File paths of functions that have none, from the diffs of their commits."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions import keys as K
from patchloom.functions.diffs import diff_lines
from patchloom.operators import dedup, joins, match

#: The outcome of a group that a diff resolves.
RESOLVED = "unique_high_confidence_diff_match"
UNREADABLE = "download_or_parse_error"


class Recovered(NamedTuple):
    resolved: DataFrame
    unresolved: DataFrame
    counters: DataFrame


def is_python(c: Column) -> Column:
    return F.lower(F.trim(K.text(c))).isin(*K.PYTHON_NAMES)


def selected(functions: DataFrame, cwe_map: DataFrame, target_only: bool = True, python_only: bool = True) -> DataFrame:
    """Function rows (source_line, commit, file_change_id, function_name,
    code_before, code_after, programming_language) of known commits with join_key,
    parts and cwes; of several entries of the map (key, value, ordinal) for a
    commit the last holds."""
    commit = K.commit_parts(F.col("commit"))
    keyed = cwe_map.select(K.commit_parts(F.col("key"))["join_key"].alias("join_key"), "ordinal", "value").where("join_key <> ''")
    entries = keyed.groupBy("join_key", "ordinal").agg(K.source_cwes(F.array_sort(F.collect_set("value"))).alias("cwes"))
    last = dedup.last_wins(entries, "join_key", F.col("ordinal")).select("join_key", "cwes")
    rows = functions.withColumn("parts", commit).withColumn("join_key", F.col("parts.join_key")).join(joins.small(last), "join_key", "left")
    cwes = F.coalesce("cwes", F.array().cast("array<string>"))
    kept = rows.withColumn("cwes", cwes).where((F.col("join_key") != "") & (K.text(F.col("file_change_id")) != ""))
    if target_only:
        kept = kept.where(F.arrays_overlap("cwes", F.array(*[F.lit(t) for t in K.TARGETS])))
    return kept.where(is_python(F.col("programming_language"))) if python_only else kept


def groups_of(rows: DataFrame) -> DataFrame:
    """One row for each commit and changed file: the line sets, names and lines
    of its functions. A group is the functions of one file."""
    def united(c: Column) -> Column:
        return F.array_distinct(F.flatten(F.collect_list(c)))

    name = F.nullif(K.text(F.col("function_name")), F.lit(""))
    return rows.groupBy("join_key", F.col("file_change_id").cast("string").alias("file_change_id")).agg(
        F.first("parts").alias("parts"), F.min_by("cwes", "source_line").alias("cwes"),
        united(K.code_lines(F.col("code_before"))).alias("before_lines"), united(K.code_lines(F.col("code_after"))).alias("after_lines"),
        F.max(F.trim(K.text(F.col("code_before"))) != "").alias("has_before"), F.max(F.trim(K.text(F.col("code_after"))) != "").alias("has_after"),
        F.max(is_python(F.col("programming_language"))).alias("only_python"), F.array_sort(F.collect_set(name)).alias("names"), F.array_sort(F.collect_list("source_line")).alias("source_lines"),
    ).withColumn("group_id", F.concat_ws("|", "join_key", "file_change_id"))


def files_of(diffs: DataFrame) -> DataFrame:
    """Files of the diffs (join_key, diff_text) with their line sets."""
    files = diffs.where(F.col("diff_text").startswith("diff --git ")).select("join_key", F.explode(diff_lines("diff_text")).alias("f"))
    return files.select("join_key", F.coalesce("f.new_path", "f.old_path").alias("path"), "f.*").where("path IS NOT NULL")


def recover(functions: DataFrame, cwe_map: DataFrame, diffs: DataFrame, target_only: bool = True, python_only: bool = True) -> Recovered:
    """Paths of groups that exactly one file of their commit's diff matches best,
    the reasons of the others, and counters of it all. diffs: join_key, diff_text,
    one row for each commit that a cache holds."""
    rows = selected(functions, cwe_map, target_only, python_only)
    groups, files = groups_of(rows), files_of(diffs)
    scored = match.score_candidates(groups, files, "join_key")
    shown = F.format_string("%s|score=%d|del=%d|add=%d", "path", "score", "deleted_hits", "added_hits")
    best = match.best_with_ties(scored.withColumn("_shown", shown), ["group_id"], "score", "path", shown="_shown")
    own = ["group_id", "path", "old_path", "new_path", "score", "runner_up", "deleted_hits", "added_hits", "context_hits", "name_hits", "candidates"]
    readable = files.select("join_key").distinct().withColumn("_readable", F.lit(True))
    judged = groups.join(readable, "join_key", "left").join(best.select(*own), "group_id", "left")
    reason = F.when(F.col("_readable").isNull(), UNREADABLE).otherwise(match.outcome(judged))
    told = judged.withColumn("reason", F.when(reason == "resolved", RESOLVED).otherwise(reason))
    evidence = F.struct("score", F.col("deleted_hits").alias("deleted_line_hits"), F.col("added_hits").alias("added_line_hits"), F.col("context_hits").alias("context_line_hits"), F.col("name_hits").alias("function_name_hits"))
    resolved = told.where(F.col("reason") == RESOLVED).select(
        "file_change_id", F.col("parts.canonical_url").alias("commit"), F.col("parts.repository").alias("repository"), F.col("path").alias("file_path"), "old_path", "new_path",
        F.col("reason").alias("match_method"), F.lit("high").alias("confidence"), evidence.alias("match_evidence"), F.col("names").alias("function_names"), "cwes", "source_lines",
    )
    unresolved = told.where(F.col("reason") != RESOLVED).select(
        "file_change_id", F.col("parts.canonical_url").alias("commit"), F.array_join("names", ";").alias("function_names"), F.array_join("cwes", ";").alias("cwes"), "reason", F.coalesce("candidates", F.lit("")).alias("top_candidates")
    )
    return Recovered(resolved, unresolved, counters(functions, told, resolved, unresolved))


def counters(functions: DataFrame, told: DataFrame, resolved: DataFrame, unresolved: DataFrame) -> DataFrame:
    """(metric, value): rows, groups and commits, groups by outcome, outputs."""
    def one(name: str, rows: DataFrame) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value")

    readable = F.when(F.col("reason") == UNREADABLE, "download_or_parse_failures").otherwise("cached_commits")
    commits = told.select("join_key", readable.alias("metric")).distinct().groupBy("metric").agg(F.count(F.lit(1)).alias("value"))
    name = F.when(F.col("reason") == RESOLVED, "resolved_groups").otherwise(F.col("reason"))
    outcomes = told.where(F.col("reason") != UNREADABLE).groupBy(name.alias("metric")).agg(F.count(F.lit(1)).alias("value"))
    out = one("input_rows", functions).unionByName(one("selected_groups", told)).unionByName(one("selected_commits", told.select("join_key").distinct()))
    return out.unionByName(commits).unionByName(outcomes).unionByName(one("resolved_output_rows", resolved)).unionByName(one("unresolved_output_rows", unresolved))
