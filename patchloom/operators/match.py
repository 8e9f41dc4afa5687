"""Which file of a diff a group of functions came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def score_candidates(groups: DataFrame, files: DataFrame, on: str) -> DataFrame:
    """Scores of the files of a group's commit.

    groups: on, group_id, before_lines, after_lines, names, only_python; files:
    on, path, deleted, added, context, patch. Hits are sizes of intersections of
    line sets; context hits count six at most.
    """
    joined = groups.join(files, on).where(~F.col("only_python") | F.col("path").endswith(".py"))
    deleted = F.size(F.array_intersect("before_lines", "deleted"))
    added = F.size(F.array_intersect("after_lines", "added"))
    context = F.size(F.array_intersect(F.array_union("before_lines", "after_lines"), "context"))
    named = F.size(F.filter("names", lambda n: F.regexp_like(F.col("patch"), F.concat(F.lit(r"\b\Q"), n, F.lit(r"\E\b")))))
    scored = joined.withColumns({"deleted_hits": deleted, "added_hits": added, "context_hits": context, "name_hits": named})
    return scored.withColumn("score", 10 * (F.col("deleted_hits") + F.col("added_hits")) + F.least("context_hits", F.lit(6)) + 2 * F.col("name_hits"))


def best_with_ties(scored: DataFrame, group: list[str], score: str, name: str, shown: str | None = None) -> DataFrame:
    """The best row of each group, the score behind it, and the first five as
    text: name=score, or the column shown."""
    order = Window.partitionBy(*group).orderBy(F.desc(score), name)
    ranked = scored.withColumns({"_rank": F.row_number().over(order), "runner_up": F.lead(score).over(order)})
    top = ranked.where("_rank <= 5")
    listed = top.groupBy(*group).agg(F.concat_ws(";", F.transform(F.array_sort(F.collect_list(F.struct("_rank", (F.col(shown) if shown else F.concat_ws("=", F.col(name).cast("string"), F.col(score).cast("string"))).alias("x")))), lambda s: s["x"])).alias("candidates"))
    return top.where("_rank = 1").drop("_rank").join(listed, group)


def outcome(best: DataFrame) -> Column:
    """resolved, or why a group's path isn't. A side that has code must meet a
    changed line of its own."""
    c = F.col
    side = (c("has_before") & (c("deleted_hits") == 0)) | (c("has_after") & (c("added_hits") == 0))
    weak = (c("deleted_hits") + c("added_hits") < 2) & (c("name_hits") == 0)
    none = F.coalesce(c("score") == 0, F.lit(True))
    return F.when(none, "no_code_match").when(side, "missing_before_or_after_change_match").when(c("runner_up") == c("score"), "ambiguous_equal_score").when(weak, "weak_match").otherwise("resolved")
