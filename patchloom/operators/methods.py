"""Method rows of commits: which methods changed, and which belong together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.functions import keys as K
from patchloom.operators import joins

ANONYMOUS = "(anonymous)"


def named(methods: DataFrame) -> DataFrame:
    """Methods that have a name."""
    return methods.where(F.col("name") != ANONYMOUS)


def without_tests(rows: DataFrame, path: str = "old_path") -> DataFrame:
    """Rows whose file isn't a test; a null path stays."""
    return rows.where(F.coalesce(~F.col(path).contains("test"), F.lit(True)))


def without_large_commits(methods: DataFrame, commit: str = "commit", most: int = 20) -> DataFrame:
    """Methods of commits with at most so many vulnerable and so many fixed ones."""
    before = F.col("before_change") == "True"
    large = methods.groupBy(commit).agg(F.count_if(before).alias("b"), F.count_if(~before).alias("a")).where((F.col("b") > most) | (F.col("a") > most))
    return methods.join(large.select(commit), commit, "left_anti")


def with_fixed_code(pairs: DataFrame) -> DataFrame:
    """Pairs whose fixed code isn't empty."""
    return pairs.where(F.length(K.text(F.col("code_after"))) > 0)


def links_of_repository(references: Column, repository: Column) -> Column:
    """The references that are commits of the repository."""
    return F.filter(references, lambda r: r.contains(F.concat(repository, F.lit("/commit"))))


def file_rows(commits: DataFrame) -> DataFrame:
    """A row for each file of a commit; a commit without files has one of nulls."""
    return commits.select(*[c for c in commits.columns if c != "commit_files"], F.explode_outer("commit_files").alias("_f")).select("*", "_f.*").drop("_f")


def sources_in_order(sources: list[DataFrame], link: str, descriptions: DataFrame | None = None) -> DataFrame:
    """Commit rows of several reports as one table with source_ord; a missing
    description is filled from (report_link, description), else empty."""
    out = sources[0].withColumn("source_ord", F.lit(0))
    for i, frame in enumerate(sources[1:], 1):
        out = out.unionByName(frame.withColumn("source_ord", F.lit(i)), allowMissingColumns=True)
    if descriptions is None:
        return out
    told = descriptions.select(F.col("report_link").alias(link), F.col("description").alias("_told"))
    return out.join(told, link, "left").withColumn("description", F.coalesce("description", "_told", F.lit(""))).drop("_told")


def _changed(methods: DataFrame, lines: DataFrame, file: str) -> DataFrame:
    hit = joins.interval_join(lines, methods.select(file, "start_line", "end_line"), [file], "line", "start_line", "end_line")
    return hit.select(file, "start_line", "end_line").distinct()


def _left(methods: DataFrame, lines: DataFrame, file: str) -> DataFrame:
    """methods with _rest: those of their lines that no change took."""
    gone = lines.groupBy(file).agg(F.collect_set("line").alias("_gone"))
    body = F.split("code", r"\r\n|\r|\n")
    joined = methods.join(gone, file, "left")
    kept = F.filter(F.slice(body, F.lit(1), F.col("end_line") - F.col("start_line") + 1), lambda _, i: ~F.coalesce(F.array_contains(F.col("_gone"), (F.col("start_line") + i).cast("int")), F.lit(False)))
    return joined.withColumn("_rest", kept).drop("_gone")


def changed_pairs(before: DataFrame, after: DataFrame, deleted: DataFrame, added: DataFrame, file: str = "file_change_id") -> DataFrame:
    """(file, name, start_before, start_after) of the methods of a file that a
    change touches on either side; a side without a partner is null.

    before and after: file, name, start_line, end_line, code; deleted and added:
    file, line. A changed method's partner has its name and holds every line that
    the change left of it: the first by start among the changed ones of the other
    side, or, if none of these has the name, among all of them. Methods meet by
    file and name, never across files.
    """
    on = [file, "name"]
    span = [file, "start_line", "end_line"]
    changed = {"before": before.join(_changed(before, deleted, file), span, "left_semi"), "after": after.join(_changed(after, added, file), span, "left_semi")}
    all_of, lines = {"before": before, "after": after}, {"before": deleted, "after": added}

    def partners(side: str, other: str, last: bool) -> DataFrame:
        mine = _left(changed[side], lines[side], file).where(F.size("_rest") > 0).select(*on, F.col("start_line").alias("_mine"), "_rest")
        known = changed[other].select(*on).distinct().withColumn("_known", F.lit(True))
        marked = changed[other].select(*on, F.col("start_line").alias("_other")).withColumn("_hot", F.lit(True))
        pool = all_of[other].select(*on, F.col("start_line").alias("_other"), "code").join(marked, [*on, "_other"], "left")
        met = mine.join(known, on, "left").join(pool, on)
        allowed = F.col("_known").isNull() | (F.col("_hot") & F.lit(not last))
        good = met.where(F.coalesce(allowed, F.lit(False)) & F.forall("_rest", lambda x: F.col("code").contains(x)))
        pick = F.max("_other") if last else F.min("_other")
        return good.groupBy(*on, F.col("_mine").alias(f"start_{side}")).agg(pick.alias(f"start_{other}"))

    there = partners("before", "after", last=False)
    back = partners("after", "before", last=True)
    pairs = there.select(*on, "start_before", "start_after").unionByName(back.select(*on, "start_before", "start_after")).distinct()
    lone = [changed[s].select(*on, F.col("start_line").alias(f"start_{s}")).join(pairs, [*on, f"start_{s}"], "left_anti").withColumn(f"start_{o}", F.lit(None).cast("int")) for s, o in (("before", "after"), ("after", "before"))]
    return pairs.unionByName(lone[0].select(*pairs.columns)).unionByName(lone[1].select(*pairs.columns))


def method_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Methods of both sides as one table; before_change is text, as in the
    files that hold such rows."""
    return named(after).withColumn("before_change", F.lit("False")).unionByName(named(before).withColumn("before_change", F.lit("True")), allowMissingColumns=True)
