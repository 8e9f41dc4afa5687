"""Detector findings against rule tables, cohorts and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.operators.joins import small
from patchloom.operators.numbering import rank_within
from patchloom.operators.splits import seeded

#: Rules that are matched as one array; more are joined.
ARRAY_RULES = 10_000


def rule_table(lines: DataFrame, value: str = "value", kind: str = "spaced") -> DataFrame:
    """(ordinal, rule, cwes) of a rule list's lines (ordinal, value); a rule's
    place is that of its first line. ``spaced``: the weakness, two words and the
    name; ``dashed``: the code, its weaknesses and a text between dashes."""
    if kind == "spaced":
        parts = F.split(value, " ", 4)
        rows = lines.select("ordinal", F.regexp_replace(F.get(parts, F.lit(3)), r"^\t+|\t+$", "").alias("rule"), F.array(F.get(parts, F.lit(0))).alias("named"))
    elif kind == "dashed":
        parts = F.split(value, " - ", 4)
        rows = lines.select("ordinal", F.get(parts, F.lit(0)).alias("rule"), F.split(F.get(parts, F.lit(1)), ", ").alias("named"))
    else:
        raise ValueError(f"unknown kind of rule table: {kind}")
    each = rows.where("rule IS NOT NULL").select("ordinal", "rule", F.posexplode("named").alias("at", "cwe"))
    listed = each.groupBy("rule").agg(F.min("ordinal").alias("ordinal"), F.array_sort(F.collect_list(F.struct("ordinal", "at", "cwe"))).alias("all"))
    return listed.select("ordinal", "rule", F.transform("all", lambda x: x["cwe"]).alias("cwes"))


def exact_rule(findings: DataFrame, code: str, rules: DataFrame) -> DataFrame:
    """findings with ordinal and cwes of the rule whose name is their code."""
    return findings.join(small(rules.select(F.col("rule").alias(code), "ordinal", "cwes")), code)


def contained_rules(findings: DataFrame, text: str, rules: DataFrame, rule: str = "rule", ordinal: str = "ordinal") -> DataFrame:
    """findings with _hits: all rules whose name stands in the text, by ordinal.

    A rule table is small by nature and is matched as one array in each row; one
    of more than ARRAY_RULES rows is joined instead.
    """
    fields = [ordinal, *[c for c in rules.columns if c != ordinal]]
    few = rules.limit(ARRAY_RULES + 1).count() <= ARRAY_RULES
    if few:
        table = rules.agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_rules"))
        return findings.join(F.broadcast(table)).withColumn("_hits", F.filter("_rules", lambda r: F.col(text).contains(r[rule]))).drop("_rules")
    texts = findings.select(F.col(text).alias("_text")).distinct()
    met = texts.join(rules, F.col("_text").contains(F.col(rule))).groupBy("_text").agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_hits"))
    empty = F.array().cast(met.schema["_hits"].dataType)
    return findings.join(met, F.col(text) == F.col("_text"), "left").drop("_text").withColumn("_hits", F.coalesce("_hits", empty))


def any_rule(findings: DataFrame, text: str, rules: DataFrame, cwe: str) -> DataFrame:
    """findings with rules: the names of all rules that stand in the text and
    list the finding's own weakness; findings without one go."""
    hits = contained_rules(findings, text, rules)
    named = F.transform(F.filter("_hits", lambda r: F.array_contains(r["cwes"], F.col(cwe))), lambda r: r["rule"])
    return hits.withColumn("rules", named).drop("_hits").where(F.size("rules") > 0)


def cohort(rows: DataFrame, existing: DataFrame, failed: DataFrame, on: str, language: Column | None = None) -> DataFrame:
    """Rows of commits that exist and haven't failed, in one language."""
    kept = rows if language is None else rows.where(language)
    return kept.join(existing.select(on), on, "left_semi").join(failed.select(on), on, "left_anti")


def looked_up(rows: DataFrame, table: DataFrame, on: str, value: str) -> DataFrame:
    """rows with the table's value; a row without one fails the job. The table
    has one row for each key."""
    joined = rows.join(table.select(on, F.col(value).alias("_value")), on, "left")
    failed = F.raise_error(F.concat(F.lit(f"no {value} for "), F.coalesce(F.col(on).cast("string"), F.lit("null"))))
    return joined.withColumn(value, F.coalesce("_value", failed)).drop("_value")


def with_default(rows: DataFrame, table: DataFrame, on: str, value: str, default: Column) -> DataFrame:
    """rows with the table's value, or a default."""
    return rows.join(table.select(on, F.col(value).alias("_value")), on, "left").withColumn(value, F.coalesce("_value", default)).drop("_value")


def membership(rows: DataFrame, members: DataFrame, on: str, inside: str = "single", outside: str = "multi", name: str = "bucket") -> DataFrame:
    """rows with one of two words: whether their key is a member."""
    held = members.select(on).distinct().withColumn("_in", F.lit(True))
    return rows.join(held, on, "left").withColumn(name, F.when(F.col("_in"), inside).otherwise(outside)).drop("_in")


def by_position(responses: DataFrame, requests: DataFrame, order: str) -> DataFrame:
    """Responses with the request that stands at their custom_id, from 1."""
    numbered = rank_within(requests.withColumn("_all", F.lit(0)), ["_all"], [F.col(order)], F.floor(F.col(order) / 1_000_000).cast("long"), "_at").drop("_all")
    return responses.join(numbered, F.col("custom_id").try_cast("long") == F.col("_at")).drop("_at")


def matches_by_weakness(findings: DataFrame, cwe: str) -> DataFrame:
    """(cwe, matches), to be sorted by matches where it is shown."""
    return findings.groupBy(F.col(cwe).alias("cwe")).agg(F.count(F.lit(1)).alias("matches"))


def filled_sample(rows: DataFrame, before: DataFrame, on: str, size: int = 50, seed: int = 42) -> DataFrame:
    """What was sampled before and is still there, filled up to size by seeded
    hash from the other rows; the size is the sample's."""
    kept = before.join(rows.select(on), on, "left_semi").select(on).distinct()
    drawn = rows.select(on).distinct().join(kept, on, "left_anti").withColumn("_drawn", seeded(seed, F.col(on)))
    more = max(0, size - kept.limit(size).count())
    return kept.withColumn("origin", F.lit("kept")).unionByName(drawn.orderBy("_drawn", on).limit(more).select(on, F.lit("new").alias("origin")))


def report_groups(rows: DataFrame, key: str, skip: int = 0) -> DataFrame:
    """(key, n) of groups in falling size, without the first ones. Groups are few
    beside the rows: they are weaknesses or severities."""
    sized = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window

    place = F.row_number().over(Window.orderBy(F.desc("n"), key))
    return sized.withColumn("place", place).where(F.col("place") > skip)


