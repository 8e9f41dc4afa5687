"""Lookups by several keys, interval joins, pairings and text matches."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a lookup side that are broadcast at most; larger ones are shuffled.
BROADCAST_ROWS = 200_000
#: Pairs that shared_counts gives a task, on average.
TASK_PAIRS = 1_000_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has few rows; one count decides."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """df dealt to the session's number of shuffle tasks, by keys or in turn: Spark
    splits files by bytes, so rows that are few bytes and much work share a task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def melted_lookup(df: DataFrame, row: str, keys: Column, table: DataFrame, key: str, value: str) -> DataFrame:
    """df with ``hits``: the sorted union of the values of any of its keys.

    Keys are melted to rows, so each lookup is one equi join and never an OR.
    """
    melted = df.select(row, F.explode(keys).alias("_key")).distinct()
    values = table.select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    hits = melted.join(values, "_key").groupBy(row).agg(F.array_sort(F.collect_set("_value")).alias("hits"))
    empty = F.array().cast(f"array<{dict(table.dtypes)[value]}>")
    return df.join(hits, row, "left").withColumn("hits", F.coalesce("hits", empty))


def indexed(df: DataFrame, row: str, keys: Column, table: DataFrame, key: str, flag: str) -> DataFrame:
    """df with a flag: one of its keys is in the table."""
    melted = df.select(row, F.explode(keys).alias("_key"))
    hit = melted.join(table.select(F.col(key).alias("_key")), "_key", "left_semi").select(row).distinct().withColumn(flag, F.lit(True))
    return df.join(hit, row, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def interval_join(points: DataFrame, spans: DataFrame, on: list[str], at: str, start: str, end: str) -> DataFrame:
    """Points in closed spans of the same equi key: never a plain range join."""
    return points.join(spans, on).where(F.col(at).between(F.col(start), F.col(end)))


def shared_counts(rows: DataFrame, row: str, group: list[str], other: str, task_pairs: int = TASK_PAIRS) -> DataFrame:
    """(row, other, shared): every two rows, row below other, that are in a group
    together, and in how many. Null ids and keys meet nothing.

    The pairs grow with the square of a group, so they are made where they are
    counted and never shuffled. Rows are dealt to blocks by their id; a group sends
    two lists of rows to the task of each two of its blocks. The number of blocks
    follows the number of pairs, which is counted first, so a task holds a bounded
    number of them, and a large group is dealt over all tasks.
    """
    keyed = rows.select(row, *group).na.drop()
    n = F.col("count").cast("decimal(20,0)")
    sized = keyed.groupBy(F.xxhash64(*group).alias("_group")).count()
    pairs = int(sized.agg(F.sum(n * (n - 1) / 2)).first()[0] or 0)
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), pairs // task_pairs + 1)
    blocks = math.isqrt(2 * tasks) + 1
    block = F.pmod(F.xxhash64(row), F.lit(blocks)).alias("block")
    listed = keyed.repartition(*group).groupBy(*group, block).agg(F.collect_list(row).alias("ids"))
    gathered = listed.groupBy(*group).agg(F.collect_list(F.struct("block", "ids")).alias("_all"))
    left = gathered.select("_all", F.posexplode("_all").alias("_at", "_x"))
    met = left.select("_x", F.explode(F.slice("_all", F.col("_at") + 1, F.size("_all"))).alias("_y"))
    low, high = F.least("_x.block", "_y.block"), F.greatest("_x.block", "_y.block")
    lists = met.select((low * blocks + high).alias("_unit"), (low == high).alias("_one"), F.col("_x.ids").alias("_left"), F.col("_y.ids").alias("_right"))
    dealt = lists.where(~F.col("_one") | (F.size("_left") > 1)).repartition(tasks, "_unit")
    made = dealt.select("_unit", "_one", "_right", F.explode("_left").alias("_a")).select("_unit", "_one", "_a", F.explode("_right").alias("_b"))
    counted = made.where(~F.col("_one") | (F.col("_a") < F.col("_b"))).groupBy("_unit", F.least("_a", "_b").alias(row), F.greatest("_a", "_b").alias(other))
    return counted.agg(F.count(F.lit(1)).alias("shared")).drop("_unit")


def siblings(df: DataFrame, group: list[str], name: str, fields: list[str]) -> DataFrame:
    """df with ``others``: the rows of its group with another name. The group is
    gathered once and filtered, so no pairs of rows are made."""
    gathered = df.groupBy(*group).agg(F.collect_list(F.struct(*fields)).alias("_all"))
    return df.join(gathered, group).withColumn("others", F.array_sort(F.filter("_all", lambda x: x[name] != F.col(name)))).drop("_all")


def pair_explicit_first(left: DataFrame, right: DataFrame, explicit: str, right_id: str, keys: list[str], order: Column, value: str) -> DataFrame:
    """left with right's value: by the explicit id where one is given, without
    falling back, else by the keys; the last in order wins."""
    by_id = right.groupBy(F.col(right_id).alias(explicit)).agg(F.max_by(value, order).alias("_by_id"))
    by_keys = right.groupBy(*keys).agg(F.max_by(value, order).alias("_by_keys"))
    both = left.join(by_id, explicit, "left").join(by_keys, keys, "left")
    return both.withColumn(f"paired_{value}", F.when(F.col(explicit).isNotNull(), F.col("_by_id")).otherwise(F.col("_by_keys"))).drop("_by_id", "_by_keys")


def first_contained(findings: DataFrame, text: str, rules: DataFrame, rule: str, ordinal: str) -> DataFrame:
    """findings with the columns of the first rule whose name stands in the text."""
    from patchloom.operators.findings import contained_rules

    fields = [ordinal, *[c for c in rules.columns if c != ordinal]]
    hits = contained_rules(findings, text, rules, rule, ordinal).withColumn("_hit", F.try_element_at("_hits", F.lit(1)))
    return hits.where("_hit IS NOT NULL").select(*findings.columns, *[F.col(f"_hit.{f}").alias(f) for f in fields])


def group_buckets(df: DataFrame, group: list[str], name: str = "bucket") -> DataFrame:
    """(group, n, bucket): ``single`` or ``multi`` by the rows of a group."""
    sized = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return sized.withColumn(name, F.when(F.col("n") == 1, "single").otherwise("multi"))


def bucket_of_group(df: DataFrame, group: list[str], name: str = "bucket") -> DataFrame:
    """df with the bucket of its group."""
    return df.join(group_buckets(df, group, name).drop("n"), group)
