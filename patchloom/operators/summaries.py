"""Summaries over fixed dimensions, totals and metric/value tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def over_dimension(dim: DataFrame, rows: DataFrame, key: str, aggregates: dict[str, Column]) -> DataFrame:
    """One row for each value of a fixed dimension, zeros kept. The rows are
    aggregated before they meet the dimension."""
    summed = rows.groupBy(key).agg(*[c.alias(n) for n, c in aggregates.items()])
    return dim.join(summed, key, "left").select(*dim.columns, *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in aggregates])


def with_total(rows: DataFrame, key: str, keys: Column, aggregates: dict[str, Column], total: str = "TOTAL") -> DataFrame:
    """Aggregates by each of a row's keys (an array), and a total of the rows as they
    are: a row with several keys counts once in it, which a rollup can't do. The
    rows are computed once; without any the total stands alone."""
    columns = [c.alias(n) for n, c in aggregates.items()]

    def side(whole: bool, value: Column) -> Column:
        return F.struct(F.lit(whole).alias("whole"), value.alias(key))

    each = F.transform(keys, lambda k: side(False, k))
    all_of = F.array(side(True, F.lit(total)))
    summed = rows.withColumn("_side", F.explode(F.concat(all_of, F.coalesce(each, F.slice(all_of, 1, 0))))).groupBy("_side").agg(*columns)
    none = rows.limit(0).agg(*columns).select(side(True, F.lit(total)).alias("_side"), *aggregates)
    both = summed.withColumn("_none", F.lit(False)).unionByName(none.withColumn("_none", F.lit(True)))
    first = both.groupBy("_side").agg(F.min_by(F.struct(*aggregates), "_none").alias("_of"))
    return first.select(f"_side.{key}", "_of.*")


def metric_table(summary: DataFrame, metrics: list[str]) -> DataFrame:
    """A one-row summary as (metric, value) rows."""
    return summary.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("long").alias("value")) for m in metrics])).alias("x")).select("x.*")


def split_summary(rows: DataFrame, label: str, group: str, repository: str) -> DataFrame:
    return rows.groupBy("split", label).agg(F.count(F.lit(1)).alias("samples"), F.count_distinct(group).alias("commit_groups"), F.count_distinct(repository).alias("repositories"))


def discovery_summary(candidates: DataFrame) -> DataFrame:
    """(metric, value): advisories, distinct fix commits, candidates by status."""
    def one(name: str, rows: DataFrame, value: Column) -> DataFrame:
        return rows.agg(value.cast("long").alias("value")).select(F.lit(name).alias("metric"), "value")

    links = candidates.select(F.explode("fix_commits.commit_url").alias("link"))
    by_status = candidates.groupBy(F.col("candidate_status").alias("metric")).agg(F.count(F.lit(1)).alias("value"))
    return one("advisories_found", candidates, F.count(F.lit(1))).unionByName(one("unique_fix_commits", links, F.count_distinct("link"))).unionByName(by_status)


def longest(rows: DataFrame, text: str) -> DataFrame:
    return rows.agg(F.coalesce(F.max(F.length(text)), F.lit(0)).cast("long").alias("max_length"))


def chunk_maxima(chunks: DataFrame, parent: str = "parent_sample_id") -> DataFrame:
    """Chunks, training chunks and the longest chunk of each record."""
    return chunks.groupBy(parent).agg(F.count(F.lit(1)).alias("chunks_created"), F.count_if("eligible_for_training").alias("training_chunks"), F.max("chunk_token_count").alias("max_chunk_token_count"))
