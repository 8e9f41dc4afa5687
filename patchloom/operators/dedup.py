"""Exact, keyed and linked duplicates, and label conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def conflicts_and_duplicates(df: DataFrame, key: Column, signature: Column, order: list[Column]) -> DataFrame:
    """df with verdict: ``conflict`` for all rows of a key with several
    signatures, else ``kept`` for the first in order and ``duplicate``.

    The order has to be unique in a key. Keys are aggregated before the rows meet
    them, so a key that many rows share is one row of a join that can be split.
    """
    marked = df.withColumns({"_key": key, "_sig": signature, "_order": F.struct(*order)})
    groups = marked.groupBy("_key").agg(F.min("_sig").alias("_low"), F.max("_sig").alias("_high"), F.min("_order").alias("_first"))
    held = groups.withColumnRenamed("_key", "_group")
    joined = marked.join(held, F.col("_key").eqNullSafe(F.col("_group")))
    verdict = F.when(F.col("_low") != F.col("_high"), "conflict").when(F.col("_order") == F.col("_first"), "kept").otherwise("duplicate")
    return joined.withColumn("verdict", verdict).drop("_key", "_sig", "_order", "_group", "_low", "_high", "_first")


def first_wins(df: DataFrame, keys: list[Column], order: list[Column], flag: str = "is_first") -> DataFrame:
    """df with a flag: the first row of its key, by a unique order. A null in a
    key stands alone."""
    marked = df.withColumns({"_key": F.struct(*keys), "_order": F.struct(*order)})
    alone = F.coalesce(*[F.when(k.isNull(), F.lit(True)) for k in keys], F.lit(False))
    held = marked.where(~alone).groupBy("_key").agg(F.min("_order").alias("_first")).withColumnRenamed("_key", "_group")
    joined = marked.withColumn("_alone", alone).join(held, (F.col("_key") == F.col("_group")) & ~F.col("_alone"), "left")
    return joined.withColumn(flag, F.col("_alone") | F.coalesce(F.col("_order") == F.col("_first"), F.lit(False))).drop("_key", "_order", "_group", "_first", "_alone")


def last_wins(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The last row of each key, by map-side combining aggregation."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_row")).select(key, "_row.*")


def _checkpoints(spark: SparkSession) -> None:
    """Sets the checkpoint folder: the one that the cluster names, or one in the
    warehouse where the master is local; a cluster has to name its own."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints")


def components(links: DataFrame, row: str, key: str) -> DataFrame:
    """(row, component): the least row that is reached through shared keys.

    Every key is a star of edges to its least row, so no pairs are made, and rows
    that share no key stay out of the rounds. Edges are then contracted: the
    larger neighbours of a vertex move to the least around it, and in turn a
    vertex and its smaller neighbours do, until only stars are left. Null keys
    link nothing. Rounds are checkpointed in the shared folder.
    """
    _checkpoints(links.sparkSession)
    pairs = links.where(F.col(key).isNotNull()).select(F.col(row).alias("row"), F.col(key).alias("key"))
    least = pairs.groupBy("key").agg(F.min("row").alias("low"), F.max("row").alias("high")).where("low < high")
    edges = pairs.join(least, "key").where("row > low").select(F.col("row").alias("u"), F.col("low").alias("v")).distinct().checkpoint()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    def contracted(e: DataFrame) -> DataFrame:
        """u > v in every edge, before and after."""
        around = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = e.select(F.col("v").alias("hub"), F.col("u").alias("far")).join(lowest.withColumnRenamed("u", "hub"), "hub").select(F.col("far").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        return large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct().checkpoint()

    now, seen = edges, mark(edges)
    while seen[0]:
        now = contracted(now)
        after = mark(now)
        if after == seen:
            break
        seen = after
    found = now.select(F.col("u").alias(row), F.col("v").alias("_component"))
    return links.select(row).distinct().join(found, row, "left").select(row, F.coalesce("_component", F.col(row)).alias("component"))


def resolve_components(df: DataFrame, row: str, keys: list[str], signature: Column, provenance: list[str]) -> DataFrame:
    """df with component, is_primary, component_conflict and, on the primary,
    duplicate_sources: the provenance of the other rows."""
    links = df.select(row, F.explode(F.array(*[F.concat(F.lit(f"{k}:"), F.col(k)) for k in keys])).alias("_key"))
    named = df.join(components(links, row, "_key"), row)
    groups = named.groupBy("component").agg(F.min(signature).alias("_low"), F.max(signature).alias("_high"), F.collect_list(F.when(F.col(row) != F.col("component"), F.struct(*provenance))).alias("_others"))
    out = named.join(groups, "component").withColumns({"is_primary": F.col(row) == F.col("component"), "component_conflict": F.col("_low") != F.col("_high")})
    others = F.when(F.col("is_primary"), F.array_sort("_others"))
    return out.withColumn("duplicate_sources", others).drop("_low", "_high", "_others")
