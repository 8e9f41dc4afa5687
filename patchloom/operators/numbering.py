"""Ranks and sequence numbers without one task for each key.

A window over a key with few values would put all rows in a handful of tasks.
Rows are ranked within buckets of their key instead, buckets are counted, and
each rank gets the rows of the buckets before its own as an offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Numbers in a bucket of an integer order.
WIDTH = 1_000_000


def by_number(order: str) -> Column:
    """Bucket of an integer order: at most WIDTH different numbers each."""
    return F.floor(F.col(order) / WIDTH).cast("long")


def by_hash(order: Column) -> Column:
    """Bucket of an order by SHA-256 in hexadecimal: 4,096 even ones."""
    return F.conv(F.substring(order, 1, 3), 16, 10).cast("long")


def rank_within(df: DataFrame, keys: list[str], order: list[Column], bucket: Column, name: str) -> DataFrame:
    """df with the row's rank from 1 within its key, by order. Buckets have to
    rise with the first of order; with equal orders a rank is picked at will."""
    marked = df.withColumn("_rank_bucket", bucket)
    counts = marked.groupBy(*keys, "_rank_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # one row for each bucket: small beside the rows
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(*keys).orderBy("_rank_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = F.row_number().over(Window.partitionBy(*keys, "_rank_bucket").orderBy(*order))
    left, right = marked.withColumn("_own", own).alias("l"), before.select(*keys, "_rank_bucket", "_before").alias("r")
    same = F.lit(True)
    for k in [*keys, "_rank_bucket"]:
        same = same & F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    return left.join(right, same).select(*[F.col(f"l.{c}") for c in df.columns], (F.col("l._own") + F.col("r._before")).cast("long").alias(name))


def sequence(df: DataFrame, order: str, name: str) -> DataFrame:
    """df numbered from 1 over all rows by a unique integer order."""
    return rank_within(df.withColumn("_all", F.lit(0)), ["_all"], [F.col(order)], by_number(order), name).drop("_all")
