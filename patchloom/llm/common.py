"""Helpers shared by the training-data operators."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Spark removes the shuffles of a query at its end.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Characters of the class [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; only Spark's reader touches the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once, bound as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def fold_of(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id's decimal text modulo folds; a null id has fold -1."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds, F.lit(-1))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a folder in
    the warehouse where the setting is empty and the master is local, as in
    tests. A cluster has to name its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        root = posixpath.join(spark.conf.get("spark.sql.warehouse.dir"), "_shared")
    return root


def materialise(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """df written once as Parquet in the shared folder and read again.

    It cuts the lineage, survives lost executors and is read by any of them. The
    shuffles behind it are of no more use and are removed once it is written, not
    when the driver's memory is next cleaned.
    """
    spark = df.sparkSession
    path = posixpath.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")
    before = spark.conf.get(CLEAN_UP, "false")
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def bytes_column(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def tasks(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow; fn sees only the columns that df has at this point."""
    return df.mapInArrow(fn, schema)


def ids_only(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns of df and nothing else, so that extra or clashing
    columns of the input never reach an operator."""
    return df.select(*[F.col(c) for c in columns])


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
