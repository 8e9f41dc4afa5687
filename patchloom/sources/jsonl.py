"""JSON lines with physical line numbers, strict or tolerant.

Spark's own JSON reader turns an array line into rows and accepts text behind a
value; lines are therefore read as text and parsed strictly in Arrow batches.
"""


import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patchloom.functions.udf import arrow_udf


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, source_line, value): lines of files, numbered from 1 with blank
    ones counted. Files are split as Spark splits them: each block's lines are
    counted, and a line's number is its place in its block behind the blocks
    before."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"), "value")
    blocks = raw.groupBy("file", "block").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).select("file", "block", "first", "offset")
    line = (F.col("place") - F.col("first") + F.col("offset") + 1).cast("int").alias("source_line")
    placed = raw.join(F.broadcast(offsets), ["file", "block"]).select("file", line, "value")  # a row for each block of a file
    bare = F.when(F.col("source_line") == 1, F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value"))
    return placed.withColumn("value", bare).where(F.trim("value") != "")


@arrow_udf("object string, error string")
def _checked(lines: pd.Series) -> pd.DataFrame:
    out = []
    for line in lines:
        try:
            value = json.loads(line)
            out.append((line, None) if isinstance(value, dict) else (None, "not an object"))
        except ValueError as error:
            out.append((None, type(error).__name__))
    return pd.DataFrame(out, columns=["object", "error"])


def read_tolerant(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(file, source_line, record, error): a bad line is an error row."""
    parsed = numbered_lines(spark, path).withColumn("c", _checked("value"))
    return parsed.select("file", "source_line", F.from_json("c.object", schema).alias("record"), F.col("c.error").alias("error"))


def read_strict(spark: SparkSession, path: str, schema: str, missing_is_empty: bool = False, non_empty: bool = False) -> DataFrame:
    """Records with file and source_line; a bad line fails the job."""
    try:
        rows = read_tolerant(spark, path, schema)
    except Exception as error:
        if missing_is_empty and "PATH_NOT_FOUND" in str(error):
            return spark.createDataFrame([], f"file string, source_line int, {schema}")
        raise
    message = F.concat(F.lit("bad record in "), F.col("file"), F.lit(":"), F.col("source_line").cast("string"), F.lit(" "), F.col("error"))
    checked = rows.withColumn("record", F.when(F.col("error").isNotNull(), F.raise_error(message)).otherwise(F.col("record")))
    out = checked.select("file", "source_line", "record.*")
    if non_empty and out.isEmpty():
        raise ValueError(f"{path} holds no records")
    return out


def read_map(spark: SparkSession, path: str) -> DataFrame:
    """(key, value) of one JSON object; a list value gives a row for each item."""
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m")).select(F.explode("m").alias("key", "value"))
    items = F.when(F.col("value").startswith("["), F.from_json("value", "array<string>")).otherwise(F.array("value"))
    return text.select("key", F.explode(items).alias("value"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): trimmed lines that aren't blank."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value <> ''")


def read_enrichment(spark: SparkSession, path: str, schema: str, key: str = "file_change_id") -> DataFrame:
    """The last record of each key of a strict scan; a missing key fails."""
    from patchloom.operators.dedup import last_wins

    rows = read_strict(spark, path, schema)
    keyed = rows.withColumn(key, F.when(F.col(key).isNull(), F.raise_error(F.lit(f"a record has no {key}"))).otherwise(F.col(key).cast("string")))
    return last_wins(keyed, key, F.struct("file", "source_line")).drop("file", "source_line")
