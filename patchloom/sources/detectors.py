"""Findings of three kinds of detectors, one row for each finding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.functions.keys import file_to_commit


def _file() -> F.Column:
    return F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)


def csv_findings(spark: SparkSession, path: str) -> DataFrame:
    """(commit, description): the first column of result tables."""
    rows = spark.read.csv(path, schema="description string, rest string", mode="PERMISSIVE")
    return rows.select(file_to_commit(_file()).alias("commit"), "description")


def block_findings(spark: SparkSession, path: str) -> DataFrame:
    """(commit, block): texts between rules of fifty dashes."""
    rows = spark.read.text(path, wholetext=True)
    blocks = rows.select(file_to_commit(_file()).alias("commit"), F.explode(F.split("value", "-{50}")).alias("block"))
    return blocks.where(F.trim("block") != "")


def json_findings(spark: SparkSession, path: str) -> DataFrame:
    """(commit, code): issue lines; the commit is the name of the folder."""
    rows = spark.read.json(path, schema="kind string, data struct<code:long>")
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return rows.select(file_to_commit(F.concat(folder, F.lit(".json"))).alias("commit"), "kind", "data.code").where("kind = 'issue'").drop("kind")
