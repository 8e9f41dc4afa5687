"""Committed outputs: JSON lines, tables by status or split, small reports.

Tables and lines are written by Spark, whose commit protocol makes a whole output
appear at once. Reports are small by nature (a row for each weakness, label or
metric); they are written as one file through the file system of their path.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a report at most.
REPORT_ROWS = 100_000


def json_lines(df: DataFrame) -> DataFrame:
    """(value): one JSON object for each row, nulls kept as fields."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_jsonl(df: DataFrame, path: str, single_file: bool = False) -> None:
    """single_file is for exports that one task can write."""
    lines = json_lines(df)
    (lines.coalesce(1) if single_file else lines).write.mode("overwrite").text(path)


def write_by(df: DataFrame, column: str, path: str) -> None:
    """A folder for each value: accepted, manual and rejected, or splits."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def write_lines_by(df: DataFrame, column: str, path: str) -> None:
    """The same as JSON lines."""
    rest = F.struct(*[c for c in df.columns if c != column])
    df.select(column, F.to_json(rest, {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").partitionBy(column).text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A table of any size, as part files with a header each."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_lines(df: DataFrame, path: str) -> None:
    """A frame of one text column, such as batch requests."""
    df.write.mode("overwrite").text(path)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, written beside its place and then moved there. Hadoop's
    file system is reached through the session, so any store does."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.part")
    out = system.create(beside, True)
    try:
        out.write(bytearray(text.encode()))
    except BaseException:
        out.close()
        system.delete(beside, False)
        raise
    out.close()
    system.delete(target, False)
    if not system.rename(beside, target):
        raise OSError(f"could not move {beside} to {path}")


def write_json(spark: SparkSession, value: object, path: str) -> None:
    """One indented JSON object."""
    put_text(spark, path, json.dumps(value, ensure_ascii=False, indent=2) + "\n")


def write_report(report: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """A small table as one CSV file with a byte order mark, in the order of its
    columns; other columns are left out."""
    import csv
    import io

    shown = report.select(*(columns or report.columns))
    rows = shown.limit(REPORT_ROWS + 1).collect()
    if len(rows) > REPORT_ROWS:
        raise ValueError(f"a report of more than {REPORT_ROWS} rows; use write_csv")
    text = io.StringIO()
    writer = csv.writer(text, lineterminator="\n")
    writer.writerow(shown.columns)
    writer.writerows(sorted((tuple("" if v is None else v for v in r) for r in rows), key=str))
    put_text(report.sparkSession, path, "﻿" + text.getvalue())


def write_filtered(records: DataFrame, summary: DataFrame, folder: str) -> None:
    """Records by status, and the summary beside them once they are complete."""
    write_lines_by(records, "status", f"{folder}/records")
    write_report(summary, f"{folder}/filter_summary.csv")


def write_split(rows: DataFrame, labels: dict[str, int], summary: DataFrame, folder: str) -> None:
    """Samples by split, the label map and the summary."""
    write_lines_by(rows, "split", f"{folder}/samples")
    write_json(rows.sparkSession, labels, f"{folder}/label_map.json")
    write_report(summary, f"{folder}/split_summary.csv")
