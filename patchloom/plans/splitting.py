"""Leakage-safe splits of model samples by commit."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.functions import keys as K
from patchloom.operators import joins, rules, splits, summaries

# fixed values: the labels of a split in order, and what a row must have
LABELS = ("SAFE", "CWE-22", "CWE-78", "CWE-79", "CWE-89", "CWE-287")
REQUIRED = ("model_sample_id", "repository", "commit_id", "file_path", "function_name", "code", "variant", "is_vulnerable", "cwes", "token_count", "tokenizer")
EXCLUDED = ("CWE-798",)


class Split(NamedTuple):
    """rows: samples with split; excluded: those of excluded weaknesses."""

    rows: DataFrame
    excluded: DataFrame


def prepared(samples: DataFrame, labels: tuple[str, ...] = LABELS, max_tokens: int = 512) -> DataFrame:
    """samples with target_label, label_id and split_group_id. A row that lacks a
    required value, isn't Python, is too long, contradicts itself or has an
    unknown label fails the job."""
    missing = rules.missing_fields(samples, REQUIRED)
    name = K.text(F.col("model_sample_id"))

    def fail(what: str) -> F.Column:
        return F.raise_error(F.concat(name, F.lit(f": {what}")))

    sane = (
        F.when(F.size(missing) > 0, F.raise_error(F.concat(name, F.lit(": missing "), F.array_join(missing, ", "))))
        .when(~F.col("file_path").endswith(".py"), fail("non-Python file path"))
        .when(~F.col("token_count").between(1, max_tokens), fail("invalid token_count"))
        .when(~(((F.col("variant") == "before") & F.col("is_vulnerable")) | (F.col("variant") == "after") | ~F.col("is_vulnerable")), fail("inconsistent variant"))
        .otherwise(F.lit(True))
    )
    label = K.target_label(F.col("variant"), F.col("is_vulnerable"), F.col("cwes"))
    ids = F.array_position(F.array(*[F.lit(x) for x in labels]), F.col("target_label")) - 1
    checked = samples.where(sane).withColumns({"target_label": label, "split_group_id": K.split_group(F.col("repository"), F.col("commit_id"))})
    return checked.withColumn("label_id", F.when(ids < 0, fail("unknown target label")).otherwise(ids).cast("int"))


def group_labels(rows: DataFrame) -> DataFrame:
    """(split_group_id, label): the one weakness of each commit; a commit with
    none or several fails the job."""
    weak = F.when(F.col("target_label") != "SAFE", F.col("target_label"))
    groups = rows.groupBy("split_group_id").agg(F.min(weak).alias("label"), F.max(weak).alias("_high"))
    one = F.when(F.coalesce(F.col("label") == F.col("_high"), F.lit(False)), F.col("label"))
    failed = F.raise_error(F.concat(F.lit("a commit needs one weakness: "), F.col("split_group_id")))
    return groups.select("split_group_id", F.coalesce(one, failed).alias("label"))


def split_samples(samples: DataFrame, excluded: tuple[str, ...] = EXCLUDED, validation: float = 0.15, test: float = 0.15, seed: int = 42, labels: tuple[str, ...] = LABELS, max_tokens: int = 512) -> Split:
    """Samples dealt to train, validation and test: all rows of a commit to one."""
    if validation <= 0 or test <= 0 or validation + test >= 1:
        raise ValueError("the ratios have to be positive and leave a part for training")
    out = F.arrays_overlap(F.coalesce("cwes", F.array().cast("array<string>")), F.array(*[F.lit(c) for c in excluded])) if excluded else F.lit(False)
    rows = prepared(samples.where(~out), labels, max_tokens)
    assigned = splits.allocate_groups(group_labels(rows), "label", "split_group_id", seed, validation, test).select("split_group_id", "split")
    return Split(rows.join(joins.small(assigned), "split_group_id"), samples.where(out))


def check_split(rows: DataFrame, labels: tuple[str, ...] = LABELS) -> None:
    """Raises if a split is empty or lacks a label, or a commit is in several."""
    found = splits.split_violations(rows, "split_group_id", "target_label", list(labels)).limit(20).collect()
    if found:
        raise ValueError("; ".join(f"{r.violation} {r.detail}" for r in found))


def split_table(rows: DataFrame) -> DataFrame:
    return summaries.split_summary(rows, "target_label", "split_group_id", "repository").withColumnRenamed("target_label", "label")


def label_map(labels: tuple[str, ...] = LABELS) -> dict[str, int]:
    return {label: i for i, label in enumerate(labels)}
