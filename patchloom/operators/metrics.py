"""Scores of detectors against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def binary(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and F1; null predictions
    are invalid and don't count. Empty denominators give 0."""
    t, p = F.col(truth), F.col(predicted)
    counts = df.agg(*[F.count_if(c).alias(n) for n, c in (("tp", t & p), ("fp", ~t & p), ("tn", ~t & ~p), ("fn", t & ~p), ("invalid", p.isNull()))])
    c = F.col
    return counts.withColumns({
        "accuracy": _ratio(c("tp") + c("tn"), c("tp") + c("fp") + c("tn") + c("fn")), "precision": _ratio(c("tp"), c("tp") + c("fp")),
        "recall": _ratio(c("tp"), c("tp") + c("fn")), "f1": _ratio(2 * c("tp"), 2 * c("tp") + c("fp") + c("fn")),
    })


def multiclass(df: DataFrame, truth: str, predicted: str, labels: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support) over all labels of a dimension.

    Truths and predictions are counted by pair first, so the rest is small.
    """
    pairs = df.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    each = pairs.select(F.explode(F.array(F.struct(F.col("t").alias("label"), F.lit("t").alias("side")), F.struct(F.col("p").alias("label"), F.lit("p").alias("side")))).alias("x"), "n", (F.col("t") == F.col("p")).alias("hit"))
    sums = each.groupBy("x.label").agg(F.sum(F.when((F.col("x.side") == "t") & F.col("hit"), F.col("n"))).alias("tp"), F.sum(F.when(F.col("x.side") == "t", F.col("n"))).alias("support"), F.sum(F.when(F.col("x.side") == "p", F.col("n"))).alias("found"))
    zero = F.lit(0)
    tp, support, found = (F.coalesce(x, zero) for x in ("tp", "support", "found"))
    return labels.join(sums, "label", "left").select("label", _ratio(tp, found).alias("precision"), _ratio(tp, support).alias("recall"), _ratio(2 * tp, found + support).alias("f1"), support.cast("long").alias("support"))


def class_weights(df: DataFrame, label: str, labels: DataFrame) -> DataFrame:
    """n / (k * max(count, 1)) for every label of a dimension of k labels."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    totals = df.agg(F.count(F.lit(1)).alias("total")).crossJoin(labels.agg(F.count(F.lit(1)).alias("k")))
    weight = F.col("total") / (F.col("k") * F.greatest(F.coalesce("n", F.lit(0)), F.lit(1)))
    return labels.join(counts, "label", "left").crossJoin(F.broadcast(totals)).select("label", weight.cast("double").alias("weight"))


def classification(df: DataFrame, truth: str, predicted: str, labels: DataFrame) -> DataFrame:
    """One row: accuracy, macro-F1 over all labels of the dimension, samples."""
    each = multiclass(df, truth, predicted, labels)
    macro = each.agg(F.coalesce(F.avg("f1"), F.lit(0.0)).alias("macro_f1"))
    total = df.agg(_ratio(F.count_if(F.col(truth) == F.col(predicted)), F.count(F.lit(1))).alias("accuracy"), F.count(F.lit(1)).alias("samples"))
    return total.crossJoin(F.broadcast(macro))  # one row each


def predictions(df: DataFrame, key: str, truth: str, predicted: str, names: list[str]) -> DataFrame:
    """Rows of an evaluation as they are exported: ids, names and whether right."""
    table = F.array(*[F.lit(n) for n in names])
    return df.select(key, F.get(table, F.col(truth)).alias("truth"), F.get(table, F.col(predicted)).alias("prediction"), (F.col(truth) == F.col(predicted)).alias("correct"))
