"""Group-disjoint splits, caps and nested splits by seeded hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.operators.numbering import by_hash, rank_within


def seeded(seed: int, *columns: Column) -> Column:
    """A reproducible order: the hash of the seed and the row's key."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[c.cast("string") for c in columns]), 256)


def _ranked(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """df with _rank, by seeded hash within the label, and _n, its rows."""
    drawn = df.withColumn("_drawn", seeded(seed, F.col(key)))
    sizes = df.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))  # a row for each label
    ranked = rank_within(drawn, [label], [F.col("_drawn"), F.col(key)], by_hash(F.col("_drawn")), "_rank").drop("_drawn")
    return ranked.join(sizes, F.col(label).eqNullSafe(F.col("_label"))).drop("_label")


def split_counts(n: Column, validation: float, test: float) -> tuple[Column, Column]:
    """(test, validation) groups of n, half-even, one at least, shrunk until a
    training group is left. With three groups or more the two shrink in turn,
    test first, which leaves a closed form."""
    t = F.greatest(F.lit(1), F.bround(n * test, 0).cast("int"))
    v = F.greatest(F.lit(1), F.bround(n * validation, 0).cast("int"))
    steps = F.sequence(F.lit(0), F.greatest(F.lit(0), t + v - n + 1))

    def shrink(s: Column, i: Column) -> Column:
        over = s["t"] + s["v"] >= n
        cut_t = over & (s["t"] >= s["v"]) & (s["t"] > 1)
        cut_v = over & ~cut_t & (s["v"] > 1)
        return F.struct((s["t"] - F.when(cut_t, 1).otherwise(0)).alias("t"), (s["v"] - F.when(cut_v, 1).otherwise(0)).alias("v"))

    done = F.aggregate(steps, F.struct(t.alias("t"), v.alias("v")), shrink)
    return done["t"], done["v"]


def allocate_groups(groups: DataFrame, label: str, group: str, seed: int = 42, validation: float = 0.15, test: float = 0.15) -> DataFrame:
    """(group, label, split): groups ranked by seeded hash within their label;
    the first are test, the next validation. Fewer than three groups raise."""
    ranked = _ranked(groups.select(label, group).distinct(), label, group, seed)
    t, v = split_counts(F.col("_n").cast("int"), validation, test)
    sized = ranked.withColumns({"_t": t, "_v": v})
    split = F.when(F.col("_n") < 3, F.raise_error(F.lit("a label needs three groups at least"))).when(F.col("_rank") <= F.col("_t"), "test").when(F.col("_rank") <= F.col("_t") + F.col("_v"), "validation").otherwise("train")
    return sized.select(group, label, split.alias("split"))


def split_violations(rows: DataFrame, group: str, label: str, labels: list[str]) -> DataFrame:
    """Groups in several splits, and (split, label) pairs that are missing."""
    spark = rows.sparkSession
    torn = rows.groupBy(group).agg(F.count_distinct("split").alias("n")).where("n > 1").select(F.lit("group_in_several_splits").alias("violation"), F.col(group).cast("string").alias("detail"))
    expected = spark.createDataFrame([(s, x) for s in ("train", "validation", "test") for x in labels], f"split string, {label} string")
    missing = expected.join(rows.select("split", label).distinct(), ["split", label], "left_anti")
    return torn.unionByName(missing.select(F.lit("label_missing").alias("violation"), F.concat_ws("/", "split", label).alias("detail")))


def stratified_cap(df: DataFrame, label: str, key: str, limit: int, seed: int = 42) -> DataFrame:
    """At most limit rows, dealt one for each label in turn; all if limit <= 0."""
    if limit <= 0:
        return df
    ranked = _ranked(df, label, key, seed).where(F.col("_rank") <= limit)
    return ranked.orderBy("_rank", label).limit(limit).select(*df.columns)


def nested_ratio(df: DataFrame, label: str, key: str, outer: float = 0.8, inner: float = 0.8, seed: int = 42) -> DataFrame:
    """df with split: outer share to train and validation, of which the inner
    share trains, within each label."""
    ranked = _ranked(df, label, key, seed)
    kept = F.floor(F.col("_n") * outer)
    trained = F.floor(kept * inner)
    return ranked.withColumn("split", F.when(F.col("_rank") <= trained, "train").when(F.col("_rank") <= kept, "validation").otherwise("test")).drop("_rank", "_n")


def nested_fixed(df: DataFrame, label: str, key: str, outer: int = 150, inner: int = 120, seed: int = 42) -> DataFrame:
    """The same with fixed sizes; what is over stays for test."""
    return _ranked(df, label, key, seed).withColumn("split", F.when(F.col("_rank") <= inner, "train").when(F.col("_rank") <= outer, "validation").otherwise("test")).drop("_rank", "_n")
