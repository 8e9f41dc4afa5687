"""Labelled samples from pairs and from chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.functions import keys as K


def pair_to_samples(pairs: DataFrame, carried: list[str]) -> DataFrame:
    """Two rows for each pair: before (vulnerable) and after (safe). A side with
    blank code or without a token count is skipped."""
    side = [F.struct(F.lit(v).alias("variant"), F.lit(v == "before").alias("is_vulnerable"), F.col(f"code_{v}").alias("code"), F.col(f"token_count_{v}").alias("token_count")) for v in ("before", "after")]
    sides = pairs.select(*carried, F.explode(F.array(*side)).alias("s")).select(*carried, "s.*")
    kept = sides.where((F.trim(F.coalesce("code", F.lit(""))) != "") & F.col("token_count").isNotNull())
    return kept.withColumn("model_sample_id", F.concat_ws(":", F.col(carried[0]).cast("string"), "variant")).withColumn("code_sha256", K.content_hash(F.col("code")))


def chunk_to_samples(chunks: DataFrame) -> DataFrame:
    """Chunks that are ready and eligible, as samples of their parent's group;
    a chunk without a pair groups by its own sample id."""
    ready = chunks.where((F.col("status") == "MODEL_READY") & F.col("eligible_for_training"))
    group = F.coalesce("pair_id", "parent_sample_id")
    return ready.select(F.col("chunk_id").alias("model_sample_id"), "parent_sample_id", group.alias("group_id"), "variant", (F.col("variant") == "before").alias("is_vulnerable"), "code", "token_count", F.lit("chunk").alias("source_type"))


def union_in_order(frames: list[DataFrame], ordinal: str = "source_ord") -> DataFrame:
    """Bag union of differently shaped frames, numbered in listed order."""
    out = frames[0].withColumn(ordinal, F.lit(0))
    for i, frame in enumerate(frames[1:], 1):
        out = out.unionByName(frame.withColumn(ordinal, F.lit(i)), allowMissingColumns=True)
    return out
