"""Advisory payloads as candidates for extraction. Fetching is left to a cache
table that other jobs fill; pages arrive as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patchloom.operators.dedup import last_wins

COMMIT = r"(?i)^https://github\.com/([^/]+)/([^/]+)/commit/([0-9a-f]{7,64})(?:[/?#].*)?$"


def next_link(header: Column) -> Column:
    """The first link with rel="next" of a Link header, or null."""
    return F.nullif(F.regexp_extract(F.coalesce(header, F.lit("")), r'<([^<>]+)>;\s*rel="next"', 1), F.lit(""))


def latest(payloads: DataFrame, order: str) -> DataFrame:
    return last_wins(payloads, "ghsa_id", F.col(order))


def candidates(advisories: DataFrame, target: str) -> DataFrame:
    """advisories (ghsa_id, cwes, references) with fix_commits and status."""
    named = F.array_distinct(F.transform("cwes", lambda x: x["cwe_id"]))
    fixes = F.array_distinct(F.transform(F.filter("references", lambda r: r.rlike(COMMIT)), lambda r: F.struct(
        F.concat_ws("/", F.regexp_extract(r, COMMIT, 1), F.regexp_replace(F.regexp_extract(r, COMMIT, 2), r"\.git$", "")).alias("repository"),
        F.lower(F.regexp_extract(r, COMMIT, 3)).alias("commit_id"), r.alias("commit_url"))))
    out = advisories.withColumns({"cwes": named, "fix_commits": fixes, "target_cwe": F.lit(target)})
    status = F.when(~F.array_contains("cwes", target), "REJECTED_CWE_MISMATCH").when(F.size("fix_commits") == 0, "NEEDS_FIX_COMMIT").otherwise("READY_FOR_EXTRACTION")
    return out.withColumn("candidate_status", status)


def inverted(advisories: DataFrame) -> DataFrame:
    """(cwe, advisories): the distinct advisories of each weakness."""
    return advisories.select("ghsa_id", F.explode("cwes.cwe_id").alias("cwe")).groupBy("cwe").agg(F.array_sort(F.collect_set("ghsa_id")).alias("advisories"))
