"""Payloads that a network gives: paged listings and cached requests.

How a request is made is the caller's function; the library keeps what came and
asks only for what a cache lacks.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patchloom.operators.dedup import last_wins

#: What a page gives: its payload as text, and the link of the next or None.
Page = tuple[str, str | None]


def pages(first: str, fetch: Callable[[str], Page], most: int = 10_000) -> Iterator[tuple[int, str]]:
    """(number, payload) of linked pages; a link that comes again ends the walk."""
    seen: set[str] = set()
    link: str | None = first
    while link and link not in seen and len(seen) < most:
        seen.add(link)
        payload, link = fetch(link)
        yield len(seen), payload


def listing(spark: SparkSession, first: str, fetch: Callable[[str], Page], schema: str, key: str) -> DataFrame:
    """Records of all pages, JSON arrays of objects; of equal keys the last holds.
    A listing is walked on the driver, page by page, as each names the next."""
    rows = [(n, at, json.dumps(item)) for n, payload in pages(first, fetch) for at, item in enumerate(json.loads(payload))]
    table = spark.createDataFrame(rows, "page int, at int, value string")
    records = table.select(F.from_json("value", schema).alias("r"), F.struct("page", "at").alias("place")).select("r.*", "place")
    return last_wins(records, key, F.col("place")).drop("place")


def missing(requests: DataFrame, cache: DataFrame, on: list[str]) -> DataFrame:
    """Requests that the cache lacks, each once."""
    return requests.select(*on).distinct().join(cache.select(*on), on, "left_anti")


def fetched(requests: DataFrame, fetch: Callable[[dict], str], tries: int = 3, pause: Callable[[int], None] | None = None) -> DataFrame:
    """requests with payload or error, asked in tasks and tried again after a
    pause; write the result to the cache before it is used."""
    names = requests.columns

    def ask(row: dict) -> tuple[str | None, str | None]:
        error = None
        for attempt in range(tries):
            try:
                return fetch(row), None
            except Exception as failure:  # noqa: BLE001  the error is the row's result
                error = f"{type(failure).__name__}: {failure}"
                if pause and attempt + 1 < tries:
                    pause(min(2**attempt, 8))
        return None, error

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            got = [ask(r) for r in frame.to_dict("records")]
            yield frame.assign(payload=[p for p, _ in got], error=[e for _, e in got])[[*names, "payload", "error"]]

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in requests.schema)
    return requests.mapInPandas(run, f"{fields}, payload string, error string")


def through_cache(requests: DataFrame, cache: DataFrame, on: list[str], fetch: Callable[[dict], str]) -> DataFrame:
    """(on, payload, error) of all requests: the cache's, and what it lacks."""
    held = requests.select(*on).distinct().join(cache.select(*on, "payload"), on).withColumn("error", F.lit(None).cast("string"))
    return held.unionByName(fetched(missing(requests, cache, on), fetch))


def diff_payloads(cache: DataFrame) -> DataFrame:
    """Rows of a cache whose payload is a diff."""
    return cache.where(F.col("payload").startswith("diff --git "))


def report_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Reports that a scraper left as one JSON array or as JSON lines."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def seed_groups(spark: SparkSession, path: str, key: int = 0, value: int = 2) -> DataFrame:
    """(key, id, place) of a seed list with a header: groups in falling size
    without the largest, the ids of each."""
    from patchloom.operators.findings import report_groups

    raw = spark.read.option("header", True).csv(path)
    rows = raw.select(F.col(raw.columns[key]).alias("key"), F.col(raw.columns[value]).alias("id"))
    return rows.join(F.broadcast(report_groups(rows, "key", skip=1).select("key", "place")), "key")
