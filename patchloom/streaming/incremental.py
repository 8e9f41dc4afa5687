"""Rules and first-wins duplicates over a stream of records.

Rules read one row at a time, so they hold on a stream as they are. A first row
of a key is known only within a watermark; conflicts and linked duplicates need
all rows and stay with the batch plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from patchloom.operators import rules


def classify(stream: DataFrame, ruled: list[rules.Rule]) -> DataFrame:
    return rules.apply_rules(stream, ruled)


def first_seen(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """The first row of each key that arrives within the delay."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def write_by_status(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All rows that are there now, exactly once, in a folder for each status."""
    return stream.writeStream.format("parquet").partitionBy("status").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
