"""Connected components of an edge table.

Edges are dealt to tasks of a bounded number, and each task contracts its own to
stars. If one task held them all, that is the result; else alternating star
contraction joins what the tasks found. Vertices, edges and labels stay in
DataFrames; every round is written to the shared folder, so a lost executor
costs one round at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patchloom.llm.common import materialise


#: Edges that one task contracts: 16 bytes each, some hundred MB as a dict.
TASK_EDGES = 500_000


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b): each vertex of a task's edges and the least it is joined with."""
    up: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while up[root] != root:
            root = up[root]
        while up[x] != root:
            up[x], x = root, up[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            up.setdefault(a, a)
            up.setdefault(b, b)
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    nodes = np.fromiter(up, np.int64, len(up))
    roots = np.fromiter(map(find, up), np.int64, len(up))
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["a", "b"])


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hangs each larger neighbour of a vertex on the least vertex around it."""
    near = _both(edges)
    least = near.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    hung = near.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return hung.where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hangs a vertex and its smaller neighbours on the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    kept = least.select("a", F.col("least").alias("b"))
    return moved.unionByName(kept).where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal edge tables: their number and the sum of their hashes."""
    hashed = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(hashed)).first())


def components(edges: DataFrame, native: bool = False) -> DataFrame:
    """(node, root) for every vertex of edges (a, b: long): the least vertex of
    its component. Loops and repeated edges are allowed; an empty table gives
    an empty result. Vertices without edges have no row. native: rounds of SQL
    functions only, without the tasks' own contraction.
    """
    given = materialise(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")), "edges")
    tasks = 0 if native else max(1, -(-given.count() // TASK_EDGES))
    stars = given.distinct() if native else materialise((given.coalesce(1) if tasks == 1 else given.repartition(tasks)).mapInArrow(_contract, "a long, b long"), "stars")
    if tasks == 1:
        return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    alone, now = stars.where("a = b").select("a"), stars.where("a <> b")
    mark = _mark(now)
    while mark[0]:
        after = materialise(_small_star(_large_star(now)), "edges")
        now, before = after, mark
        mark = _mark(now)
        if mark == before:
            break
    joined = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = joined.select(F.col("root").alias("node"), "root").distinct()
    lone = alone.select(F.col("a").alias("node"), F.col("a").alias("root"))
    return joined.unionByName(roots).unionByName(lone).groupBy("node").agg(F.min("root").alias("root"))
