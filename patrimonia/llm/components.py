"""Connected components of an edge table: union-find inside each partition, then alternating stars by joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrimonia.llm.store import drop, save


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a partition's edges with the smallest node it reaches there."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    pairs = [(x, find(x)) for x in list(parent)]
    pairs = [p for p in pairs if p[0] != p[1]]
    for i in range(0, len(pairs), 100_000):
        part = pairs[i : i + 100_000]
        yield pa.record_batch([pa.array([p[0] for p in part], pa.int64()), pa.array([p[1] for p in part], pa.int64())], ["u", "v"])


def _stars(edges: DataFrame) -> bool:
    """Whether every node of ``edges(u, v)`` has one smaller end v, or is one."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("end"))
    told = ends.select("end.*").groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return told.where("ups > 1 or (ups = 1 and least = 0)").isEmpty()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge: component is the smallest node that it reaches.

    Edges with a null end and loops count for nothing. Alternates the large-star and small-star steps until
    the edges are stars, which takes a number of rounds that grows with the logarithm of the nodes and none where
    the partitions' own forests are stars already.
    """
    pairs = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    now = save(pairs.mapInArrow(_local_forest, "u long, v long").distinct(), "edges")
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = save(near.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        drop(now)
        now = after
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
