"""Exact top-k inner products by MaxScore over blocks of queries and shards of vectors.

Each dimension is a term. Within a shard, term j adds between low_j and high_j to a query's score, so its
range is its bound. Terms of small ranges whose sum can't lift a vector over the k-th best score are
non-essential: essential terms are added up for all vectors of the shard, and the others are probed, largest
range first, only for vectors that stay competitive. The shards' best are merged for each query.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a shard and queries of a block: what one task holds, whatever the table's size.
SHARD_ROWS, BLOCK_QUERIES = 16_384, 4_096


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as a matrix; missing components of shorter vectors are 0."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = rows.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = rows.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def search(vectors: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) that may be among the k best of the shard, ties included; ``vectors`` has one row for each dimension."""
    n = vectors.shape[1]
    low, high = vectors.min(axis=1) * query, vectors.max(axis=1) * query
    low, high = np.minimum(low, high), np.maximum(low, high)
    terms = np.argsort(low - high, kind="stable")  # widest range first
    left = np.concatenate([np.cumsum(high[terms][::-1])[::-1], [0]])  # the most that terms from here on add
    least = np.concatenate([[0], np.cumsum(low[terms])])  # the least that terms before here add
    other = ids != own
    probe = np.flatnonzero(other)[: 8 * k]
    if len(probe) < k:
        rows = np.flatnonzero(other)
        return rows, query @ vectors[:, rows]
    floor = np.partition(query @ vectors[:, probe], -k)[-k]
    # non-essential: terms that can't lift a vector with the least of all others to the floor
    essential = int(np.argmax(np.append(least + left < floor, True)))
    essential = min(essential, len(terms))
    part = query[terms[:essential]] @ vectors[terms[:essential]]
    lead = np.flatnonzero(other)
    top = lead[np.argpartition(part[lead], -k)[-k:]]
    floor = max(floor, np.partition(query @ vectors[:, top], -k)[-k])
    rows = lead[part[lead] + left[essential] >= floor]
    score = part[rows]
    for at in range(essential, len(terms), 8):
        chosen = terms[at : at + 8]
        score = score + query[chosen] @ vectors[np.ix_(chosen, rows)]
        stay = score + left[min(at + 8, len(terms))] >= floor
        rows, score = rows[stay], score[stay]
    return rows, score


def _cell(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if vectors.num_rows and queries.num_rows:
            width = max(int(np.max(t.column("v").combine_chunks().value_lengths().to_numpy(zero_copy_only=False), initial=0)) for t in (vectors, queries))
            v, q = np.ascontiguousarray(_matrix(vectors.column("v"), width).T), _matrix(queries.column("v"), width)
            ids, own = vectors.column("vec_id").to_numpy(), queries.column("vec_id").to_numpy()
            for query, at in zip(q, own, strict=True):
                rows, score = search(v, ids, query, at, k)
                best = np.lexsort((ids[rows], -score))[:k]
                out.append((np.full(len(best), at), ids[rows][best], score[best]))
        joined = [np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out, strict=True) if out else [()] * 3)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), joined, strict=True)))

    return run


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest inner product for each query, ties to the smaller vec_id.

    ``vectors(vec_id, embedding)``; other columns play no part. Components count as floor(scale * x) integers.
    Queries are the rows whose vec_id is divisible by ``every``; all rows but those of the query's vec_id are
    its candidates, and fewer than k give all. Null vectors and vectors with a null or non-finite component take
    no part, nor do rows with a null vec_id. A shorter vector's missing components count as 0. Repeated rows are
    candidates each; query rows that share a vec_id are asked once, with the smallest of their vectors. An empty table gives an empty result.
    """
    x = F.col("embedding")
    fit = x.isNotNull() & F.col("vec_id").isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    whole = vectors.where(fit).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))
    asked = whole.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    n, m = whole.agg(F.count("*"), F.count_if(F.col("vec_id") % every == 0)).first()
    shards, blocks = max(6, math.ceil(n / shard_rows)), max(1, math.ceil(m / block_queries))
    by_id = lambda parts: F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    all_of = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    left = whole.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int").alias("shard"), all_of(blocks).alias("block"))
    right = asked.select("vec_id", "v", by_id(blocks).alias("block"), all_of(shards).alias("shard"))
    found = left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(_cell(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
