"""Benchmark decontamination: short test items found inside long documents by MinHash containment search.

The items are parted by size. An item of n shingles keeps the s lowest-ranked of them under one random
permutation (a bottom-s MinHash sketch), where s = n - ceil(t n) + 1 for its size part's largest n: a
document that holds a share t of the item must hold at least one of those, whatever the document's length.
Documents look their shingles up in the sketches' postings; what is hit is verified on the full sets.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrimonia.llm import words as W
from patrimonia.llm.store import save

#: Most shingles of items that one pass over the documents holds in memory (8 bytes each, and as much again for postings).
BLOCK_SHINGLES = 2_000_000
_BITS = np.uint64(48)


def _shingle_sets(shingle: int, ids: tuple[str, ...]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, at in W.chunks(batch):
                word, _, _, first = W.words(raw, at, W.NON_ALNUM)
                row, value = W.distinct(*W.shingles(word, first, shingle))
                size = np.minimum(np.diff(first), shingle)
                own = [part.column(part.schema.get_field_index(c)).take(pa.array(row)) for c in ids]
                yield pa.record_batch([*own, pa.array(size[row]), pa.array(value.view(np.int64))], [*ids, "k", "value"])

    return run


class Sketches:
    """The items of a block that have one shingle length k: full sets, and postings of the lowest-ranked shingles."""

    def __init__(self, k: int, items: dict[int, np.ndarray], threshold: float) -> None:
        self.k, self.ids = k, np.array(sorted(items), np.int64)
        self.sets = [items[i] for i in self.ids]
        value, owner = [], []
        for at, own in enumerate(self.sets):
            part = 1 << (len(own) - 1).bit_length()  # items of part/2 + 1 to part shingles
            depth = min(len(own), part - math.ceil(round(threshold * part, 9)) + 1)
            value.append(own[np.argsort(W.mix(own, 77))[:depth]])
            owner.append(np.full(depth, at))
        self.value, self.owner = np.concatenate(value), np.concatenate(owner)
        order = np.argsort(self.value, kind="stable")
        self.value, self.owner = self.value[order], self.owner[order]
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[(self.value >> _BITS).astype(np.int64)] = True

    def hits(self, row: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Distinct (row, item) of which a sketch holds a shingle."""
        seen = self.maybe[(value >> _BITS).astype(np.int64)]
        row, value = row[seen], value[seen]
        low, high = np.searchsorted(self.value, value), np.searchsorted(self.value, value, "right")
        some = high > low
        row, low, many = row[some], low[some], (high - low)[some]
        if not len(row):
            return np.zeros((0, 2), np.int64)
        at = np.repeat(low - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
        return np.unique(np.stack([np.repeat(row, many), self.owner[at]], axis=1), axis=0)


def _contained(blocks: list[Sketches], threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, at in W.chunks(batch):
                word, _, _, first = W.words(raw, at, W.NON_ALNUM)
                found: list[tuple[int, int, int, int]] = []
                for block in blocks:
                    row, value = W.shingles(word, first, block.k)
                    run_of_k = np.diff(first)[row] >= block.k  # a shorter text's whole sequence is no run of k words
                    row, value = row[run_of_k], value[run_of_k]  # and so rows stand in order
                    hits = block.hits(row, value)
                    if len(hits):
                        begin, end = np.searchsorted(row, hits[:, 0]), np.searchsorted(row, hits[:, 0], "right")
                        for (r, item), lo, hi in zip(hits, begin, end, strict=True):
                            own = block.sets[item]
                            shared = int(np.isin(own, value[lo:hi]).sum())
                            if shared >= threshold * len(own) - 1e-9:
                                found.append((r, int(block.ids[item]), len(own), shared))
                if found:
                    row, item, size, shared = (np.array(x) for x in zip(*found, strict=True))
                    yield pa.record_batch([part.column(0).take(pa.array(row)), pa.array(item), pa.array(size), pa.array(shared), pa.array(shared / size)], ["doc_id", "item_id", "n_item_shingles", "n_shared", "containment"])

    return run


def _by_join(text: DataFrame, sets: DataFrame, threshold: float, shingle: int) -> DataFrame:
    """What documents hold of items too large for a task's memory: both sides' shingles meet in a join and are counted."""
    rows = text.withColumn("row", F.monotonically_increasing_id())
    own = rows.mapInArrow(_shingle_sets(shingle, ("row", "doc_id")), "row long, doc_id long, k long, value long")
    size = sets.groupBy("item_id").agg(F.count("*").alias("n_item_shingles"))
    found = own.join(sets, ["k", "value"]).groupBy("row", "doc_id", "item_id").agg(F.count("*").alias("n_shared")).join(size, "item_id")
    held = found.where(F.col("n_shared") >= threshold * F.col("n_item_shingles") - 1e-9)
    return held.select("doc_id", "item_id", "n_item_shingles", "n_shared", (F.col("n_shared") / F.col("n_item_shingles")).alias("containment"))


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.8, shingle: int = 5, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared, containment): items of which a document holds ``threshold`` or more.

    ``docs(doc_id, text)`` against ``items(item_id, text)``; other columns play no part. Words are runs of ASCII
    letters (A-Z lower-cased), digits and non-ASCII characters; an item's set holds its distinct runs of ``shingle``
    words, and an item of fewer words its whole sequence, found as a run of so many words. Null, empty and
    wordless texts on either side match nothing; rows with a null id are left out. Repeated rows give one result
    row each; items that share an id are one set of shingles. With no items or documents the result is empty.

    The items' sets are sent to all tasks in blocks of at most about ``block_shingles``, one pass over the documents for
    each block. An item that alone has more than that is found by a join of its shingles with the documents'.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold lies above 0 and up to 1")
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id is not null and text is not null")
    own = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    sets = save(own.mapInArrow(_shingle_sets(shingle, ("item_id",)), "item_id long, k long, value long").distinct(), "items")
    large = sets.groupBy("item_id", "k").agg(F.count("*").alias("n")).where(F.col("n") > block_shingles).select("item_id", "k")
    out = None
    lengths = sorted(int(x["k"]) for x in large.select("k").distinct().collect())  # up to ``shingle`` of them
    for k in lengths:
        found = _by_join(text, sets.join(large.where(F.col("k") == k), ["item_id", "k"], "left_semi"), threshold, k)
        out = found if out is None else out.unionByName(found)
    if lengths:
        sets = save(sets.join(large, ["item_id", "k"], "left_anti"), "items")
    total = sets.count()
    parts = max(1, math.ceil(total / block_shingles * 1.2)) if total > block_shingles else 1
    for number in range(parts):
        block = sets.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == number) if parts > 1 else sets
        got = block.toPandas()
        by_k = [Sketches(int(k), {int(i): np.sort(g["value"].to_numpy(np.int64).view(np.uint64)) for i, g in rows.groupby("item_id")}, threshold) for k, rows in got.groupby("k")]
        if by_k:
            found = text.mapInArrow(_contained(by_k, threshold), "doc_id long, item_id long, n_item_shingles long, n_shared long, containment double")
            out = found if out is None else out.unionByName(found)
    empty = "doc_id long, item_id long, n_item_shingles long, n_shared long, containment double"
    return out if out is not None else docs.sparkSession.createDataFrame([], empty)
