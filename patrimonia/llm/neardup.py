"""Near-duplicate documents by SuperMinHash, banding, exact verification and union-find grouping.

SuperMinHash (Ertl 2017): every element draws one random permutation of the signature's slots and gives its
j-th slot the rank j plus a fraction, so the ranks of an element are correlated and the similarity estimate
has a lower variance than MinHash of the same length. A slot that round j filled can't be lowered by a later
round, so a document stops as soon as all its slots are filled; the rounds run for a whole batch at once.

A node is a set of shingles, however many documents hold it. Candidates: nodes that agree on a band of slots. A
bucket's members are compared with its head, the member that agrees with most nodes on most bands, and not with
each other. Members that stay outside the head's component are then compared with the rest of the bucket, inside its
tasks: no row stands for a pair, and what joins components already isn't compared again. Bitmaps rule most candidates
out, and only texts of those that remain are fetched and compared in full.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patrimonia.llm import linedup as L
from patrimonia.llm import words as W
from patrimonia.llm.components import components
from patrimonia.llm.store import drop, pruning, save

#: A pair of just the similarity asked for is lost by the bands, and by the slot bits, with this chance at most.
LOSS = 1e-7
#: Slots that the slot bits are taken of.
BIT_SLOTS = 128
BITS = [f"bits{i}" for i in range(8)]
#: Nodes of a bucket that one part of it takes, and pairs that are looked at at once.
LIST_NODES, STEP_PAIRS = 4_096, 1 << 19
_ROW = ["token", "cell", "side", "id", "comp", "out"]
_ROW_FORM = "token long, cell int, side int, id long, comp long, out boolean"
_U = np.uint64


def layout(percent: int) -> tuple[int, int]:
    """(bands, rows) for links of ``percent``: 28 bands of 5 slots at 85, 32 of 4 at 80."""
    rows = 5 if percent >= 85 else 4
    missed = max(1e-12, 1 - (percent / 100) ** rows)
    return max(math.ceil(math.log(LOSS) / math.log(missed)), math.ceil(BIT_SLOTS / rows)), rows


def most_bits(percent: int) -> int:
    """Slot bits that a link of ``percent`` differs in at most: of a slot that differs, each of the two bits does by one half."""
    differs = 1 - percent / 100
    chance = np.ones(1)
    for _ in range(BIT_SLOTS):
        chance = np.convolve(chance, [1 - 0.75 * differs, 0.5 * differs, 0.25 * differs])
    more = np.cumsum(chance[::-1])[::-1]  # of so many or more
    return int(np.flatnonzero(more > LOSS)[-1])


def superminhash(doc: np.ndarray, value: np.ndarray, n_docs: int, slots: int) -> np.ndarray:
    """Signatures (n_docs x slots, 64 bits: rank above 48 random bits) of sets given as sorted (doc, element)."""
    empty = _U(2**64 - 1)
    sig = np.full(n_docs * slots, empty)
    active = np.bincount(doc, minlength=n_docs) > 0
    order: np.ndarray | None = None  # permutations so far, for elements of active documents
    for j in range(slots):
        draw = W.mix(value, 1000 + j)
        k = j + (draw % _U(slots - j)).astype(np.int64)
        rank = (_U(j) << _U(48)) | (draw >> _U(16))
        if order is None:
            slot = k
        else:
            row = np.arange(len(value))
            slot = order[row, k].astype(np.int64)
            order[row, k] = order[row, j]
            order[row, j] = slot
        np.minimum.at(sig, doc * slots + slot, rank)
        still = active & (sig.reshape(n_docs, slots) == empty).any(axis=1)
        if not still.any():
            break
        keep = still[doc]
        if order is None:
            doc, value, k = doc[keep], value[keep], k[keep]
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(value), 1))
            order[np.arange(len(value)), k] = 0
            order[:, 0] = k
        elif not keep.all():
            doc, value, order = doc[keep], value[keep], order[keep]
        active = still
    return sig.reshape(n_docs, slots)


def _slot_bits(sig: np.ndarray) -> np.ndarray:
    """256 bits: two of each of 128 slots."""
    wide = W.mix(sig[:, np.arange(BIT_SLOTS) % sig.shape[1]], 3) & _U(3)
    return (wide.reshape(len(sig), 4, 32) << (np.arange(32, dtype=np.uint64) * _U(2))).sum(axis=2, dtype=np.uint64)


def _parity(doc: np.ndarray, value: np.ndarray, n_docs: int) -> np.ndarray:
    """256 bits: whether an odd number of the set's elements falls to each. Two sets differ in as many elements at least as bits."""
    place = (W.mix(value, 5) >> _U(56)).astype(np.int64)
    odd = (np.bincount(doc * 256 + place, minlength=n_docs * 256) & 1).astype(np.uint64)
    return (odd.reshape(n_docs, 4, 64) << np.arange(64, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)


def _sketches(shingle: int, bands: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    place = W.mix(np.arange(1, rows + 1, dtype=np.uint64), 7) | _U(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, at in W.chunks(batch):
                n = part.num_rows
                word, _, _, first = W.words(raw, at)
                doc, value = W.distinct(*W.shingles(word, first, shingle))
                count = np.bincount(doc, minlength=n)
                name = np.zeros(n, np.uint64)
                np.add.at(name, doc, W.mix(value, 31))
                sig = superminhash(doc, value, n, bands * rows)
                key = W.mix((sig.reshape(n, bands, rows) * place).sum(axis=2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64) * W._STEP)
                bits = np.concatenate([_slot_bits(sig), _parity(doc, value, n)], axis=1)
                yield pa.record_batch(
                    [
                        part.column(0), part.column(2), pa.array(count.astype(np.int64)), pa.array(W.mix(name, 1).view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * bands), pa.array(key.view(np.int64).ravel())),
                        *(pa.array(np.ascontiguousarray(bits[:, i]).view(np.int64)) for i in range(8)),
                    ],
                    ["doc_id", "h", "n", "node", "bands", *BITS],
                )

    return run


def _sets(column: pa.Array, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    word, _, _, first = W.words(*W.text_bytes(column))
    return W.distinct(*W.shingles(word, first, shingle))


def _verify(shingle: int, percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs whose full shingle sets have 100 * intersection >= percent * union. Rows in a row that share b read its text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _ in W.chunks(batch, "text_a"):
                n = part.num_rows
                b = part.column(1).to_numpy()
                fresh = np.concatenate([[True], b[1:] != b[:-1]])
                partner = np.cumsum(fresh) - 1
                row_a, value_a = _sets(part.column(2), shingle)
                row_b, value_b = _sets(part.column(3).filter(pa.array(fresh)), shingle)
                tag = W.mix(np.arange(len(b), dtype=np.uint64), 11)
                held, asked = np.sort(value_b + tag[row_b]), value_a + tag[partner[row_a]]
                place = np.minimum(np.searchsorted(held, asked), max(0, len(held) - 1))
                found = held[place] == asked if len(held) else np.zeros(len(asked), bool)
                shared = np.bincount(row_a[found], minlength=n)
                union = np.bincount(row_a, minlength=n) + np.bincount(row_b, minlength=n)[partner] - shared
                yield part.select([0, 1]).take(pa.array(np.flatnonzero((100 * shared >= percent * union) & (shared > 0))))

    return run


def _plausible(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """``pairs(a, b)`` whose sizes and bitmaps allow a link."""
    both = pairs
    for x in "ab":
        both = both.join(classes.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), *(F.col(c).alias(f"{c}_{x}") for c in BITS)), x)
    slots, parity = (" + ".join(f"bit_count({c}_a ^ {c}_b)" for c in part) for part in (BITS[:4], BITS[4:]))
    # of n_a + n_b elements that are counted twice if shared, a linked pair has this many in one set only at most
    both = both.where(f"{slots} <= {most_bits(percent)}").where(f"({parity}) * {100 + percent} <= (n_a + n_b) * {100 - percent}")
    return both.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)").select("a", "b")


def _texts(nodes: DataFrame, text: DataFrame, classes: DataFrame) -> DataFrame:
    """(node, text): one text of each of ``nodes(node)``, which are distinct."""
    wanted = save(classes.join(nodes, "node").select("node", "n", "rep.doc_id", "rep.h"), "wanted")
    with pruning(text.sparkSession):
        texts = save(text.where("text is not null").join(wanted.where("n > 0"), ["doc_id", "h"]).dropDuplicates(["doc_id", "h"]).select("node", "text"), "texts")
    drop(wanted)
    return texts


def _confirmed(pairs: DataFrame, text: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The links among ``pairs(a, b)``, on the full sets of one text for each node."""
    texts = _texts(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), text, classes)
    a = pairs.join(texts.withColumnsRenamed({"node": "a", "text": "text_a"}), "a")
    both = a.join(texts.withColumnsRenamed({"node": "b", "text": "text_b"}), "b").select("a", "b", "text_a", "text_b")
    links = save(both.mapInArrow(_verify(shingle, percent), "a long, b long"), "links")
    drop(texts)
    return links


def _across(table: pa.Table, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one list (by n) in different components, the first of them out, that lengths allow; of two parts of a list, pairs across them."""
    side, comp, n, out = (table.column(c).to_numpy() for c in ("side", "comp", "n", "out"))
    of = L._list_of(table) << 32
    place, i = of | n, np.flatnonzero(out)
    lo = np.searchsorted(place, of[i] | -(-percent * n[i] // 100))
    hi = np.searchsorted(place, of[i] | 100 * n[i] // percent, "right")
    step = np.cumsum(hi - lo) // STEP_PAIRS
    for some in np.split(np.arange(len(i)), np.flatnonzero(step[1:] != step[:-1]) + 1):
        pair, b = L._each(lo[some], (hi - lo)[some])
        a = i[some][pair]
        fit = (comp[a] != comp[b]) & (~out[b] | (a < b)) & ((side[a] < 0) | (side[a] != side[b]))
        yield a[fit], b[fit]


def _distinct_ids(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    _, row, of = np.unique(table.column("id").to_numpy(), return_index=True, return_inverse=True)
    return row, of


def _possible(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows of lists where sizes and bitmaps allow a link across components."""
    most = most_bits(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in L._lists(batches):
            bits = np.stack([table.column(c).to_numpy().view(np.uint64) for c in BITS], axis=1)
            n, hit = table.column("n").to_numpy(), np.zeros(table.num_rows, bool)
            for a, b in _across(table, percent):
                differ = np.bitwise_count(bits[a] ^ bits[b]).astype(np.int64)
                fit = (differ[:, :4].sum(axis=1) <= most) & (differ[:, 4:].sum(axis=1) * (100 + percent) <= (n[a] + n[b]) * (100 - percent))
                hit[a[fit]] = hit[b[fit]] = True
            yield from table.select(_ROW).take(pa.array(np.flatnonzero(hit))).to_batches()

    return run


def _whole_sets(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, n, sketch, shingles) of ``(node, text)``: the set and a parity bitmap that grows with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, at in W.chunks(batch):
                word, _, _, first = W.words(raw, at)
                row, value = W.distinct(*W.shingles(word, first, shingle))
                size = np.bincount(row, minlength=part.num_rows)
                sketch, pieces = L._sketches(value, size)
                yield pa.record_batch(
                    [part.column(0), pa.array(size.astype(np.int64)), L._list_array(pieces, sketch.view(np.int64)), L._list_array(size, value.view(np.int64))],
                    ["id", "n", "sketch", "shingles"],
                )

    return run


def _likely(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The rows of lists where whole bitmaps allow a link across components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in L._lists(batches):
            row, of = _distinct_ids(table)
            sketches, n, hit = L._Sketches(table, row), table.column("n").to_numpy(), np.zeros(table.num_rows, bool)
            for some in _across(table, percent):
                for a, b in L._steps(*some, n):
                    fit = sketches.apart(of[a], of[b]) * (100 + percent) <= (n[a] + n[b]) * (100 - percent)
                    hit[a[fit]] = hit[b[fit]] = True
            yield from table.select(_ROW).take(pa.array(np.flatnonzero(hit))).to_batches()

    return run


def _tied(percent: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(a, b): links that tie the components of a task's lists together, on full sets; no more of them than components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in L._lists(batches):
            row, of = _distinct_ids(table)
            sketches, sets = L._Sketches(table, row), L._Held(table, "shingles", row)
            node, n = table.column("id").to_numpy(), table.column("n").to_numpy()
            _, root = np.unique(table.column("comp").to_numpy(), return_inverse=True)
            links = []
            for some in _across(table, percent):
                for a, b in L._steps(*some, n):
                    fit = (root[a] != root[b]) & (sketches.apart(of[a], of[b]) * (100 + percent) <= (n[a] + n[b]) * (100 - percent))
                    a, b = a[fit], b[fit]
                    shared = sets.shared(of[a], of[b])
                    fit = 100 * shared >= percent * (n[a] + n[b] - shared)
                    for x, y in zip(a[fit], b[fit], strict=True):
                        if root[x] != root[y]:
                            root[root == root[y]] = root[x]
                            links.append((int(node[x]), int(node[y])))
            yield pa.record_batch([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def _ties(rest: DataFrame, text: DataFrame, classes: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) across components in the buckets ``rest(token, id, comp, out)``: of those that are out with all others."""
    busy = rest.groupBy("token").agg(F.count("*").alias("size")).where(F.col("size") > LIST_NODES)
    busy = save(busy.select("token", F.ceil(F.col("size") / LIST_NODES).cast("int").alias("parts")), "busy")
    shape = classes.select(F.col("node").alias("id"), "n", *BITS)
    possible = save(L.in_lists(rest.join(shape, "id").select("token", *_ROW[3:], "n", *BITS), busy).mapInArrow(_possible(percent), _ROW_FORM), "possible")
    texts = _texts(possible.select(F.col("id").alias("node")).distinct(), text, classes)
    sets = save(texts.mapInArrow(_whole_sets(shingle), "id long, n long, sketch array<long>, shingles array<long>"), "sets")
    drop(texts)
    listed = lambda rows, *more: rows.join(sets, "id").select(*_ROW, "n", "sketch", *more).repartition("token", "cell").sortWithinPartitions("token", "cell")
    likely = save(listed(possible).mapInArrow(_likely(percent), _ROW_FORM), "likely")
    ties = save(listed(likely, "shingles").mapInArrow(_tied(percent), "a long, b long"), "ties")
    for table in (busy, possible, sets, likely):
        drop(table)
    return ties


def near_duplicates(docs: DataFrame, percent: int = 85, shingle: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs(doc_id, text)``; other columns play no part.

    Two documents are linked when 100 * intersection >= percent * union of their sets of ``shingle``-word
    shingles (A-Z lower-cased, words between ASCII white space; fewer words: the whole sequence as one).
    component_id is the smallest doc_id that links reach; kept tells whether that is the row's own.
    Null, empty and wordless texts have an empty set and are linked with nothing. Repeated rows get the same
    component. Rows that share a doc_id are one document, linked by what any of their texts resembles. A null doc_id
    takes part in no link and is kept with a null component. An empty table gives an empty result.
    """
    if percent < 80:
        raise ValueError("percent is 80 or more: the bands are laid out for such links")
    bands, rows = layout(percent)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("text").cast("string")).alias("h"))
    form = "doc_id long, h long, n long, node long, bands array<long>, " + ", ".join(f"{x} long" for x in BITS)
    sketch = save(text.mapInArrow(_sketches(shingle, bands, rows), form), "sketches")
    full = sketch.where("n > 0 and doc_id is not null")
    # what a set determines is the same in all its rows
    classes = save(full.groupBy("node").agg(F.min(F.struct("doc_id", "h")).alias("rep"), *(F.first(c).alias(c) for c in ("n", "bands", *BITS))), "classes")

    every = classes.select(F.explode(F.array_distinct("bands")).alias("key"), F.col("node").alias("a"))
    sizes = save(every.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
    shared = save(every.join(sizes, "key"), "shared")
    weight = shared.groupBy("a").agg(F.sum("size").alias("weight"))
    member = save(shared.drop("size").join(weight, "a"), "buckets")
    heads = member.groupBy("key").agg(F.max(F.struct("weight", (-F.col("a")).alias("less"))).alias("head"))
    heads = save(heads.select("key", (-F.col("head.less")).alias("b")), "heads")
    drop(sizes)
    drop(shared)
    pairs = save(_plausible(member.join(heads, "key").where("a <> b").select("a", "b").distinct(), classes, percent), "pairs")
    links = _confirmed(pairs, text, classes, shingle, percent)
    drop(pairs)
    groups = save(components(links, "a", "b"), "groups")

    # A bucket whose members are in several components: those outside its head's are held against all the others.
    placed = member.select("key", "a").join(heads.select("key", F.col("b").alias("head")), "key")
    for name in ("a", "head"):
        own = groups.select(F.col("node").alias(name), F.col("component").alias(f"comp_{name}"))
        placed = placed.join(own, name, "left").withColumn(f"comp_{name}", F.coalesce(f"comp_{name}", name))
    placed = save(placed.select("key", "a", F.col("comp_a").alias("comp"), (F.col("comp_a") != F.col("comp_head")).alias("out")), "placed")
    drop(member)
    drop(heads)
    open_ = placed.where("out").select("key").distinct()
    rest = save(placed.join(open_, "key", "left_semi").select(F.col("key").alias("token"), F.col("a").alias("id"), "comp", "out"), "rest")
    drop(placed)
    # the components so far are stars, which stand for the links that made them
    links = groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(_ties(rest, text, classes, shingle, percent))
    drop(rest)
    # rows that share a doc_id tie their sets together
    one = full.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("last")).where("b <> last").select("doc_id", "b")
    links = links.union(full.select("doc_id", F.col("node").alias("a")).join(one, "doc_id").select("a", "b"))
    tied = save(components(links, "a", "b"), "groups")
    drop(groups)
    groups = tied

    first = groups.join(classes.select("node", "rep.doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("first"))
    owned = groups.join(first, "component").select("node", "first")
    placed = save(classes.select("node", "rep.doc_id").join(owned, "node", "left").select("node", F.coalesce("first", "doc_id").alias("component")), "placed")
    drop(groups)
    drop(classes)
    out = sketch.select("doc_id", F.col("n").alias("n_shingles"), "node").join(placed, "node", "left")
    return out.select(
        "doc_id", "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
