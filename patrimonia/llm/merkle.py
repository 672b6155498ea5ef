"""A Merkle manifest of a dataset: a tree for each group, a tree over the groups' roots, and every row's proof.

Large blocks of consecutive leaves are reduced to one node each by tasks, round by round, until few nodes are left. The
driver builds the top tree of these, and the paths from its nodes to the root are broadcast. On the way back each block
is read again, gets the rest of its path, and finishes its nodes' proofs. Positions come from a range sort: no task and
no driver ever holds a group of rows, and what the driver holds is at most ``TOP_NODES`` nodes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from patrimonia.llm.store import save

#: Nodes that the driver builds the top tree of; with their paths some 4 KB each.
TOP_NODES = 2048
#: Levels that a task reduces at once: blocks of 8 ** 4 nodes, under 1 MB.
BLOCK_LEVELS = 4


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def parents(nodes: Sequence[str], fan_out: int) -> list[str]:
    """One level up: each run of ``fan_out`` consecutive nodes gives its digest; the last run may be shorter."""
    return [_h("".join(nodes[i : i + fan_out])) for i in range(0, len(nodes), fan_out)]


def levels(nodes: Sequence[str], fan_out: int, height: int | None = None) -> list[list[str]]:
    """All levels from ``nodes`` up, ``height`` of them above it, or as many as leave one node."""
    out = [list(nodes)]
    while len(out) <= height if height is not None else len(out[-1]) > 1:
        out.append(parents(out[-1], fan_out))
    return out


def climb(tree: Sequence[Sequence[str]], at: int, fan_out: int) -> tuple[list[tuple[int, int]], str]:
    """The way of node ``at`` up the levels below the last: (place, size) of each run, and all siblings joined."""
    places, siblings = [], []
    for level in tree[:-1]:
        begin = at - at % fan_out
        run = level[begin : begin + fan_out]
        places.append((at - begin, len(run)))
        siblings += run[: at - begin] + run[at - begin + 1 :]
        at //= fan_out
    return places, "".join(siblings)


def fold(leaf: str, places: Sequence[tuple[int, int]], siblings: str, width: int = 64) -> str:
    """The root that ``leaf`` gives with its siblings."""
    begin = 0
    for place, size in places:
        middle, end = begin + place * width, begin + (size - 1) * width
        leaf, begin = _h(siblings[begin:middle] + leaf + siblings[middle:end]), end
    return leaf


def _coded(places: Sequence[tuple[int, int]]) -> list[int]:
    return [x for pair in places for x in pair]


def _paired(coded: Sequence[int]) -> list[tuple[int, int]]:
    return list(zip(coded[::2], coded[1::2], strict=True))


def _sized(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The digest of a row: each field as its length in UTF-8 bytes, a colon and its value, or ``-`` if it is null."""
    return F.sha2(F.concat(*(_sized(f) for f in fields)).cast("binary"), 256)


def place(rows: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` with ``tree`` (ascending with ``group``, null first), ``pos`` in it by ``order``, and its size ``n``; without ``group``.

    A range sort deals the rows out; the numbers of each task's rows, added up over the tasks, give the positions. Equal
    rows are told apart by their place in the input, so that no key is too frequent to be split.
    """
    tie = F.monotonically_increasing_id().alias("_tie")
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    keys = [group, *order, "_tie"]
    dealt = rows.select("*", tie).repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_tie")
    dealt = save(dealt.withColumn("number", F.monotonically_increasing_id()).withColumn("part", F.shiftright("number", 33).cast("int")), name)
    runs = dealt.groupBy("part", group).agg(F.min("number").alias("begin"), F.count("*").alias("count"))
    whole = Window.partitionBy(group)  # a row for each task, not for each of the group's rows
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "part",
        F.col(group).alias("_group"),
        (F.coalesce(F.sum("count").over(earlier), F.lit(0)) - F.col("begin")).alias("shift"),
        F.min("begin").over(whole).alias("tree"),
        F.sum("count").over(whole).alias("n"),
    )
    runs = runs.withColumnRenamed("part", "_part")
    joined = dealt.join(runs, (F.col("part") == F.col("_part")) & F.equal_null(group, "_group"))
    return joined.withColumn("pos", F.col("number") + F.col("shift")).drop("number", "part", "_part", "_group", "shift", group)


def _blocks(fan_out: int, height: int) -> Callable[[pa.Table], pa.Table]:
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        size, tree, n, pos = fan_out**height, block["tree"][0].as_py(), block["n"][0].as_py(), block["pos"][0].as_py()
        root = levels(block["digest"].to_pylist(), fan_out, height if n > size else None)[-1][0]
        return pa.table({"tree": pa.array([tree], pa.int64()), "pos": pa.array([pos // size], pa.int64()), "n": pa.array([-(-n // size)], pa.int64()), "digest": [root]})

    return run


def _finish(fan_out: int, height: int, keep: Sequence[str], end: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Nodes of a block and the block's own way to the root, as nodes with theirs, or with what ``end`` makes of them."""

    def run(block: pa.Table, upper: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        size, n = fan_out**height, block["n"][0].as_py()
        tree = levels(block["digest"].to_pylist(), fan_out, height if n > size else None)
        rest, above = upper["places"][0].as_py(), upper["siblings"][0].as_py()
        ways = [climb(tree, at, fan_out) for at in range(block.num_rows)]
        out = {c: block[c] for c in keep}
        out["places"] = pa.array([_coded(p) + rest for p, _ in ways], pa.list_(pa.int32()))
        out["siblings"] = pa.array([s + above for _, s in ways], pa.large_string()).cast(pa.string())
        for name in ("subroot", "root"):
            out[name] = pa.array(upper[name].to_pylist() * block.num_rows, pa.string())
        return end(pa.table(out))

    return run


_WAY = "places array<int>, siblings string, subroot string, root string"


def _top(spark: SparkSession, nodes: DataFrame, fan_out: int, one_tree: bool) -> DataFrame:
    """The ways of at most ``TOP_NODES`` nodes to the root, built here and read by every task."""
    rows = sorted((r["tree"], r["pos"], r["digest"]) for r in nodes.select("tree", "pos", "digest").collect())
    trees: dict[int, list[str]] = {}
    for tree, _, digest in rows:
        trees.setdefault(tree, []).append(digest)
    lower = {t: levels(digests, fan_out) for t, digests in trees.items()}
    upper = levels([lower[t][-1][0] for t in trees], fan_out)
    out = []
    for number, tree in enumerate(trees):
        rest, above = climb(upper, number, fan_out)
        for at in range(len(trees[tree])):
            places, siblings = climb(lower[tree], at, fan_out)
            subroot = None if one_tree else lower[tree][-1][0]
            out.append((tree, at, _coded(places + rest), siblings + above, subroot, upper[-1][0]))
    return spark.createDataFrame(out, f"tree long, pos long, {_WAY}")


def ways(nodes: DataFrame, fan_out: int, height: int, top: int, keep: Sequence[str], one_tree: bool = False, end: tuple[Callable[[pa.Table], pa.Table], str] | None = None) -> DataFrame:
    """``keep`` of ``nodes(tree, pos, n, digest, ...)`` with each node's way to the root: places, siblings, subroot and root.

    ``one_tree`` says that the trees are the groups' tree already, whose nodes have no subroot above them. ``end`` is a
    function that tasks apply to these rows, and the schema that it gives.
    """
    kept = ", ".join(f"{c} {dict(nodes.dtypes)[c]}" for c in keep)
    make, schema = end or (_same, f"{kept}, {_WAY}")
    count, largest = nodes.agg(F.count("*"), F.max("n")).first()
    if count <= top:
        found = _top(nodes.sparkSession, nodes, fan_out, one_tree)
        up = nodes.join(F.broadcast(found), ["tree", "pos"]).select(*keep, "places", "siblings", "subroot", "root")
    elif largest == 1 and not one_tree:  # what is left are the groups' roots: they are the nodes of one tree
        own = [c for c in keep if c not in ("tree", "pos", "digest")]
        listed = place(nodes.select(F.lit(0).alias("one"), F.col("tree").alias("group"), "digest", *own), "one", ["group"], "groups")
        listed = ways(listed, fan_out, height, top, ["group", "digest", *own], True).withColumn("subroot", F.col("digest"))
        renamed = {"tree": F.col("group").alias("tree"), "pos": F.lit(0).cast("long").alias("pos")}
        up = listed.select(*(renamed.get(c, F.col(c)) for c in keep), "places", "siblings", "subroot", "root")
    else:
        block = F.expr(f"pos div {fan_out**height}").alias("block")
        small = nodes.select("tree", "pos", "n", "digest", block).groupBy("tree", "block")
        reduced = save(small.applyInArrow(_blocks(fan_out, height), "tree long, pos long, n long, digest string"), "nodes")
        upper = ways(reduced, fan_out, height, top, ["tree", "pos"], one_tree).withColumnRenamed("pos", "block")
        lower = nodes.withColumn("block", block).groupBy("tree", "block")
        return lower.cogroup(upper.groupBy("tree", "block")).applyInArrow(_finish(fan_out, height, keep, make), schema)
    return up.mapInArrow(_each(make), schema) if end else up


def _same(rows: pa.Table) -> pa.Table:
    return rows


def _each(make: Callable[[pa.Table], pa.Table]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from make(pa.Table.from_batches([batch])).to_batches()

    return run


def _proved(proofs: bool) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        siblings, places = rows["siblings"].to_pylist(), rows["places"].to_pylist()
        roots = [fold(leaf, _paired(p), s) for leaf, p, s in zip(rows["claimed"].to_pylist(), places, siblings, strict=True)]
        out = {c: rows[c] for c in ("id", "digest", "subroot", "root", *(("places", "siblings") if proofs else ()))}
        return pa.table(out | {"proof_sha256": [_h(s) for s in siblings], "folded_root": roots})

    return run


def merkle_manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "lang",
    order: str = "doc_id",
    claims: dict[str, Column] | None = None,
    proofs: bool = True,
    fan_out: int = 8,
    block_levels: int = BLOCK_LEVELS,
    top_nodes: int = TOP_NODES,
) -> DataFrame:
    """(order, leaf, subroot, root, places, siblings, proof_sha256, folded_root) for every row of ``docs``.

    A row's leaf is the digest of its ``fields``. Leaves of a ``group`` ascend by ``order`` (null first, equal ones by
    digest); runs of ``fan_out`` become their digest until one node remains, the group's ``subroot``; these, ordered by
    group (null first, then by bytes), likewise give ``root``. ``siblings`` are the digests of a row's proof from bottom
    to top in one string, ``places`` the (place, size) of each run on the way (both left out without ``proofs``), and
    ``proof_sha256`` is the digest of ``siblings``. ``claims`` are fields as somebody presents
    them (by default as they are): ``folded_root`` is what the claimed row gives with the original siblings, which is
    ``root`` only if no claim differs. Rows alike in all fields each have a leaf. Null fields count as ``-``, other than
    empty ones. A single row is its own leaf, subroot and root. An empty table gives an empty result. Further columns play
    no part, whatever their names.
    """
    own = [F.col(f) for f in fields]
    claimed = [(claims or {}).get(f, F.col(f)) for f in fields]
    rows = docs.select(F.col(order).alias("id"), F.col(group).alias("group"), leaf_digest(own).alias("digest"), leaf_digest(claimed).alias("claimed"))
    rows = save(rows, "digests")  # read twice by the range sort, which samples first
    placed = save(place(rows, "group", ["id", "digest"], "leaves"), "placed")
    way = "places array<int>, siblings string, " if proofs else ""
    schema = f"id {dict(rows.dtypes)['id']}, digest string, subroot string, root string, {way}proof_sha256 string, folded_root string"
    told = ways(placed, fan_out, block_levels, top_nodes, ["id", "digest", "claimed"], end=(_proved(proofs), schema))
    return told.withColumnsRenamed({"id": order, "digest": "leaf"})
