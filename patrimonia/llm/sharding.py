"""Shards of equal row counts that keep linked documents together: label propagation under capacity quotas.

Documents of equal text are linked. In each round a group counts its members by shard and calls those outside
its fullest shard there. Between two shards as many callers are admitted as move the other way, and beyond that
as many as a shard's capacity for linked documents has room for. Documents without links then fill every shard
to its quota. DataFrame operations only; what reaches the driver is a count for each pair of shards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patrimonia.llm.store import drop, save

#: Rows of one numbering window; more rows give more windows, not longer ones.
WINDOW_ROWS = 20_000
_UNIT = 2**31


def _share(*parts: Column | str) -> Column:
    """A uniform number in [0, 1) that depends on ``parts`` alone."""
    return F.pmod(F.xxhash64(*parts), F.lit(_UNIT)) / _UNIT


def _at(values: list[int], index: Column) -> Column:
    return F.array(*(F.lit(int(x)).cast("long") for x in values))[index]


def _counts(df: DataFrame, shards: int) -> list[int]:
    found = {x["shard"]: x["count"] for x in df.groupBy("shard").count().collect()}
    return [found.get(s, 0) for s in range(shards)]


def propagate(linked: DataFrame, shards: int, capacity: int, rounds: int) -> DataFrame:
    """``linked(h, text_crc32, shard, ...)`` with shard moved towards the group's fullest shard."""
    link = ["h", "text_crc32"]
    for number in range(rounds):
        load = _counts(linked, shards)
        cells = linked.groupBy(*link, "shard").agg(F.count("*").alias("n"))
        tie = F.xxhash64(*link, "shard")
        top = cells.groupBy(*link).agg(F.max(F.struct("n", tie.alias("tie"), "shard")).alias("top")).select(*link, F.col("top.shard").alias("to"))
        calls = save(cells.join(top, link).where("to <> shard"), "calls")
        called = {(x["shard"], x["to"]): x["n"] for x in calls.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}
        if not called:
            drop(calls)
            break
        room = [max(0, capacity - x) for x in load]
        into = [max(1, sum(n for (_, t), n in called.items() if t == s)) for s in range(shards)]
        admit = [min(1.0, (min(called[s, t], called.get((t, s), 0)) + room[t] * called[s, t] / into[t]) / called[s, t]) if (s, t) in called else 0.0 for s in range(shards) for t in range(shards)]
        share = F.lit(admit)[F.col("shard") * shards + F.col("to")]
        moves = calls.withColumn("part", F.floor(F.col("n") * share + _share(*link, "shard", F.lit(number))) / F.col("n"))
        after = linked.join(moves.where("part > 0").select(*link, "shard", "to", "part"), [*link, "shard"], "left")
        goes = F.col("to").isNotNull() & (_share("doc_id", "row", F.lit(number)) < F.col("part"))
        after = save(after.withColumn("shard", F.when(goes, F.col("to")).otherwise(F.col("shard"))).drop("to", "part"), "linked")
        drop(linked)
        drop(calls)
        linked = after
    return linked


def numbered(df: DataFrame, first: Column, rows: int, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """``df(shard, ...)`` with rank: gapless from 0 within each shard, rows with a smaller ``first`` before others.

    Rows are dealt to windows by a hash of doc_id and ``row``, which repeated rows don't share; a window's rank starts after the rows of the windows before it.
    """
    parts = max(8, math.ceil(rows / window_rows))
    dealt = save(df.withColumn("window", first.cast("long") * parts + F.pmod(F.xxhash64("doc_id", "row"), F.lit(parts))), "dealt")
    sizes = dealt.groupBy("shard", "window").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("window").rowsBetween(Window.unboundedPreceding, -1)
    starts = save(sizes.select("shard", "window", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")), "starts")
    inside = Window.partitionBy("shard", "window").orderBy("doc_id", "h", "row")
    ranked = dealt.withColumn("rank", F.row_number().over(inside) - 1).join(starts, ["shard", "window"])
    return ranked.withColumn("rank", (F.col("rank") + F.col("start")).cast("long")).drop("start", "window", "row")


def shard_documents(docs: DataFrame, shards: int = 16, rounds: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard, linked) for each row of ``docs(doc_id, text)``.

    law is ``rows``: shards hold row counts at most one apart. Slots run from 0 without gaps in each shard.
    size is the text's UTF-8 bytes plus 1; a null text has size 1, the checksum of no bytes (0) and no links.
    Rows of equal, non-null text are linked. A group larger than a shard is spread over as few shards as the
    quotas allow. Repeated rows and null doc_ids are placed like others: rows are parted by their number in the table, so
    that one document on a third of the rows fills many windows. Other columns play no part. An empty
    table gives an empty result. grown_shard is null: only the law ``key`` has it.
    """
    text = F.col("text").cast("string")
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("h"),
        text.isNotNull().alias("has"),
    )
    # the number of a row in the table parts rows that repeat one another; it is written, so that all readers see the same
    base = base.withColumn("row", F.monotonically_increasing_id())
    base = save(base.withColumn("shard", F.pmod(F.xxhash64("doc_id", "h", F.lit(1)), F.lit(shards)).cast("int")), "rows")
    rows = base.count()
    groups = save(base.where("has").groupBy("h", "text_crc32").agg(F.count("*").alias("n")).where("n > 1").select("h", "text_crc32"), "groups")
    linked = save(base.where("has").join(groups, ["h", "text_crc32"], "left_semi").drop("has"), "linked")
    alone = base.where("has").join(groups, ["h", "text_crc32"], "left_anti").unionByName(base.where("not has")).drop("has")
    linked = propagate(linked, shards, rows // shards, rounds)
    both = linked.withColumn("linked", F.lit(True)).unionByName(alone.withColumn("linked", F.lit(False)))
    ranked = save(numbered(both, ~F.col("linked"), rows), "ranked")

    have = _counts(ranked, shards)
    quota = [rows // shards + (s < rows % shards) for s in range(shards)]
    over = [max(0, h - q) for h, q in zip(have, quota, strict=True)]
    free = [max(0, q - h) for h, q in zip(have, quota, strict=True)]
    over_from = [sum(over[:s]) for s in range(shards)]
    free_to = [sum(free[: s + 1]) for s in range(shards)]
    shard, rank = F.col("shard"), F.col("rank")
    spare = F.when(rank >= _at(quota, shard), rank - _at(quota, shard) + _at(over_from, shard))
    placed = ranked.withColumn("spare", spare)
    to = sum(((F.col("spare") >= x).cast("int") for x in free_to[:-1]), F.lit(0)) if shards > 1 else F.lit(0)
    placed = placed.withColumn("new", F.when(F.col("spare").isNotNull(), to).otherwise(shard))
    slot = F.when(F.col("spare").isNotNull(), F.col("spare") - _at([t - f for t, f in zip(free_to, free, strict=True)], F.col("new")) + _at(have, F.col("new"))).otherwise(rank)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("new").cast("int").alias("shard"),
        slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "linked",
    )
