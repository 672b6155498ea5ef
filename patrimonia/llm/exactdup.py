"""Exact duplicates by a 128-bit hash of the normalised text, with texts compared byte by byte inside each hash's group.

Grouping by the hash and the text itself makes Spark compare all bytes of the group's keys, and adds up copies in the
map tasks, so that a group of any size sends one row a task. Rows then find their class by the hash alone; only under a
hash that different texts share do they find it by text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patrimonia.llm.store import save

#: Runs of these become one space before texts are compared.
BLANKS = r"[\x20\x09-\x0D]+"


def hash_128(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def exact_duplicates(docs: DataFrame, hashed: Callable[[Column], Column] = hash_128) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs(doc_id, text)``.

    Texts are equal when they are identical after each run of blanks became one space; a null text counts as empty, so
    that all nulls and empties are copies of each other. The smallest doc_id of equal texts stays; a null doc_id is
    larger than all others, and where a group has no other, keep_id is null and the row stays. Rows that repeat a doc_id
    with an equal text are the same document: each counts in group_size, and all have the same ``kept``. An empty table
    gives an empty result. Further columns play no part, whatever their names. ``hashed`` only finds candidates: a weak
    one costs time, not right results.
    """
    text = F.regexp_replace(F.coalesce("text", F.lit("")), BLANKS, " ")
    whole = docs.select("doc_id", text.alias("text")).withColumn("hash", hashed(F.col("text")))
    classes = save(whole.groupBy("hash", "text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")).select("hash", "keep_id", "group_size"), "classes")
    found = classes.groupBy("hash").agg(F.count("*").alias("texts"), F.first("keep_id").alias("keep_id"), F.first("group_size").alias("group_size"))
    # a hash without copies needs no partner: its row stays by itself
    copies = found.where("texts = 1 AND group_size > 1").select("hash", "keep_id", "group_size")
    shared = found.where("texts > 1").select("hash")
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    narrow = whole.select("doc_id", "hash", digest)
    if shared.isEmpty():
        parts = [narrow.join(copies, "hash", "left")]
    else:
        mixed = whole.join(shared, "hash", "left_semi")
        inside = mixed.groupBy("hash", "text").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        parts = [narrow.join(shared, "hash", "left_anti").join(copies, "hash", "left"), mixed.join(inside, ["hash", "text"]).select("hash", "doc_id", digest, "keep_id", "group_size")]
    out = []
    for part in parts:
        size = F.coalesce("group_size", F.lit(1)).cast("long")
        keep = F.when(F.isnull("group_size"), F.col("doc_id")).otherwise(F.col("keep_id"))
        out.append(part.select("doc_id", keep.alias("keep_id"), size.alias("group_size"), F.equal_null("doc_id", keep).alias("kept"), "text_sha256"))
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])
