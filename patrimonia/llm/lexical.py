"""Ranked lexical search: postings in buckets of terms, integer scores by joins and sums, the best by a window.

Documents are read once. Their words are kept where the items use them, counted by document and written as postings in
folders by the term's bucket, so that a search reads the buckets of its terms only. For scoring, a document's postings
lie in one task: each match adds to its item and document there, and a window keeps the best of each task before tasks
exchange anything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patrimonia.llm.store import save, save_by

#: ASCII letters and digits and all other characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Folders that the postings lie in.
BUCKETS = 16
#: Rows of item terms (some 60 bytes each) that are sent to every task; more are joined by shuffling.
SENT_TERMS = 400_000
_BIG = "decimal(38,0)"


def terms(text: Column) -> Column:
    """The terms of a text in their order, A-Z lower-cased."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(lower, F.lit(TERM), F.lit(0))


def _sent(rows: DataFrame, n: int) -> DataFrame:
    return F.broadcast(rows) if n <= SENT_TERMS else rows


def build_postings(docs: DataFrame, wanted: DataFrame, n_wanted: int) -> DataFrame:
    """(bucket, term, row, doc_id, n, tf, head): how often each document holds each term of ``wanted(term)``, with its number of terms n.

    A document's first term is kept even if not wanted, as a posting of a null term: ``head`` marks one row of each
    document, so that documents and their lengths can be counted here. Each row of ``docs`` is a document of its own.
    """
    split = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", terms(F.col("text")).alias("terms"))
    words = split.select("row", "doc_id", F.size("terms").cast("long").alias("n"), F.posexplode("terms").alias("at", "word"))
    known = words.join(_sent(wanted, n_wanted), F.col("word") == F.col("term"), "left").where("at = 0 OR term IS NOT NULL")
    counted = known.groupBy("row", "doc_id", "n", "term").agg(F.count("*").alias("tf"), F.max(F.col("at") == 0).alias("head"))
    bucket = F.coalesce(F.pmod(F.xxhash64("term"), F.lit(BUCKETS)), F.lit(-1)).cast("int")
    return save_by(counted.withColumn("bucket", bucket), "postings", "bucket")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 for each item.

    ``docs(doc_id, text)``, ``items(item_id, text)``; other columns play no part, whatever their names. With N documents
    that have a term, L terms in all, n in one document, df documents that hold a term and tf occurrences in one: a term
    weighs w = floor(1000 * ln((2N + 2) / (2df + 1))), a document's m is 25 + (75 * n * N) div L, and an item's score is
    the sum of w * ((10**9 * tf) div (1000 * tf + 8 * m)) over its terms, repeats included. Equal scores are ordered by
    doc_id (null last). Null, empty and termless texts match nothing and don't count in N. Rows that share an item_id are
    one item, whose terms add up; each row of ``docs`` is a document, and rows that share a doc_id take a rank each. Empty
    tables give an empty result. The product of n and N is taken in decimals, as it may pass 64 bits.
    """
    asked = items.select("item_id", F.explode(terms(F.col("text"))).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("times"))
    asked = save(asked, "asked")
    n_asked = asked.count()
    postings = build_postings(docs, asked.select("term").distinct(), n_asked)
    documents, length = postings.where("head").agg(F.count("*"), F.sum(F.col("n").cast(_BIG))).first()
    long_enough = F.lit(max(int(length or 0), 1)).cast(_BIG)
    own = F.call_function("div", (F.col("n").cast(_BIG) * 75 * F.lit(documents).cast(_BIG)), long_enough).cast("long") + 25
    part = F.call_function("div", F.col("tf") * 1_000_000_000, F.col("tf") * 1000 + own * 8)
    known = postings.where("term IS NOT NULL")
    weight = F.floor(1000 * F.ln(F.lit(2.0 * documents + 2) / (2 * F.count("*") + 1))).cast("long")
    weights = known.groupBy("term").agg(weight.alias("weight"))
    scale = asked.join(weights, "term").select("term", "item_id", (F.col("times") * F.col("weight")).alias("weight"))
    scored = known.select("term", "row", "doc_id", part.alias("part")).repartition("row").join(_sent(scale, n_asked), "term")
    total = scored.groupBy("item_id", "row", "doc_id").agg(F.sum(F.col("weight") * F.col("part")).alias("score")).where("score > 0")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return total.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
