"""A training corpus from ``documents``: language, near duplicates, benchmark passages, mix, shards.

Each stage takes (spark, docs, sf_dir) and returns what it keeps of ``docs``; the last returns the placement.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patrimonia.llm.decontaminate import contaminated
from patrimonia.llm.langid import predict_language
from patrimonia.llm.mixing import DOMAINS, domain_of, mix
from patrimonia.llm.neardup import near_duplicates
from patrimonia.llm.sharding import shard_documents
from patrimonia.llm.store import save

#: The mixing stage's shares of tokens. Good documents have none: they keep the tokens that they have, and make up the rest.
MIX = {"low": 0.14, "toxic": 0.0}


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with the calibrated confidence.

    Null, empty and letterless texts have no language and go. Null doc_ids, repeated rows and ties are judged by their
    text, each row for itself. An empty table stays empty. Further columns are kept as they are, whatever their names.
    """
    judged = predict_language(docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text", "lang"))
    return judged.where("not rejected").select("row.*")


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a hash of the whole row that equal rows share, and its name, which no column has: decisions travel by it, and not by doc_id."""
    key = "key_of_row"
    while key in {c.lower() for c in docs.columns}:
        key += "_"
    return docs.withColumn(key, F.xxhash64(*docs.columns, *(F.isnull(c) for c in docs.columns))), key


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest doc_id (null last) of each group of similarity 0.8, once; equal rows count as one.

    Of rows that share that doc_id the one of smallest row hash stays. Null, empty and wordless texts are like no other
    and stay. An empty table stays empty. Further columns are kept, whatever their names.
    """
    rows, key = keyed(docs)
    groups = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text"), percent=80)
    groups = groups.select(F.col("doc_id").alias("node"), "component_id").distinct()
    first = F.min(F.struct(F.isnull("doc_id").alias("last"), "doc_id", "node"))
    kept = rows.select(F.col(key).alias("node"), "doc_id").distinct().join(groups, "node").groupBy("component_id").agg(first.alias("first"))
    kept = save(kept.select(F.col("first.node").alias(key)), "kept")
    return rows.join(kept, key, "left_semi").dropDuplicates([key]).select(*docs.columns)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none and stay, as do all with an empty benchmark. Null and shared doc_ids and repeated
    rows are judged by their own text. An empty table stays empty. Further columns are kept, whatever their names.
    """
    rows, key = keyed(docs)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = contaminated(rows.select(F.col(key).alias("doc_id"), "text"), items)
    found = save(found.select(F.col("doc_id").alias(key)).distinct(), "contaminated")
    return rows.join(found, key, "left_anti").select(*docs.columns)


def shares(labels: DataFrame) -> dict[str, float]:
    """MIX where ``labels`` tell good from low documents; else there is no share to hold, and only what is unwanted goes."""
    named = {DOMAINS[r[0]] for r in labels.select(domain_of(F.col("toxic"), F.col("quality"))).distinct().collect() if r[0] is not None}
    return MIX if {"good", "low"} <= named else {d: x for d, x in MIX.items() if x == 0}


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of a document as its rate says: its whole part, and one more with the chance that is left.

    That chance is drawn by the row's hash, so that a run gives the same copies again, and the copies' tokens come to
    the shares in MIX as the rates' do, the nearer the more documents there are. A rate of 1 is one copy.
    Toxic documents go at every share. A label counts for every row of its doc_id; null doc_ids have none. Equal rows
    have as many copies each. Null and empty texts have no tokens and are judged by their posterior alone. Without labels
    of good and of low documents all stay that aren't toxic. An empty table stays empty. Further columns are kept,
    whatever their names.
    """
    rows, key = keyed(docs)
    known = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic").distinct()
    labels = rows.select(F.col(key).alias("node"), "doc_id").distinct().join(known, "doc_id").select(F.col("node").alias("doc_id"), "quality", "toxic")
    labels = save(labels, "labels")
    rates = mix(rows.select(F.col(key).alias("doc_id"), "text"), labels, shares(labels)).groupBy("doc_id").agg(F.max("rate").alias("rate"))
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("copies")), F.lit(2**32)) / F.lit(2.0**32)  # in [0, 1)
    copies = rates.select(F.col("doc_id").alias(key), F.floor(F.col("rate") + drawn).cast("int").alias("copies")).where("copies >= 1")
    own = F.struct(*docs.columns).alias("row")
    mixed = rows.select(key, own).join(copies, key)
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document; null texts and doc_ids and repeated rows are placed like others."""
    return shard_documents(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]

#: SQL can't express the first two stages over whole tables; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's rows written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
