"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patrimonia.llm.decontaminate import contaminated
from patrimonia.llm.exactdup import exact_duplicates
from patrimonia.llm.langid import predict_language
from patrimonia.llm.lexical import ranked_search
from patrimonia.llm.licenses import license_spans
from patrimonia.llm.linedup import line_duplicates
from patrimonia.llm.maxscore import top_k
from patrimonia.llm.merkle import merkle_manifest
from patrimonia.llm.mixing import mix
from patrimonia.llm.neardup import near_duplicates
from patrimonia.llm.pii import personal_data
from patrimonia.llm.sharding import shard_documents
from patrimonia.llm.urlrules import judge_urls


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_spans(_read(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    return predict_language(docs).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_read(spark, sf_dir, "embeddings"))


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_read(spark, sf_dir, "pages"), _read(spark, sf_dir, "labels"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_read(spark, sf_dir, "documents"))


def op8_line_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_duplicates(_read(spark, sf_dir, "documents")).withColumn("removed", F.array_join("removed", ","))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(_read(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op12_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_read(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    told = merkle_manifest(_read(spark, sf_dir, "documents"), claims={"text": F.when(chosen, lowered).otherwise(F.col("text"))}, proofs=False)
    return told.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Each operator over its whole table."""
    return {
        f.__name__: f
        for f in (
            op1_decontaminate, op2_licenses, op3_language, op4_near_duplicates, op5_top_k,
            op6_url_rules, op7_sharding, op8_line_duplicates, op9_mixing, op10_personal_data, op11_ranked_search, op12_exact_duplicates, op13_merkle_manifest,
        )
    }
