"""The registered queries of the disclosure jobs, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from patrimonia.jobs import function_queries, order_queries, summary_queries, text_queries

_PARTS = (function_queries, text_queries, order_queries, summary_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for part in _PARTS for k, v in part.queries().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for part in _PARTS for k, v in part.oracle_sql().items()}
