"""Tables that cut lineage, also in folders by a column, and runtime filters for joins that read whole texts."""

from __future__ import annotations

import uuid
from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession

from patrimonia.sources.store import drop, save, settings, shared_folder

__all__ = ["drop", "pruning", "save", "save_by", "shared_folder"]

_BLOOM = "spark.sql.optimizer.runtime.bloomFilter."


def pruning(spark: SparkSession) -> AbstractContextManager[None]:
    """Actions inside let Spark's runtime Bloom filters (4 MB, whatever the tables' sizes) keep rows without a partner from a join's shuffle.

    The side that makes the filter needs a condition; a filter that has filled up lets rows pass and loses none.
    """
    return settings(spark, {_BLOOM + "applicationSideScanSizeThreshold": "0", _BLOOM + "expectedNumItems": "4000000", _BLOOM + "numBits": str(1 << 25)})


def save_by(df: DataFrame, name: str, by: str) -> DataFrame:
    """``save`` with a folder for each value of ``by``, which later filters and joins on it skip.

    Rows keep the tasks that they are in, so that a value that many rows share is written by many tasks.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"
    with settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.partitionBy(by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
