"""Tables that cut lineage: Parquet in the folder that every machine of the cluster shares."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset (tests), one of our own, set for the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        folder = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """Session settings for the actions inside."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def save(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it again, so that a lost executor costs no recomputation.

    The shuffle files of the write go with its end: the table stands for them. Inside ``scratch`` the table goes with the
    end of the block; with ``keep`` it goes with the block around that one, if any.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"
    with settings(spark, _CLEANED):
        df.write.parquet(path)
    owners = _open[:-1] if keep else _open
    if owners:
        owners[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


#: The paths of the tables that each open ``scratch`` block has to delete.
_open: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``save`` writes inside are deleted at the end; what leaves the block is saved last, with ``keep``."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def drop(df: DataFrame) -> None:
    """Delete the files of a table that ``save`` wrote and that no later plan reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, folder)
