"""Cutting of lineage at intermediate results that several steps read."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the cluster (``spark.checkpoint.dir``); on a local master without one, one of our own."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="spark-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    own = f"{folder.rstrip('/')}/{sc.applicationId}"
    if own not in _own:
        _own.add(own)
        atexit.register(_leave, spark._jvm.org.apache.hadoop.fs.Path(own), spark._jsparkSession.sessionState().newHadoopConf())
    return own


_own: set[str] = set()
_written: list[str] = []
_named: dict[str, str] = {}


def _leave(path, conf) -> None:
    """Delete the application's own folder when the driver ends: nothing else reads it.  A driver that is killed leaves it."""
    with suppress(Exception):  # the JVM may be gone
        path.getFileSystem(conf).delete(path, True)


def cut(df: DataFrame, compression: str = "snappy", **options: str | int) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: computed once, and safe from lost executors.  ``options`` go to the writer."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.options(compression=compression, **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Of cell rows, which are most of what is written; other tables are small, or texts.
CELL_ROWS = "zstd"


def cut_buckets(df: DataFrame, n: int, keys: list[str]) -> DataFrame:
    """``cut`` of rows dealt by ``keys`` to ``n`` partitions, as a table of so many buckets, which later steps needn't shuffle by these keys."""
    spark, name = df.sparkSession, f"table_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    _written.append(path)
    df.write.bucketBy(n, *keys).option("path", path).option("compression", CELL_ROWS).saveAsTable(name)
    _named.setdefault(path, name)
    return spark.table(name)


def delete(spark: SparkSession, *paths: str) -> None:
    """Delete folders of any file system that Spark knows."""
    for path in paths:
        if path in _named:
            spark.sql(f"DROP TABLE IF EXISTS {_named.pop(path)}")
        found = spark._jvm.org.apache.hadoop.fs.Path(path)
        found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(found, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what ``cut`` writes inside; the results must be stored elsewhere by then."""
    before = len(_written)
    try:
        yield
    finally:
        delete(spark, *_written[before:])
        del _written[before:]
