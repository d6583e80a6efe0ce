"""Shared plumbing of the text operators.

Every operator starts from ``id_text``: only the key and the text go through
shuffles, under fixed names, so other columns of the caller cannot clash.
"""

from __future__ import annotations

import ctypes
import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from splice_spark.functions import lineage

#: A-Z to a-z, every other byte unchanged.
LOWER = bytes(range(256)).lower()


# Python workers live on from stage to stage; what they free should go back to the machine.
pa.set_memory_pool(pa.system_memory_pool())


@functools.cache
def _trim() -> Callable:
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0)


def give_back() -> None:
    """Return freed memory of this process to the machine."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def trimmed(run: Callable) -> Callable:
    """``run`` over batches, giving freed memory back when its task is done."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


#: Rows and bytes of an Arrow batch: texts are long, and both the JVM and Python hold whole batches.
BATCH_ROWS, BATCH_BYTES = 512, 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` and ``BATCH_BYTES``, where they are larger."""
    rows, size = (f"spark.sql.execution.arrow.max{what}PerBatch" for what in ("Records", "Bytes"))
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    if not spark.conf.get(size).removesuffix("b").isdigit() or int(spark.conf.get(size).removesuffix("b")) > BATCH_BYTES:
        spark.conf.set(size, BATCH_BYTES)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id bigint, text string`` of ``docs``, whatever else it has.  Arrow batches of the session become small."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: A name that no caller's column has.
ROW = "__row_number__"


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number for each row, which holds for one scan only: splits of files follow the cores at hand, so ``cut`` it before a second use."""
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` (numbered) without the numbers in ``gone``, which is written first, so that its size decides on the join."""
    return docs.join(cut(gone.select(ROW)), ROW, "left_anti").drop(ROW)


def total_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts: one aggregate, from which blocks and buckets are sized."""
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def parts_for(spark: SparkSession, n_bytes: int, each: int = 64 << 20) -> int:
    """Shuffle partitions: what the session says, or more if partitions would exceed ``each`` bytes."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_bytes / each))


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read again: short lineage, one evaluation."""
    return lineage.cut(df, "zstd")


def cut_long(df: DataFrame, group_rows: int = 4) -> DataFrame:
    """``cut`` for rows of megabytes: row groups of ``group_rows`` rows.

    Parquet's writer holds 100 rows or more else, whatever their size, and the reader of arrays a row group of up to 4,096 rows.
    """
    return lineage.cut(df, "zstd", **{"parquet.block.row.count.limit": group_rows})


def join_counted(left: DataFrame, right: DataFrame, key: str, share: int = 256) -> DataFrame:
    """Inner join with ``right``, which has one row a key and, in ``n``, the rows that ``left`` has of it (left out of the result).

    Keys with one in ``share`` rows of ``left`` or more, of which there can be ``share`` at most, are joined by
    broadcast where their rows are; only the others are shuffled, so no task gets the rows of a hot key.
    """
    right = cut(right)
    least = (right.agg(F.sum("n")).first()[0] or 0) / share
    hot, others = right.filter(F.col("n") >= least).drop("n"), right.filter(F.col("n") < least).drop("n")
    cold = left.join(F.broadcast(hot.select(key)), key, "left_anti")
    return left.join(F.broadcast(hot), key).unionByName(cold.join(others, key))


def squeeze(data: bytes, level: int = 1) -> bytes:
    return zstandard.ZstdCompressor(level=level).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def ids_and_bytes(batch: pa.RecordBatch) -> tuple[list, list]:
    """``doc_id`` and UTF-8 text (None for null) of a batch of ``id_text``."""
    return batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()


def doc_chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list]]:
    """Consecutive documents of a partition in groups of about ``size`` bytes; a document is never split."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, t in zip(*ids_and_bytes(batch), strict=True):
            ids.append(i)
            texts.append(t)
            held += 16 + len(t or b"")
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def binary(values: list) -> pa.Array:
    """A binary column; values of over 2 GB in sum don't occur, as chunks bound them."""
    return pa.array(values, pa.binary())


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def unbits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).view(bool)
