"""What the operators of this subpackage share: words, shared folders, Arrow batches."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import shared_folder

#: A word: a run of characters other than the space and U+0009 to U+000D.
#: ``bytes.split()`` without arguments splits UTF-8 at exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 2000, mb: int = 8) -> None:
    """Bound what one Arrow batch brings into a Python worker, in rows and in bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mb << 20))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the folder that driver and executors share."""
    return shared_folder(spark, name)


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: ends the lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_skewed(rows: DataFrame, marks: DataFrame, key: str, size: str, total: int, how: str = "inner", share: int = 1000) -> DataFrame:
    """``rows``, ``total`` of them, with the row of ``marks`` (one a key) of their key; ``size``, at most the key's number of rows, goes.

    A key of over one in ``share`` of all rows is dealt to as many tasks as make shares of that
    size; there can be no more than ``share`` such keys, which all tasks are told.
    """
    marks, least = cut(marks, "marks"), max(1, total // share)
    hot = marks.where(F.col(size) > least).select(key, F.ceil(F.col(size) / least).cast("int").alias("_parts"))
    if hot.isEmpty():
        return rows.join(marks.drop(size), key, how)
    cold = marks.join(F.broadcast(hot), key, "left").drop(size).withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    told = rows.join(F.broadcast(hot), key, "left")
    part = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64(*rows.columns), F.col("_parts"))).otherwise(0).cast("int")
    return told.withColumn("_part", part).drop("_parts").join(cold, [key, "_part"], how).drop("_part")


def tidy(run: Callable) -> Callable:
    """A function of ``mapInArrow`` after which the worker, which Spark uses again, returns freed memory to the system."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def release() -> None:
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


#: glibc's numbers of the two settings, their default in bytes, and bytes that ``roomy`` keeps.
TRIM, MAPPED, USUAL, ROOM = -1, -3, 128 << 10, 32 << 20


def roomy(run: Callable) -> Callable:
    """As ``tidy``, for work on arrays that come and go: till its end the worker keeps freed memory, which else the system clears anew for each."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_freed(ROOM)
        try:
            yield from run(batches)
        finally:
            keep_freed(USUAL)

    return tidy(kept)


def keep_freed(size: int) -> None:
    if mallopt := getattr(ctypes.CDLL(None), "mallopt", None):
        mallopt(TRIM, 2 * size)
        mallopt(MAPPED, size)


def word_count(col: Column) -> Column:
    """Words of a text column, 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file; ``LEXMILL_TOKENIZERS`` names another folder."""
    folder = os.environ.get("LEXMILL_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
