"""Incremental ingestion with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import article_parts, first_parts, of_parts
from ..shared import shared_folder


def ingest(stream: DataFrame, folder: str, key: str = "text_key") -> None:
    """Merge a stream of articles (key, ord, source, url, date) into the index below ``folder``.

    Each micro-batch is merged within itself and written as a version of its own; a batch that
    is run again overwrites its version. So a batch costs what it holds, however large the
    index is, and ``latest`` merges the versions.
    """

    def merge(batch: DataFrame, number: int) -> None:
        article_parts(batch, key).write.mode("overwrite").parquet(f"{folder}/version={number}")

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", f"{folder}/_checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def latest(spark: SparkSession, folder: str, key: str = "text_key") -> DataFrame:
    """The index: all versions merged; sources and urls stand by ``ord``, in whatever order the batches came."""
    return of_parts(first_parts(spark.read.parquet(folder), key), key)


def as_pattern(path: str) -> str:
    """The same path as a pattern: a file stream takes a single file only so."""
    return f"{path[:-1]}[{path[-1]}]"


def ingest_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` streamed into an index."""
    from ..plans.catalogue import articles_of

    path = f"{sf_dir}/documents.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 4).parquet(as_pattern(path))
    folder = shared_folder(spark, "articles")
    ingest(articles_of(stream), folder)
    return latest(spark, folder)


def distinct_events(spark: SparkSession, sf_dir: str, *, late: str = "60 days") -> DataFrame:
    """``events`` streamed through a watermarked de-duplication by user, type and properties."""
    path = f"{sf_dir}/events.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(as_pattern(path))
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    out = shared_folder(spark, "events")
    kept = timed.dropDuplicatesWithinWatermark(["user_id", "event_type", "props"]).select("user_id", "event_type", "props")
    kept.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(kept.schema).parquet(f"{out}/rows")
