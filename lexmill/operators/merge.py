"""Merging articles into an index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def article_parts(articles: DataFrame, key: str) -> DataFrame:
    """The different sources and urls of each key as rows: kind, value, the first ``ord`` and the oldest date. Parts of parts are merged by ``first_parts``."""
    part = lambda c: F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value"))
    return first_parts(articles.select(key, "ord", "date", F.explode(F.array(part("source"), part("url"))).alias("part")).select(key, "part.*", "ord", "date"), key)


def first_parts(parts: DataFrame, key: str) -> DataFrame:
    # Repeated values fold map-side, so a text that many rows share sends its distinct ones only.
    return parts.groupBy(key, "kind", "value").agg(F.min("ord").alias("ord"), F.min("date").alias("date"))


def of_parts(parts: DataFrame, key: str) -> DataFrame:
    """The articles that ``first_parts`` are of."""
    ordered = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == c, F.struct("ord", "value")))), lambda x: x["value"]).alias(f"{c}s")
    return parts.groupBy(key).agg(F.min("ord").alias("ord"), ordered("source"), ordered("url"), F.min("date").alias("date"))


def merge_articles(articles: DataFrame, key: str) -> DataFrame:
    """Articles (ord, source, url, date) of the same key as one: sources and urls distinct in order, the oldest date, the first ``ord``.

    The result is the same whatever the order of arrival, so late articles do no harm.
    """
    return of_parts(article_parts(articles, key), key)


def merge_turns(rows: DataFrame, key: str) -> DataFrame:
    """Merged articles of several turns as one row a key: what an earlier ``turn`` has comes first."""
    joined = lambda c: F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("turn", c))), lambda x: x[c]))).alias(c)
    return rows.groupBy(key).agg(F.min("ord").alias("ord"), joined("sources"), joined("urls"), F.min("date").alias("date"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Merged articles of an index and of a batch: what both have is merged, the index's first."""
    at = lambda df, turn: df.select(key, "ord", "sources", "urls", "date", F.lit(turn).alias("turn"))
    return merge_turns(at(old, 0).unionByName(at(new, 1)), key)
