"""Gazetteer dumps: tab-separated files of 19 columns without a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns of the public dump that are kept, by position.
COLUMNS = {0: "entry_id", 1: "name", 2: "asciiname", 4: "lat", 5: "lon", 6: "feature_class", 7: "feature_code", 8: "country_code", 10: "admin1_code", 14: "population"}


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """Administrative areas (A) and populated places (P) as text columns; lines of fewer than 15 fields are left out."""
    parts = spark.read.text(path).select(F.split("value", "\t").alias("p")).where(F.size("p") >= 15)
    rows = parts.select(*(F.col("p")[i].alias(n) for i, n in COLUMNS.items()))
    return rows.where(F.col("feature_class").isin("A", "P"))


def typed(rows: DataFrame) -> DataFrame:
    """Numbers as such; rows whose id, coordinates or population are none are left out, but an empty population is 0."""
    number = {"entry_id": "long", "lat": "double", "lon": "double"}
    out = rows.withColumn("population", F.when(F.trim(F.coalesce("population", F.lit(""))) == "", F.lit(0).cast("long")).otherwise(F.expr("try_cast(population AS long)")))
    out = out.withColumns({c: F.expr(f"try_cast({c} AS {k})") for c, k in number.items()})
    return out.dropna(subset=["entry_id", "lat", "lon", "population"])


def write_table(rows: DataFrame, path: str) -> None:
    """The kept columns as tab-separated text with a header."""
    rows.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    schema = ", ".join(f"{n} string" for n in COLUMNS.values())
    return typed(spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path))
