"""Collections: pruned, filtered scans and the newest rows of one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, **equal) -> DataFrame:
    """The columns of the rows whose named columns equal the values; both reach the Parquet scan."""
    rows = spark.read.parquet(path)
    for name, value in equal.items():
        rows = rows.where(F.col(name) == F.lit(value))
    return rows.select(*columns) if columns else rows


def newest(rows: DataFrame, n: int = 5000, by: str = "date", tie: str = "id") -> DataFrame:
    """The ``n`` newest rows: a bounded window is the feature here."""
    return rows.orderBy(F.desc(by), tie).limit(n)


def json_cases(spark: SparkSession, path: str) -> DataFrame:
    """A file that holds one JSON array of cases."""
    return spark.read.option("multiLine", True).json(path)


def upsert_partitions(rows: DataFrame, path: str, key: str = "doc_id", buckets: int = 64) -> None:
    """Replace the rows of the documents in ``rows`` in a table partitioned by a bucket of its key; running again changes nothing."""
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    new = rows.withColumn("bucket", bucket)
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
        touched = new.select("bucket").distinct()
        old = spark.read.parquet(path).join(touched, "bucket", "left_semi").join(new.select(key).distinct(), key, "left_anti")
        from ..shared import written

        new = written(old.select(*new.columns).unionByName(new), "upsert")
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
