"""Attributes as VARIANT: objects of any shape, of which a merge keeps the best value of every name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attribute_rows(rows: DataFrame, col: str = "attributes") -> DataFrame:
    """The columns of ``rows`` but ``col``, with name and value (JSON text) for each attribute that is not null.

    ``col`` is a VARIANT or JSON text; text that is no JSON, and values that are no objects, have no attributes.
    """
    kind = dict(rows.dtypes)[col]
    made = F.col(col) if kind == "variant" else F.try_parse_json(F.col(col).cast("string"))
    given = rows.select(F.struct(*(F.col(c) for c in rows.columns if c != col)).alias("_row"), made.alias("_object")).where("schema_of_variant(_object) LIKE 'OBJECT%'")
    each = given.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("_object").outer())).where(~F.is_variant_null("value"))
    return each.select("_row.*", F.col("key").alias("name"), F.to_json("value").alias("value"))


def best_attributes(rows: DataFrame, keys: list[str], order: Column, col: str = "attributes") -> DataFrame:
    """``keys`` and ``attributes``, a VARIANT object: of every name the value of the row that is least by ``order``.

    Keys without an attribute have no row. Names are those that a schema allows: few a key.
    """
    found = attribute_rows(rows.withColumn("_order", order), col)
    best = found.groupBy(*keys, "name").agg(F.min_by("value", "_order").alias("value"))
    pair = F.concat(F.substring(F.to_json(F.array("name")), F.lit(2), F.length(F.to_json(F.array("name"))) - 2), F.lit(":"), "value")
    whole = F.concat(F.lit("{"), F.array_join(F.array_sort(F.collect_list(pair)), ","), F.lit("}"))
    return best.groupBy(*keys).agg(F.parse_json(whole).alias("attributes"))
