"""Vector functions on ``array<float>`` columns, summed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector has no length."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


def agreement(a: Column, b: Column) -> Column:
    """Share of equal places of two signatures; 0 where one is empty or their sizes differ."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))
    return F.when((F.size(a) == F.size(b)) & (F.size(a) > 0), same / F.size(a)).otherwise(0.0)
