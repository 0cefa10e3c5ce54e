"""Names by trigrams: the most similar ones within a scope, and those that contain a name.

Similarity is the Jaccard coefficient of the names' padded trigrams. Under one order of a scope's
trigrams, rare ones first, two sets that reach ``least`` share one of their first
|S| - ceil(least |S|) + 1, so only names that meet there are compared; those whose sizes rule
``least`` out are not. Containment asks for one trigram only, the rarest of the name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import let, normalize

#: Similarity from which names count as alike, unless a caller says otherwise.
LEAST = 0.3


def trigrams(col: Column) -> Column:
    """The distinct trigrams of the normalised name with two blanks before and one behind."""
    padded = F.concat(F.lit("  "), normalize(col), F.lit(" "))
    return let(padded, lambda p: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3)))))


def grams(col: Column, n: int) -> Column:
    """The distinct substrings of ``n`` characters of the normalised name."""
    return let(normalize(col), lambda p: F.array_distinct(F.transform(F.when(F.length(p) >= n, F.sequence(F.lit(1), F.length(p) - n + 1)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(p, i, F.lit(n)))))


def similar(asked: DataFrame, held: DataFrame, *, scope: tuple[str, ...] = (), name: str = "name", least: float = LEAST) -> DataFrame:
    """``scope``, ``name`` (asked), ``found`` (held), similarity: all pairs of distinct names of a scope that reach ``least``; null names have none."""
    key = [*scope, "name"]
    rows = lambda df: df.where(F.col(name).isNotNull()).select(*scope, F.col(name).alias("name")).distinct().withColumn("grams", trigrams(F.col("name")))
    a, h = rows(asked), rows(held)
    often = h.select(*scope, F.explode("grams").alias("g")).groupBy(*scope, "g").agg(F.count("*").alias("df"))

    def prefix(df: DataFrame, side: str) -> DataFrame:
        items = df.select(*key, F.size("grams").alias("n"), F.explode("grams").alias("g"))
        # Trigrams that no held name has come first: they only shorten what is left.
        met = items.join(often, [*scope, "g"], "left").withColumn("df", F.coalesce("df", F.lit(0)))
        rank = F.row_number().over(Window.partitionBy(*key).orderBy("df", "g"))
        kept = met.withColumn("rank", rank).where((F.col("df") > 0) & (F.col("rank") <= F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9) + 1))
        return kept.select(*scope, "g", F.col("name").alias(side), F.col("n").alias(f"n_{side}"))

    fits = F.least("n_asked", "n_found") >= F.lit(least) * F.greatest("n_asked", "n_found") - 1e-9
    near = prefix(a, "asked").join(prefix(h, "found"), [*scope, "g"]).where(fits).select(*scope, "asked", "found").distinct()
    side = lambda df, to: df.select(*scope, F.col("name").alias(to), F.col("grams").alias(f"g_{to}"))
    both = near.join(side(a, "asked"), [*scope, "asked"]).join(side(h, "found"), [*scope, "found"])
    common = F.size(F.array_intersect("g_asked", "g_found"))
    return both.select(*scope, F.col("asked").alias("name"), "found", (common / (F.size("g_asked") + F.size("g_found") - common)).alias("similarity")).where(F.col("similarity") >= least)


def containing(asked: DataFrame, held: DataFrame, *, scope: tuple[str, ...] = (), name: str = "name") -> DataFrame:
    """``scope``, ``name`` (asked), ``found``: the held names that contain an asked one, both normalised; a blank name is in none.

    Names of one or two characters look up substrings of their own length.
    """
    rows = lambda df: df.where(F.length(F.trim(normalize(F.col(name)))) > 0).select(*scope, F.col(name).alias("name")).distinct()
    h = rows(held)
    post = h.select(*scope, F.col("name").alias("found"), F.explode(F.concat(*(grams(F.col("name"), n) for n in (1, 2, 3)))).alias("g"))
    often = post.groupBy(*scope, "g").agg(F.count("*").alias("df"))
    size = F.least(F.length(normalize(F.col("name"))), F.lit(3))
    own = rows(asked).withColumn("g", F.explode(F.when(size == 1, grams(F.col("name"), 1)).when(size == 2, grams(F.col("name"), 2)).otherwise(grams(F.col("name"), 3))))
    # A trigram that no held name has rules the name out; else its rarest one leads to all that may contain it.
    rarest = own.join(often, [*scope, "g"], "left").groupBy(*scope, "name").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "g")).alias("r")).where("r.df > 0")
    met = rarest.select(*scope, "name", F.col("r.g").alias("g")).join(post, [*scope, "g"])
    return met.where(F.contains(normalize(F.col("found")), normalize(F.col("name")))).select(*scope, "name", "found")
