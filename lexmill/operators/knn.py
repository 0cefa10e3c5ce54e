"""Nearest neighbours by cosine, and what is decided from them.

Queries and rows are dealt into blocks of bounded size; every pair of blocks is a tile that
one task multiplies as two matrices and from which it passes on ``k`` rows a query. So the
result is exact, and a task holds two blocks whatever the input's size.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.sql.window import Window

from .graph import connected_components

BLOCK = 8192
#: Queries of a tile that are multiplied at once.
SLICE = 256
MATCH, ITEM_LOW, MERGE, CORPUS_LOW, TOP_K = 0.92, 0.75, 0.92, 0.80, 10


def leaders(score: np.ndarray, k: int) -> np.ndarray:
    """The places of each row's ``k`` greatest scores, in order, the first of equals; as a stable sort gives them."""
    n = score.shape[1]
    if n <= 4 * k:
        return np.argsort(-score, axis=1, kind="stable")[:, :k]
    least = np.partition(score, n - k, axis=1)[:, n - k]
    row, place = np.nonzero(score >= least[:, None])
    order = np.lexsort((place, -score[row, place], row))
    starts = np.searchsorted(row, np.arange(len(score)))  # each row has ``k`` of them at least
    return place[order][starts[:, None] + np.arange(k)]


def nearest(queries: DataFrame, rows: DataFrame, *, k: int = TOP_K, id_col: str = "id", vector_col: str = "vector", type_col: str | None = None, block: int = BLOCK, digits: int = 6) -> DataFrame:
    """query_id, id, score, rank: for every query its ``k`` best rows, itself included, ties by id.

    With ``type_col`` only rows of the query's type count. Scores are cosines rounded to
    ``digits``; vectors without length, null or of another size than the query's are left out.
    """
    kind = F.col(type_col).cast("string") if type_col else F.lit("")
    # Single-precision vectors travel as they are and are multiplied in double precision.
    single = all(df.schema[vector_col].dataType == ArrayType(FloatType(), df.schema[vector_col].dataType.containsNull) for df in (queries, rows))
    number = "array<float>" if single else "array<double>"
    shape = lambda df: df.where(F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(number).alias("vector"), kind.alias("kind"))
    q, r = shape(queries), shape(rows)
    # Two counts fix how many blocks there are.
    blocks = lambda df: max(1, -(-df.count() // block))
    nq, nr = blocks(q), blocks(r)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.withColumns({"i": F.pmod(F.xxhash64("id"), F.lit(nq)).cast("int"), "role": F.lit(0)}).withColumn("j", every(nr))
    r = r.withColumns({"j": F.pmod(F.xxhash64("id"), F.lit(nr)).cast("int"), "role": F.lit(1)}).withColumn("i", every(nq))

    def tile(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, size), part in pdf.groupby(["kind", pdf["vector"].map(len)]):
            a, b = part[part["role"] == 0], part[part["role"] == 1].sort_values("id")
            if not len(a) or not len(b) or not size:
                continue
            unit = lambda p: (m := np.stack(p["vector"].to_numpy()).astype(np.float64)) / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
            live = lambda p: p[p["vector"].map(lambda v: bool(np.any(v)))]
            a, b = live(a), live(b)
            if not len(a) or not len(b):
                continue
            x, y, a_ids, b_ids = unit(a), unit(b).T, a["id"].to_numpy(), b["id"].to_numpy()
            for at in range(0, len(x), SLICE):
                score = np.round(x[at : at + SLICE] @ y, digits)
                best = leaders(score, k)
                out.append(pd.DataFrame({"query_id": np.repeat(a_ids[at : at + SLICE], best.shape[1]), "id": b_ids[best].ravel(), "score": np.take_along_axis(score, best, 1).ravel()}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": pd.Series(dtype="int64"), "id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})

    found = q.unionByName(r).groupBy("i", "j").applyInPandas(tile, "query_id long, id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def decision(score: Column, match: float, low: float, verdict: Column | None = None) -> Column:
    """``match`` from the upper threshold on; between the two a verdict ``yes`` decides; else, and for null, ``no_match``."""
    said = F.coalesce(verdict == "yes", F.lit(False)) if verdict is not None else F.lit(False)
    return F.when(score >= match, "match").when((score >= low) & said, "match").otherwise("no_match")


def decide_items(queries: DataFrame, rows: DataFrame, *, match: float = MATCH, low: float = ITEM_LOW, k: int = TOP_K, type_col: str | None = None, verdicts: DataFrame | None = None, id_col: str = "id", vector_col: str = "vector") -> DataFrame:
    """query_id, decision, target_id, score: only the nearest other row is ever considered.

    Between ``low`` and ``match`` a row of ``verdicts`` (id_a: the query, id_b, verdict) that says yes makes a match.
    """
    best = nearest(queries, rows, k=k, id_col=id_col, vector_col=vector_col, type_col=type_col).where("id <> query_id")
    first = best.groupBy("query_id").agg(F.min_by(F.struct("id", "score"), F.col("rank")).alias("top"))
    everyone = queries.select(F.col(id_col).cast("long").alias("query_id"))
    pairs = everyone.join(first, "query_id", "left")
    if verdicts is None:
        verdict = decision(F.col("top.score"), match, low)
    else:
        said = verdicts.where("verdict = 'yes'").select(F.col("id_a").alias("query_id"), F.col("id_b").alias("asked"), F.lit("yes").alias("said")).distinct()
        pairs = pairs.join(said, (pairs["query_id"] == said["query_id"]) & (F.col("top.id") == F.col("asked")), "left").drop(said["query_id"])
        verdict = decision(F.col("top.score"), match, low, F.col("said"))
    return pairs.select("query_id", verdict.alias("decision"), F.when(verdict == "match", F.col("top.id")).alias("target_id"), F.coalesce("top.score", F.lit(0.0)).alias("score"))


def cluster_corpus(rows: DataFrame, *, merge: float = MERGE, low: float = CORPUS_LOW, k: int = TOP_K, type_col: str | None = None, verdicts: DataFrame | None = None, found: DataFrame | None = None, id_col: str = "id", vector_col: str = "vector") -> DataFrame:
    """``id_col`` and ``cluster_id``: components of the links from each row to those of its ``k`` nearest, itself counted, that reach ``merge``.

    Pairs between ``low`` and ``merge`` link where ``verdicts`` (id_a, id_b, verdict) says yes.
    ``found`` are the neighbours of an index (``vector_index.search``), else all rows are compared.
    """
    found = nearest(rows, rows, k=k, id_col=id_col, vector_col=vector_col, type_col=type_col) if found is None else found
    found = found.where("id <> query_id")
    links = found.where(F.col("score") >= merge).select(F.col("query_id").alias("a"), F.col("id").alias("b"))
    if verdicts is not None:
        asked = found.where((F.col("score") >= low) & (F.col("score") < merge)).join(verdicts.where("verdict = 'yes'"), (F.col("query_id") == F.col("id_a")) & (F.col("id") == F.col("id_b")))
        links = links.union(asked.select("id_a", "id_b"))
    nodes = rows.select(F.col(id_col).cast("long").alias("id"))
    return connected_components(nodes, links).withColumnRenamed("id", id_col)
