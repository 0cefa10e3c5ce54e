"""The news pipeline: duplicates, scope, and the index, one terminal status per article."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.merge import merge_articles, upsert
from ..operators.places import distinct_places
from ..operators.scoring import best_label, in_scope, scope_of, top_labels
from ..operators.similarity import near_duplicate_clusters


#: Every way an article may leave the pipeline.
STATUSES = ("duplicate", "out_of_scope", "indexed")


def statuses(docs: DataFrame, gate: DataFrame, *, white: float = 0.4, black: float = 0.7) -> DataFrame:
    """doc_id, cluster_id, status: duplicate of the cluster's least id, else out_of_scope, else indexed. ``gate``: doc_id, kind, score."""
    clusters = near_duplicate_clusters(docs.select("doc_id", "text"))
    judged = clusters.join(in_scope(gate, white, black), "doc_id", "left")
    status = F.when(F.col("doc_id") != F.col("cluster_id"), "duplicate").when(~F.coalesce("in_scope", F.lit(False)), "out_of_scope").otherwise("indexed")
    return judged.select("doc_id", "cluster_id", status.alias("status"))


def counted(states: DataFrame, name: str = "news") -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """``states`` with a look at every row that is written, and the numbers of articles by status once it has been: no second pass.

    The counts are complete after the first action that runs over all rows, and wait for it.
    """
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    counts = [F.count(F.when(F.col("status") == s, 1)).alias(s) for s in STATUSES]
    return states.observe(seen, *counts), lambda: {k: v for k, v in seen.get.items() if v}


def index_articles(articles: DataFrame, states: DataFrame, old: DataFrame | None = None) -> DataFrame:
    """The index rows: articles of an indexed cluster merged under its id, and merged with an older index."""
    heads = states.where("status = 'indexed'").select("cluster_id")
    rows = articles.join(states.select(F.col("doc_id").alias("ord"), "cluster_id"), "ord").join(heads, "cluster_id", "left_semi")
    new = merge_articles(rows, "cluster_id")
    return new if old is None else upsert(old, new, "cluster_id")


def enriched(states: DataFrame, places: DataFrame, topics: DataFrame, scopes: DataFrame) -> DataFrame:
    """Indexed articles with distinct places, up to three topics and a scope; places and score tables come from elsewhere."""
    ids = states.where("status = 'indexed'").select("doc_id")
    spots = distinct_places(places)
    per = spots.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "place_key"))), lambda x: x["place_key"]).alias("places"), F.max((F.col("type") == "city").cast("int")).alias("city"), F.max((F.col("type") == "region").cast("int")).alias("region"))
    best = best_label(scopes)
    kept = top_labels(topics).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "hypothesis"))), lambda x: x["hypothesis"]).alias("topics"))
    has = lambda c: F.coalesce(F.col(c), F.lit(0)) == 1
    out = ids.join(per, "doc_id", "left").join(kept, "doc_id", "left").join(best, "doc_id", "left")
    return out.select("doc_id", "places", "topics", scope_of(F.col("label"), F.coalesce("score", F.lit(0.0)), has("city"), has("region")).alias("scope"))
