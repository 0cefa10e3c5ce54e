"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shared import written


def connected_components(nodes: DataFrame, links: DataFrame, *, id_col: str = "id", a: str = "a", b: str = "b") -> DataFrame:
    """``id_col`` and ``cluster_id``, the least id of its component, for every node; nodes without links are alone.

    Each round a node takes the least label of itself, of its neighbours and of its label, so
    rounds grow with the logarithm of the longest path. Links to ids that are no nodes are
    left out. Every round is written to the shared folder.
    """
    known = nodes.select(F.col(id_col).alias("node")).distinct()
    half = links.select(F.col(a).alias("node"), F.col(b).alias("near")).where("node <> near")
    both = half.union(half.select("near", "node")).distinct()
    both = both.join(known, "node", "left_semi").join(known.withColumnRenamed("node", "near"), "near", "left_semi").select("node", "near")
    both = written(both, "links")
    labels = both.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("label"))
    labels = written(labels, "labels")
    moved = True
    while moved:
        seen = both.join(labels.select(F.col("node").alias("near"), "label"), "near").groupBy("node").agg(F.min("label").alias("seen"))
        tops = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        least = F.least("label", "seen", "top")
        nxt = written(labels.join(seen, "node").join(tops, "label", "left").select("node", least.alias("label"), (least < F.col("label")).alias("moved")), "labels")
        labels = nxt.select("node", "label")
        moved = bool(nxt.where("moved").limit(1).count())
    return known.join(labels, "node", "left").select(F.col("node").alias(id_col), F.coalesce("label", "node").alias("cluster_id"))
