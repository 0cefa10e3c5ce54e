"""Connected components of a graph of many small and some very large groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label``, the least node of its component, for every node of ``links``.

    Each round a node takes the least label among its own, its neighbours' and that of its
    label. Rounds end when no label changes, so their number grows with the logarithm of
    the longest path. Every round is written to the shared folder. Loops, repeated and
    reversed links do no harm; no links, no rows.
    """
    links = links.where(F.col(a) != F.col(b))
    both = cut(links.select(F.col(a).alias("node"), F.col(b).alias("near")).union(links.select(F.col(b), F.col(a))).distinct(), "links")
    labels = cut(both.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("near"), F.col("label").alias("seen")), "near").groupBy("node").agg(F.min("seen").alias("seen"))
        above = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
        nxt = labels.join(near, "node").join(above, "label", "left")
        nxt = cut(nxt.select("node", F.least("label", "seen", "top").alias("label"), (F.least("label", "seen", "top") < F.col("label")).alias("moved")), "labels")
        labels = nxt.select("node", "label")
        if not nxt.where("moved").limit(1).count():
            return labels
