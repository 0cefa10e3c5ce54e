"""From extracted mentions and relations to a graph: per document, then across documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.attributes import best_attributes
from ..operators.resolve import cluster_ids, collapse_edges, merge_clusters, name_map, premerge, remap, rewrite_edges


def document_graph(mentions: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices (doc_id, id, canonical_name, ...) and collapsed edges between ids, of each document."""
    vertices = cluster_ids(premerge(mentions))
    return vertices, collapse_edges(rewrite_edges(relations, name_map(vertices)))


def canonical_edges(edges: DataFrame, clusters: DataFrame) -> DataFrame:
    """Edges with head and tail as clusters; those with an end in none are left out."""
    name = lambda c: F.concat_ws("/", "doc_id", c)
    canon = clusters.select(name("id").alias("member_id"), F.col("cluster_id").alias("canonical_id"))
    mapped = remap(edges.withColumns({"head": name("head_id"), "tail": name("tail_id")}), canon)
    return mapped.drop("head", "tail").withColumnsRenamed({"head_canonical": "head", "tail_canonical": "tail"})


def consolidated(vertices: DataFrame, edges: DataFrame, clusters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The corpus graph with whole lists in its rows: vertices merged by ``clusters`` (doc_id, id, cluster_id), edges between clusters with the highest confidence.

    For clusters of which many documents speak, ``graph_tables`` keeps the lists as rows.
    """
    members = vertices.join(clusters, ["doc_id", "id"]).select("cluster_id", "doc_id", F.struct("doc_id", "ord").alias("ord"), F.col("canonical_name").alias("name"), "type", "subtype", "evidence")
    mapped = canonical_edges(edges, clusters)
    merged = mapped.groupBy("head", "type", "tail").agg(F.max("confidence").alias("confidence"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "ord", "evidence"))), lambda x: x["evidence"])).alias("evidence"), F.array_sort(F.collect_set("doc_id")).alias("doc_ids"))
    return merge_clusters(members), merged


def graph_tables(vertices: DataFrame, edges: DataFrame, clusters: DataFrame) -> dict[str, DataFrame]:
    """The corpus graph as tables in which every row is small, however many documents speak of a cluster.

    ``vertices`` has names, as ``document_graph`` gives them. Of the result
    ``vertices``: cluster_id, canonical_name, type, subtype (of the longest name, the first by
    document and order of equals), n_members, n_docs, n_evidence, attributes (VARIANT).
    ``edges``: head, type, tail, confidence (the highest), n_docs, n_evidence, attributes.
    ``aliases``: cluster_id, alias, n. ``vertex_docs``: cluster_id, doc_id, n. ``vertex_evidence``
    and ``edge_evidence``: the keys, doc_id, ord, pos, text, one row a piece of evidence.
    Where the input has ``attributes`` (VARIANT or JSON) and ``confidence``, the best value of each name stays.
    """
    members = vertices.join(clusters, ["doc_id", "id"])
    # A document's members fold first, so what a large cluster moves is a row a document.
    own = members.groupBy("cluster_id", "doc_id").agg(F.count("*").alias("n"), F.sum(F.size("evidence")).alias("n_evidence"), F.max(F.length("canonical_name")).alias("length"), F.min_by(F.struct("canonical_name", "type", "subtype"), F.struct(-F.length("canonical_name"), "ord")).alias("main"))
    merged = own.groupBy("cluster_id").agg(F.min_by("main", F.struct(-F.col("length"), "doc_id")).alias("main"), F.sum("n").alias("n_members"), F.count("*").alias("n_docs"), F.sum("n_evidence").alias("n_evidence"))
    merged = merged.select("cluster_id", "main.*", "n_members", "n_docs", "n_evidence")
    mapped = canonical_edges(edges, clusters)
    per = mapped.groupBy("head", "type", "tail", "doc_id").agg(F.max("confidence").alias("confidence"), F.sum(F.size("evidence")).alias("n_evidence"))
    ends = per.groupBy("head", "type", "tail").agg(F.max("confidence").alias("confidence"), F.count("*").alias("n_docs"), F.sum("n_evidence").alias("n_evidence"))
    spoken = lambda df, *keys: df.select(*keys, "doc_id", "ord", F.posexplode("evidence").alias("pos", "text"))
    return {
        "vertices": _attributed(merged, members, ["cluster_id"]),
        "edges": _attributed(ends, mapped, ["head", "type", "tail"]),
        "aliases": members.select("cluster_id", F.explode(F.array_distinct("names")).alias("alias")).groupBy("cluster_id", "alias").agg(F.count("*").alias("n")),
        "vertex_docs": own.select("cluster_id", "doc_id", "n"),
        "vertex_evidence": spoken(members, "cluster_id"),
        "edge_evidence": spoken(mapped, "head", "type", "tail"),
    }


def _attributed(merged: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    if "attributes" not in rows.columns:
        return merged.withColumn("attributes", F.parse_json(F.lit("{}")))
    # The least of this: the greatest confidence, of equals the first by document and order.
    order = F.struct(-F.coalesce("confidence", F.lit(float("-inf"))), "doc_id", "ord")
    best = best_attributes(rows.select(*keys, "doc_id", "ord", "confidence", "attributes"), keys, order)
    return merged.join(best, keys, "left").withColumn("attributes", F.coalesce("attributes", F.parse_json(F.lit("{}"))))


#: Sort order of graph tables, by which a reader of one cluster prunes all other files.
GRAPH_ORDER = {"vertices": ["cluster_id"], "edges": ["head", "type", "tail"], "aliases": ["cluster_id", "alias"], "vertex_docs": ["cluster_id", "doc_id"], "vertex_evidence": ["cluster_id", "doc_id", "ord", "pos"], "edge_evidence": ["head", "type", "tail", "doc_id", "ord", "pos"]}


def write_graph(tables: dict[str, DataFrame], folder: str) -> None:
    """Each table below ``folder``, in ranges of its keys: a cluster of any size is spread over as many files as it needs."""
    for name, rows in tables.items():
        keys = GRAPH_ORDER[name]
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{folder}/{name}")


def read_graph(spark: SparkSession, folder: str, name: str, **equal) -> DataFrame:
    """A table of the graph, or its rows whose columns equal the values, which the Parquet scan looks up."""
    rows = spark.read.parquet(f"{folder}/{name}")
    for column, value in equal.items():
        rows = rows.where(F.col(column) == F.lit(value))
    return rows
