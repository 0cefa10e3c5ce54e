"""Entity resolution within documents: pre-merge by name, clusters, ids, and edges between them.

Order is part of the meaning: "first" always means the least ``ord``. A document's entities
are one group; ``doc`` names the columns that tell documents apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import fingerprint, normalize_name


def first_of(col: str, where: Column | None = None) -> Column:
    """The column's value in the row of the least ``ord``, of those that meet ``where``."""
    return F.min_by(col, F.when(where, F.col("ord")) if where is not None else F.col("ord"))


def in_order(col: str) -> Column:
    """All non-null values by ``ord``."""
    return F.transform(F.array_sort(F.collect_list(F.when(F.col(col).isNotNull(), F.struct("ord", col)))), lambda x: x[col])


def premerge(entities: DataFrame, doc: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Entities of a document with the same normalised name and type as one candidate.

    Names are distinct in order of first sight, evidence is complete and in order, the
    canonical name is the longest (the first of equals), the subtype the first non-empty one;
    ``ord`` is the group's first.
    """
    keyed = entities.withColumn("key", normalize_name(F.col("name")))
    longest = F.max_by("name", F.struct(F.length("name"), -F.col("ord")))
    return keyed.groupBy(*doc, "key", "type").agg(
        longest.alias("canonical_name"),
        F.array_distinct(in_order("name")).alias("names"),
        first_of("subtype", F.length("subtype") > 0).alias("subtype"),
        in_order("evidence").alias("evidence"),
        F.min("ord").alias("ord"),
    )


def with_leftovers(candidates: DataFrame, clusters: DataFrame, doc: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Clusters (doc, type, cluster_ord, candidate_ord) plus a singleton, behind them, for every candidate of none.

    Members that are no candidates of the document are left out, and so clusters of only such.
    """
    known = candidates.select(*doc, "type", F.col("ord").alias("candidate_ord"))
    held = clusters.join(known, [*doc, "type", "candidate_ord"], "left_semi").select(*doc, "type", "cluster_ord", "candidate_ord")
    last = held.groupBy(*doc, "type").agg(F.max("cluster_ord").alias("last"))
    rest = known.join(held, [*doc, "type", "candidate_ord"], "left_anti").join(last, [*doc, "type"], "left")
    alone = F.coalesce("last", F.lit(-1)) + F.row_number().over(Window.partitionBy(*doc, "type").orderBy("candidate_ord"))
    return held.unionByName(rest.select(*doc, "type", alone.cast("long").alias("cluster_ord"), "candidate_ord"))


def cluster_ids(candidates: DataFrame, doc: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``id`` "0", "1", ... within each document: types by first sight, then ``ord``."""
    first = F.min("ord").over(Window.partitionBy(*doc, "type"))
    number = F.row_number().over(Window.partitionBy(*doc).orderBy("type_ord", "ord")) - 1
    return candidates.withColumn("type_ord", first).withColumn("id", number.cast("string")).drop("type_ord")


def resolved_entities(candidates: DataFrame, clusters: DataFrame, doc: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The entities of each document with ``id`` from "0": clusters of candidates, singletons for those of none.

    ``clusters``: doc, type, cluster_ord, candidate_ord, canonical_name, subtype, as a model
    refines them; no rows where it failed, so all candidates stay alone. Types come by first
    sight, within a type clusters by number. Names are distinct, evidence complete, both by candidate.
    """
    said = clusters.groupBy(*doc, "type", "cluster_ord").agg(F.min(F.struct("canonical_name", "subtype")).alias("said"))
    own = candidates.select(*doc, "type", F.col("ord").alias("candidate_ord"), F.struct("canonical_name", "subtype").alias("own"), "names", "evidence")
    whole = with_leftovers(candidates, clusters, doc).join(own, [*doc, "type", "candidate_ord"])
    in_turn = lambda c: F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("candidate_ord", c))), lambda x: x[c]))
    made = whole.groupBy(*doc, "type", "cluster_ord").agg(
        F.min_by("own", "candidate_ord").alias("own"),
        F.array_distinct(in_turn("names")).alias("names"),
        in_turn("evidence").alias("evidence"),
    )
    first = candidates.groupBy(*doc, "type").agg(F.min("ord").alias("type_ord"))
    named = made.join(said, [*doc, "type", "cluster_ord"], "left").join(first, [*doc, "type"])
    main = F.when(F.col("said").isNotNull(), F.col("said")).otherwise(F.col("own"))
    number = F.row_number().over(Window.partitionBy(*doc).orderBy("type_ord", "cluster_ord")) - 1
    return named.select(*doc, number.cast("string").alias("id"), main["canonical_name"].alias("canonical_name"), "names", "type", main["subtype"].alias("subtype"), "evidence")


def refined(candidates: DataFrame, refine, doc: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """What ``resolved_entities`` takes, from ``refine``: a DataFrame function from groups (doc, type, items) to (doc, type, clusters).

    ``items``: structs (candidate_ord, canonical_name, names) in order; only groups of two or
    more are asked. ``clusters``: structs (canonical_name, subtype, members), members being
    positions of items from 0; null where the model failed.
    """
    items = F.array_sort(F.collect_list(F.struct(F.col("ord").alias("candidate_ord"), "canonical_name", "names"))).alias("items")
    groups = candidates.groupBy(*doc, "type").agg(items).where(F.size("items") > 1)
    said = refine(groups).select(*doc, "type", F.posexplode("clusters").alias("cluster_ord", "c"))
    rows = said.select(*doc, "type", F.col("cluster_ord").cast("long").alias("cluster_ord"), F.explode("c.members").alias("at"), "c.canonical_name", "c.subtype")
    placed = rows.join(groups, [*doc, "type"]).where((F.col("at") >= 0) & (F.col("at") < F.size("items")))
    return placed.select(*doc, "type", "cluster_ord", F.get("items", F.col("at"))["candidate_ord"].alias("candidate_ord"), "canonical_name", "subtype")


def name_map(resolved: DataFrame, doc: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """(doc, name, id): the least numbered cluster that has the surface name, whatever its type."""
    rows = resolved.select(*doc, F.col("id").cast("long").alias("no"), F.explode("names").alias("name"))
    return rows.groupBy(*doc, "name").agg(F.min("no").cast("string").alias("id"))


def rewrite_edges(relations: DataFrame, names: DataFrame, doc: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Relations whose two endpoints have an id, with these in place of the names."""
    side = lambda end: names.select(*doc, F.col("name").alias(end), F.col("id").alias(f"{end}_id"))
    return relations.join(side("head"), [*doc, "head"]).join(side("tail"), [*doc, "tail"])


def collapse_edges(edges: DataFrame, doc: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Edges with the same ends, type and evidence text (case and white space apart) as one.

    The confidence is the highest, with that row's attributes (the first of equals); the
    subtype is the first row's, null or not; all evidence stays, in order.
    """
    keyed = edges.withColumn("print", fingerprint(F.col("evidence")))
    return keyed.groupBy(*doc, "head_id", "type", "tail_id", "print").agg(
        F.max("confidence").alias("confidence"),
        F.max_by("attributes", F.struct("confidence", -F.col("ord"))).alias("attributes"),
        F.min_by("subtype", "ord").alias("subtype"),
        in_order("evidence").alias("evidence"),
        F.min("ord").alias("ord"),
    )


def valid_relations(relations: DataFrame, entities: DataFrame, rules: DataFrame, doc: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Relations whose ends are positions of the document's entities with types that the rule table allows.

    ``relations``: head, tail (positions from 0), type; ``entities``: pos, type, name;
    ``rules``: type, head_types, tail_types. A type without a rule allows nothing.
    """
    end = lambda c: entities.select(*doc, F.col("pos").alias(c), F.col("type").alias(f"{c}_type"), F.col("name").alias(f"{c}_name"))
    placed = relations.join(end("head"), [*doc, "head"]).join(end("tail"), [*doc, "tail"])
    ruled = placed.join(F.broadcast(rules), "type")  # a row a declared relation
    return ruled.where(F.array_contains("head_types", F.col("head_type")) & F.array_contains("tail_types", F.col("tail_type"))).drop("head_types", "tail_types")


def best_values(attributes: DataFrame, *keys: str) -> DataFrame:
    """Per key and attribute name the non-null value of the highest confidence, the first of equals."""
    known = attributes.where(F.col("value").isNotNull())
    return known.groupBy(*keys, "name").agg(F.max_by("value", F.struct("confidence", -F.col("ord"))).alias("value"), F.max("confidence").alias("confidence"))


def with_attributes(found: DataFrame, attributes: DataFrame, *keys: str) -> DataFrame:
    """Adds ``attributes``, a map from each name to its best value; an empty map where nothing is known. ``attributes``: keys, name, value, confidence, ord."""
    best = best_values(attributes, *keys).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("attributes"))
    return found.join(best, [*keys], "left").withColumn("attributes", F.coalesce("attributes", F.map_from_entries(F.array().cast("array<struct<name:string,value:string>>"))))


def merge_clusters(members: DataFrame, cluster: str = "cluster_id") -> DataFrame:
    """Members (doc_id, ord, name, type, subtype, evidence array) of each cluster as one entity.

    The longest name with its type and subtype; sorted distinct aliases and documents; all evidence in order.
    """
    longest = F.min_by(F.struct("name", "type", "subtype"), F.struct(-F.length("name"), "ord"))
    found = members.groupBy(cluster).agg(
        longest.alias("main"),
        F.array_sort(F.collect_set("name")).alias("aliases"),
        F.array_sort(F.collect_set("doc_id")).alias("doc_ids"),
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", "evidence"))), lambda x: x["evidence"])).alias("evidence"),
    )
    return found.select(cluster, F.col("main.name").alias("canonical_name"), F.col("main.type").alias("type"), F.col("main.subtype").alias("subtype"), "aliases", "doc_ids", "evidence")


def remap(edges: DataFrame, canon: DataFrame) -> DataFrame:
    """Edges with both ends replaced by their canonical ids; ``canon``: member_id, canonical_id."""
    side = lambda end: canon.select(F.col("member_id").alias(end), F.col("canonical_id").alias(f"{end}_canonical"))
    return edges.join(side("head"), "head").join(side("tail"), "tail")
