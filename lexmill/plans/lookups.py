"""Queries of indexes and lookups: vectors by inverted lists, names by trigrams, the recent window, the folded index and the graph as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import knn, places, resolve, vector_index
from ..shared import shared_folder
from . import relations
from .catalogue import KM, MENTIONS, MERGED, SCORES, SIGNED, TOWNS, _clusters, _mentions, _towns, _vectors, edges_digest, query, sql_name, sql_trigrams, t

# Vectors


def _index(v, type_col=None):
    return vector_index.build(v, vector_index.fit(v), type_col=type_col)


@query("vector_index_exact", f"WITH {SCORES.format(on='q.id % 20 = 0')} SELECT query_id, id, score, rank::INT AS rank FROM ranked WHERE rank <= 10")
def vector_index_exact(spark, d):
    v = _vectors(spark, d)
    return vector_index.search(v.where("id % 20 = 0"), _index(v), exact=True)


@query("vector_index_typed", f"WITH {SCORES.format(on='q.id % 20 = 0 AND q.label = r.label')} SELECT query_id, id, score, rank::INT AS rank FROM ranked WHERE rank <= 10")
def vector_index_typed(spark, d):
    v = _vectors(spark, d)
    return vector_index.search(v.where("id % 20 = 0"), _index(v, "label"), exact=True, type_col="label")


@query("vector_index_probed")
def vector_index_probed(spark, d):
    """From the probed lists alone; a test holds its recall against ``nearest``."""
    v = _vectors(spark, d)
    return vector_index.search(v.where("id % 20 = 0"), _index(v))


@query("corpus_clusters_indexed", _clusters("true"))
def corpus_clusters_indexed(spark, d):
    v = _vectors(spark, d)
    return knn.cluster_corpus(v, merge=0.35, low=0.25, found=vector_index.search(v, _index(v), exact=True, least=0.35))  # no lower score links


# Names


@query(
    "city_substring",
    f"""WITH q AS (SELECT DISTINCT CASE c_custkey % 5 WHEN 0 THEN 'At' WHEN 1 THEN 'r#' || repeat('0', 6) || c_custkey % 200 WHEN 2 THEN 'ïÓ' || c_nationkey WHEN 3 THEN 'zz' || c_nationkey ELSE 'Nation ' || c_nationkey END AS name FROM customer),
c AS (SELECT n_nationkey::BIGINT AS id, n_name AS name FROM nation UNION ALL SELECT 1000 + s_suppkey, s_name FROM supplier),
p AS (SELECT q.name, c.id, c.name AS city, {sql_trigrams('q.name')} AS a, {sql_trigrams('c.name')} AS b, strip_accents(lower(q.name)) AS x, strip_accents(lower(c.name)) AS y FROM q CROSS JOIN c),
s AS (SELECT *, len(list_intersect(a, b))::DOUBLE / len(list_distinct(list_concat(a, b))) AS sim FROM p),
r AS (SELECT name, id, city, CASE WHEN x = y THEN 0 WHEN sim >= 0.3 THEN 1 ELSE 2 END AS way, sim FROM s WHERE x = y OR sim >= 0.3 OR contains(y, x))
SELECT name, id AS city_id, city AS city_name FROM r QUALIFY row_number() OVER (PARTITION BY name ORDER BY way, CASE WHEN way < 2 THEN -sim ELSE length(city) END, id) = 1""",
)
def city_substring(spark, d):
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    name = F.when(k % 5 == 0, "At").when(k % 5 == 1, F.concat(F.lit("r#000000"), (k % 200).cast("string"))).when(k % 5 == 2, F.concat(F.lit("ïÓ"), n)).when(k % 5 == 3, F.concat(F.lit("zz"), n)).otherwise(F.concat(F.lit("Nation "), n))
    cities = t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name")).union(t(spark, d, "supplier").select(1000 + F.col("s_suppkey"), "s_name"))
    return places.matched_city(t(spark, d, "customer").select(name.alias("name")), cities, contained=True)


@query(
    "street_fuzzy",
    f"""WITH {TOWNS}, st AS (SELECT c_nationkey::BIGINT AS doc_id, c_custkey AS ord, 'rua nov' || CASE WHEN c_custkey % 2 = 0 THEN 'a ' ELSE '' END || c_custkey % 40 AS key FROM customer),
ed AS (SELECT l_orderkey * 10 + l_linenumber AS edge_id, l_suppkey AS city_id, 'rua nova ' || l_partkey % 40 AS key FROM lineitem),
held AS (SELECT DISTINCT city_id, key FROM ed),
alike AS (SELECT a.key, b.key AS found, len(list_intersect(a.g, b.g))::DOUBLE / len(list_distinct(list_concat(a.g, b.g))) AS sim
  FROM (SELECT DISTINCT key, {sql_trigrams('key')} AS g FROM st) a CROSS JOIN (SELECT DISTINCT key, {sql_trigrams('key')} AS g FROM held) b),
best AS (SELECT h.city_id, a.key, h.key AS found, a.sim FROM held h JOIN alike a ON a.found = h.key WHERE a.sim >= 0.3 QUALIFY row_number() OVER (PARTITION BY h.city_id, a.key ORDER BY a.key = h.key DESC, a.sim DESC, h.key) = 1),
mid AS (SELECT doc_id, avg(lat) AS mlat, avg(lon) AS mlon FROM towns GROUP BY 1),
hit AS (SELECT st.doc_id, st.ord, w.city_id, b.found, w.ord AS city_ord, w.lat, w.lon FROM st JOIN towns w ON w.doc_id = st.doc_id AND w.city_id IS NOT NULL JOIN best b ON b.city_id = w.city_id AND b.key = st.key),
top AS (SELECT * FROM hit JOIN mid USING (doc_id) QUALIFY row_number() OVER (PARTITION BY doc_id, ord ORDER BY coalesce({KM.format(b='lat', c='lon', d='mlat', e='mlon')}, 1e300), city_ord) = 1),
edges AS (SELECT city_id, key AS found, md5(array_to_string(list_sort(list_distinct(list(edge_id))), ',')) AS edges FROM ed GROUP BY ALL)
SELECT doc_id, ord, city_id, edges FROM top JOIN edges USING (city_id, found)""",
)
def street_fuzzy(spark, d):
    k = F.col("c_custkey")
    text = F.concat(F.lit("Calle Rúa Nov"), F.when(k % 2 == 0, "a ").otherwise(""), (k % 40).cast("string"))
    streets = t(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("doc_id"), k.alias("ord"), text.alias("text"))
    edges = t(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("edge_id"), F.col("l_suppkey").alias("city_id"), F.concat(F.lit("RUA Nova "), (F.col("l_partkey") % 40).cast("string")).alias("name"))
    found = places.streets_in_cities(streets, _towns(spark, d), edges, least=0.3, gathered=edges_digest)
    return found.select("doc_id", "ord", "city_id", F.col("edge_ids").alias("edges"))


# Streams


@query(
    "stream_recent_match",
    f"""WITH {SIGNED}, bands AS (SELECT doc_id, k, sig[4 * k + 1:4 * k + 4] AS key FROM signed CROSS JOIN (SELECT unnest(range(32)) AS k)),
near AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM bands x JOIN bands y ON x.k = y.k AND x.key = y.key AND y.doc_id < x.doc_id AND y.doc_id >= x.doc_id - 5000),
good AS (SELECT a, b FROM near JOIN signed x ON x.doc_id = a JOIN signed y ON y.doc_id = b WHERE len(list_filter(list_zip(x.sig, y.sig), lambda p: p[1] = p[2])) >= 0.9 * 128)
SELECT a AS doc_id, max(b) AS "match" FROM good GROUP BY a""",
)
def stream_recent_match(spark, d):
    from ..streaming.recent import recent_matches

    return recent_matches(spark, d).select(F.col("id").alias("doc_id"), "match")


@query("stream_folded_index", MERGED + " HAVING md5(text) IS NOT NULL")
def stream_folded_index(spark, d):
    from ..streaming.folded import folded_articles

    rows = folded_articles(spark, d).latest()
    return rows.select(F.col("key").alias("text_key"), "ord", F.array_join("sources", "|").alias("sources"), F.col("date").cast("string").alias("date"))


# The graph as tables

GRAPH = f"""{MENTIONS}, c AS (SELECT doc_id, no, ord, canonical_name, type, evidence, {sql_name('canonical_name')} AS cluster_id, no % 7 / 8.0 AS confidence,
  CASE WHEN no % 5 <> 0 THEN no % 5 END AS size, type || no % 3 AS kind FROM ids),
e AS (SELECT h.cluster_id AS head, (h.no % 3)::VARCHAR AS type, t.cluster_id AS tail, h.doc_id, h.ord, h.confidence, h.size FROM c h JOIN c t ON t.doc_id = h.doc_id AND t.no = h.no + 1)"""


def _graph(spark, d):
    vertices = resolve.cluster_ids(resolve.premerge(_mentions(spark, d)))
    no = F.col("id").cast("long")
    size = F.when(no % 5 != 0, no % 5)
    facts = F.to_json(F.struct(size.alias("size"), F.concat("type", (no % 3).cast("string")).alias("kind")))
    vertices = vertices.withColumns({"attributes": facts, "confidence": (no % 7 / 8)})
    clusters = vertices.select("doc_id", "id", tx.normalize_name(F.col("canonical_name")).alias("cluster_id"))
    edges = vertices.select("doc_id", F.col("id").alias("head_id"), (no % 3).cast("string").alias("type"), (no + 1).cast("string").alias("tail_id"), "confidence", F.array(F.lit("said")).alias("evidence"), "ord", F.to_json(F.struct(size.alias("size"))).alias("attributes"))
    folder = shared_folder(spark, "graph")
    relations.write_graph(relations.graph_tables(vertices, edges, clusters), folder)
    return folder


def _best(table: str, keys: str, column: str) -> str:
    return f"(SELECT {keys}, {column} FROM {table} WHERE {column} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY confidence DESC, doc_id, ord) = 1)"


@query(
    "graph_vertices",
    f"""WITH {GRAPH} SELECT v.*, size, kind FROM (
SELECT cluster_id, first(canonical_name ORDER BY length(canonical_name) DESC, doc_id, ord) AS canonical_name, count(*) AS n_members, count(DISTINCT doc_id) AS n_docs, sum(len(evidence))::BIGINT AS n_evidence
FROM c GROUP BY 1) v
LEFT JOIN {_best('c', 'cluster_id', 'size')} USING (cluster_id) LEFT JOIN {_best('c', 'cluster_id', 'kind')} USING (cluster_id)""",
)
def graph_vertices(spark, d):
    rows = relations.read_graph(spark, _graph(spark, d), "vertices")
    return rows.select("cluster_id", "canonical_name", "n_members", "n_docs", "n_evidence", F.variant_get("attributes", "$.size", "long").alias("size"), F.variant_get("attributes", "$.kind", "string").alias("kind"))


@query(
    "graph_edges",
    f"""WITH {GRAPH} SELECT x.*, size FROM (SELECT head, type, tail, max(confidence)::DOUBLE AS confidence, count(DISTINCT doc_id) AS n_docs, count(*) AS n_evidence FROM e GROUP BY ALL) x
LEFT JOIN {_best('e', 'head, type, tail', 'size')} USING (head, type, tail)""",
)
def graph_edges(spark, d):
    rows = relations.read_graph(spark, _graph(spark, d), "edges")
    return rows.select("head", "type", "tail", "confidence", "n_docs", "n_evidence", F.variant_get("attributes", "$.size", "long").alias("size"))


@query(
    "graph_evidence",
    f"WITH {GRAPH} SELECT cluster_id, doc_id, ord, (i - 1)::INT AS pos, evidence[i] AS text FROM (SELECT *, unnest(range(1, len(evidence) + 1)) AS i FROM c)",
)
def graph_evidence(spark, d):
    return relations.read_graph(spark, _graph(spark, d), "vertex_evidence").select("cluster_id", "doc_id", "ord", "pos", "text")
