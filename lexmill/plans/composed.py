"""Queries of the composed operators: whole geotagging and resolution, verdicts, recent matches, sources and prompts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import geotag, knn, places, resolve, scoring, similarity, summarize
from ..shared import written
from ..sources.tables import newest
from . import relations
from .catalogue import ENTRIES, LEFT, MENTIONS, SCORES, SIGNED, SPANS, _entries, _mentions, _spans, _vectors, edges_digest, query, sql_name, t

# Places


@query(
    "span_union",
    """WITH a AS (SELECT l_orderkey AS doc_id, (l_partkey % 60)::INT AS s, (l_partkey % 60 + 8)::INT AS e, 'tag ' || l_linenumber AS text FROM lineitem WHERE l_linenumber % 2 = 1 AND l_suppkey % 3 <> 0),
b AS (SELECT l_orderkey AS doc_id, (l_suppkey % 60)::INT AS s, (l_suppkey % 60 + 5)::INT AS e, 'street ' || l_linenumber AS text FROM lineitem WHERE l_linenumber % 2 = 0),
c AS (SELECT b.* FROM b ANTI JOIN a ON a.doc_id = b.doc_id AND ((b.s >= a.s AND b.s < a.e) OR (b.e > a.s AND b.e <= a.e))),
u AS (SELECT *, '' AS hint, 0 AS source FROM a UNION ALL SELECT *, 'street', 1 FROM c)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY source, s, e, text) - 1)::INT AS ord, text, s AS start_char, e AS end_char, hint FROM u""",
)
def span_union(spark, d):
    line = t(spark, d, "lineitem")
    at = lambda key, n: [(F.col(key) % 60).cast("int").alias("start_char"), (F.col(key) % 60 + n).cast("int").alias("end_char")]
    name = lambda word: F.concat(F.lit(word), F.col("l_linenumber").cast("string")).alias("text")
    tagged = line.where("l_linenumber % 2 = 1").select(F.col("l_orderkey").alias("doc_id"), name("tag "), F.when(F.col("l_suppkey") % 3 != 0, "LOC").otherwise("PER").alias("label"), *at("l_partkey", 8))
    streets = line.where("l_linenumber % 2 = 0").select(F.col("l_orderkey").alias("doc_id"), name("street "), *at("l_suppkey", 5), F.lit("street").alias("hint"))
    return geotag.span_union(tagged, streets)


@query(
    "geotag_places",
    f"""WITH {ENTRIES}, {SPANS}, found AS (SELECT s.doc_id, s.ord, s.text, i.entry_id, i.name, i.feature_class, i.pop, (i.entry_id * 37 % 180 - 90)::DOUBLE AS lat, (i.entry_id * 91 % 360 - 180)::DOUBLE AS lon FROM spans s LEFT JOIN idx i ON i.key = strip_accents(lower(trim(s.text)))),
types AS (SELECT doc_id, ord, text, CASE WHEN regexp_matches(text, '(?i)^calle\\s+') THEN 'street' WHEN bool_or(feature_class = 'A') AND NOT coalesce(bool_or(feature_class = 'P'), false) THEN 'region' WHEN bool_or(feature_class = 'P') AND NOT coalesce(bool_or(feature_class = 'A'), false) THEN 'city' ELSE 'location' END AS type FROM found GROUP BY doc_id, ord, text),
best AS (SELECT f.*, t.type, count(*) OVER (PARTITION BY f.doc_id, f.ord) AS n FROM found f JOIN types t USING (doc_id, ord) WHERE (t.type = 'region' AND feature_class = 'A') OR (t.type = 'city' AND feature_class = 'P') QUALIFY row_number() OVER (PARTITION BY f.doc_id, f.ord ORDER BY pop DESC, entry_id) = 1),
named AS (SELECT n_nationkey::BIGINT AS city_id, 'Nación_' || n_nationkey AS city_name FROM nation),
city AS (SELECT b.*, n.city_id, n.city_name FROM best b JOIN named n ON strip_accents(lower(n.city_name)) = strip_accents(lower(b.name)) WHERE b.type = 'city'),
ed AS (SELECT o_custkey % 25 AS city_id, 'region ' || o_orderkey % 3 AS key, md5(array_to_string(list_sort(list_distinct(list(o_orderkey))), ',')) AS edges FROM orders GROUP BY 1, 2),
street AS (SELECT DISTINCT t.doc_id, t.ord, c.city_id, ed.edges FROM types t JOIN city c ON c.doc_id = t.doc_id JOIN ed ON ed.city_id = c.city_id AND ed.key = strip_accents(lower(trim(substr(t.text, 7)))) WHERE t.type = 'street'),
every AS (SELECT doc_id, ord, 'region' AS type, entry_id AS geonames_id, NULL::BIGINT AS city_id, md5('') AS edges, 1.0::DOUBLE AS confidence, 0 AS r FROM best WHERE type = 'region'
  UNION ALL SELECT doc_id, ord, 'city', entry_id, city_id, md5(''), CASE WHEN n = 1 THEN 1.0 ELSE 0.0 END, 1 FROM city UNION ALL SELECT doc_id, ord, 'street', NULL, city_id, edges, 1.0, 2 FROM street)
SELECT doc_id, ord, type, geonames_id::VARCHAR AS geonames_id, city_id::VARCHAR AS city_id, edges, confidence, (row_number() OVER (PARTITION BY doc_id ORDER BY r, ord) - 1)::INT AS place_no FROM every""",
)
def geotag_places(spark, d):
    at = F.col("entry_id")
    index = places.gazetteer_index(_entries(spark, d).withColumns({"lat": (at * 37 % 180 - 90).cast("double"), "lon": (at * 91 % 360 - 180).cast("double")}))
    cities = t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.concat(F.lit("Nación_"), F.col("n_nationkey").cast("string")).alias("name"))
    edges = t(spark, d, "orders").select(F.col("o_orderkey").alias("edge_id"), (F.col("o_custkey") % 25).alias("city_id"), F.concat(F.lit("Calle Región "), (F.col("o_orderkey") % 3).cast("string")).alias("name"))
    found, _ = geotag.geotag(_spans(spark, d), index, cities, edges, gathered=edges_digest)
    return found.select("doc_id", "ord", "type", F.col("geonames_id").cast("string").alias("geonames_id"), F.col("city_id").cast("string").alias("city_id"), F.coalesce("edge_ids", F.md5(F.lit("").cast("binary"))).alias("edges"), "confidence", "place_no")


# Resolution


@query(
    "resolved_entities",
    f"""WITH {MENTIONS}, {LEFT}, held AS (SELECT c.* FROM clusters c SEMI JOIN candidates k ON c.doc_id = k.doc_id AND c.type = k.type AND c.candidate_ord = k.ord),
last AS (SELECT doc_id, type, max(cluster_ord) AS last FROM held GROUP BY ALL), rest AS (SELECT doc_id, type, ord FROM candidates k ANTI JOIN held h ON h.doc_id = k.doc_id AND h.type = k.type AND h.candidate_ord = k.ord),
whole AS (SELECT *, 'Group ' || cluster_ord AS said FROM held UNION ALL SELECT doc_id, type, coalesce(last, -1) + row_number() OVER (PARTITION BY doc_id, type ORDER BY ord), ord, NULL FROM rest LEFT JOIN last USING (doc_id, type)),
members AS (SELECT w.*, i.canonical_name, i.names, i.subtype, i.evidence, i.type_ord FROM whole w JOIN ids i ON i.doc_id = w.doc_id AND i.type = w.type AND i.ord = w.candidate_ord),
seen AS (SELECT doc_id, type, cluster_ord, name, min(candidate_ord * 1000 + k) AS o FROM (SELECT doc_id, type, cluster_ord, candidate_ord, unnest(names) AS name, unnest(range(len(names))) AS k FROM members) GROUP BY ALL),
listed AS (SELECT doc_id, type, cluster_ord, string_agg(name, '|' ORDER BY o) AS names FROM seen GROUP BY ALL),
made AS (SELECT doc_id, type, cluster_ord, min(type_ord) AS type_ord, max(said) AS said, arg_min(canonical_name, candidate_ord) AS own, arg_min(coalesce(subtype, ''), candidate_ord) AS sub, md5(string_agg(array_to_string(evidence, '|'), '|' ORDER BY candidate_ord)) AS evidence FROM members GROUP BY ALL)
SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY type_ord, cluster_ord) - 1)::VARCHAR AS id, coalesce(said, own) AS canonical_name, names, type, CASE WHEN said IS NULL THEN sub ELSE '' END AS subtype, evidence FROM made JOIN listed USING (doc_id, type, cluster_ord)""",
)
def resolved_entities(spark, d):
    found = resolve.premerge(_mentions(spark, d))
    clusters = found.where("ord % 3 <> 0").selectExpr("doc_id", "type", "ord div 50 AS cluster_ord", "ord AS candidate_ord")
    clusters = clusters.union(found.where("ord % 7 = 0").selectExpr("doc_id", "type", "99999L", "-1L"))
    clusters = clusters.selectExpr("*", "concat('Group ', cluster_ord) AS canonical_name", "cast(null as string) AS subtype")
    made = resolve.resolved_entities(found, clusters)
    joined = lambda c: F.array_join(c, "|")
    return made.select("doc_id", "id", "canonical_name", joined("names").alias("names"), "type", F.coalesce("subtype", F.lit("")).alias("subtype"), F.md5(joined("evidence").cast("binary")).alias("evidence"))


@query(
    "consolidated_vertices",
    f"WITH {MENTIONS}, c AS (SELECT *, {sql_name('canonical_name')} AS cluster FROM ids) SELECT cluster, string_agg(DISTINCT canonical_name, '|' ORDER BY canonical_name) AS aliases, string_agg(DISTINCT doc_id, '|' ORDER BY doc_id) AS doc_ids, sum(len(evidence))::INT AS n_evidence FROM c GROUP BY 1",
)
def consolidated_vertices(spark, d):
    vertices = resolve.cluster_ids(resolve.premerge(_mentions(spark, d)))
    clusters = vertices.select("doc_id", "id", tx.normalize_name(F.col("canonical_name")).alias("cluster_id"))
    none = vertices.limit(0).selectExpr("doc_id", "id AS head_id", "type", "id AS tail_id", "0D AS confidence", "evidence", "ord")
    made, _ = relations.consolidated(vertices, none, clusters)
    return made.select(F.col("cluster_id").alias("cluster"), F.array_join("aliases", "|").alias("aliases"), F.array_join("doc_ids", "|").alias("doc_ids"), F.size("evidence").alias("n_evidence"))


# Decisions


@query(
    "item_decision_verdicts",
    f"""WITH {SCORES.format(on='q.id % 20 = 0')}, best AS (SELECT *, (query_id + id) % 3 = 0 AS said FROM ranked r WHERE rank <= 10 AND id <> query_id QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY rank) = 1),
j AS (SELECT *, score >= 0.45 OR (score >= 0.25 AND said) AS hit FROM best) SELECT query_id, CASE WHEN hit THEN 'match' ELSE 'no_match' END AS decision, CASE WHEN hit THEN id::VARCHAR END AS target_id, score FROM j""",
)
def item_decision_verdicts(spark, d):
    v = _vectors(spark, d)
    asked = knn.nearest(v.where("id % 20 = 0"), v).where("id <> query_id")
    verdicts = asked.select(F.col("query_id").alias("id_a"), F.col("id").alias("id_b"), F.when((F.col("query_id") + F.col("id")) % 3 == 0, "yes").otherwise("no").alias("verdict"))
    return knn.decide_items(v.where("id % 20 = 0"), v, match=0.45, low=0.25, verdicts=verdicts).withColumn("target_id", F.col("target_id").cast("string"))


#: The newest 5,000 documents are the window; two signatures of 128 that agree in 0.9 share one of 32 bands at least.
@query(
    "recent_match",
    f"""WITH {SIGNED}, recent AS (SELECT doc_id, doc_id % 31 AS day, sig FROM documents JOIN signed USING (doc_id) WHERE doc_id IN (SELECT doc_id FROM documents ORDER BY doc_id % 31 DESC, doc_id LIMIT 5000)),
p AS (SELECT n.doc_id, r.doc_id AS old, r.day FROM signed n JOIN recent r ON n.doc_id <> r.doc_id AND n.doc_id % 20 = 0 WHERE len(list_filter(list_zip(n.sig, r.sig), lambda p: p[1] = p[2])) >= 0.9 * 128)
SELECT d.doc_id, (arg_max(old, day * 1000000000 - old))::VARCHAR AS match FROM documents d LEFT JOIN p USING (doc_id) WHERE d.doc_id % 20 = 0 GROUP BY 1""",
)
def recent_match(spark, d):
    docs = t(spark, d, "documents")
    # Only what is asked for and what is in the window is signed.
    signed = lambda rows: similarity.signatures(similarity.shingle_sets(rows))
    window = written(newest(docs.select(F.col("doc_id").alias("id"), (F.col("doc_id") % 31).alias("date"))), "window")
    held = docs.join(window.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")
    asked, recent = written(signed(docs.where("doc_id % 20 = 0")), "asked"), written(signed(held).join(window, "id"), "recent")
    found = similarity.first_recent(asked, recent)
    return found.select(F.col("id").alias("doc_id"), F.col("match").cast("string").alias("match"))


@query(
    "sorted_labels",
    "SELECT user_id AS doc_id, string_agg(event_type, '|' ORDER BY value DESC, event_id) AS labels FROM events GROUP BY 1",
)
def sorted_labels(spark, d):
    scores = t(spark, d, "events").select(F.col("user_id").alias("doc_id"), F.col("event_id").alias("pos"), F.col("event_type").alias("hypothesis"), F.col("value").alias("score"))
    return scoring.sorted_labels(scores).select("doc_id", F.array_join("labels", "|").alias("labels"))


# Requests


@query(
    "requests_checked",
    r"SELECT doc_id, coalesce(CASE WHEN length(trim(coalesce(text, ''))) = 0 THEN 'blank text' END, CASE WHEN doc_id % 9 = 0 THEN 'nothing asked' END, '') AS reason, md5(coalesce(source || chr(10), '') || coalesce(lang, '')) AS head FROM documents",
)
def requests_checked(spark, d):
    asked = F.when(F.col("doc_id") % 9 != 0, F.array(F.lit("x")))
    return t(spark, d, "documents").select("doc_id", F.coalesce(tx.rejection(F.col("text"), asked), F.lit("")).alias("reason"), F.md5(tx.head_sum(F.col("source"), F.coalesce("lang", F.lit(""))).cast("binary")).alias("head"))


@query(
    "geo_context",
    "WITH f AS (SELECT c_nationkey::BIGINT AS doc_id, c_mktsegment || c_custkey % 4 AS city, min(c_custkey) AS o FROM customer GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY o) AS k FROM f) SELECT doc_id, string_agg(city, ', ' ORDER BY o) AS geo_context FROM r WHERE k <= 5 GROUP BY 1",
)
def geo_context(spark, d):
    rows = t(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("doc_id"), F.col("c_custkey").alias("ord"), F.concat("c_mktsegment", (F.col("c_custkey") % 4).cast("string")).alias("city_name"))
    return geotag.geo_context(rows)


@query(
    "prompts_rendered",
    "SELECT conv_id, turn, CASE WHEN text IS NOT NULL AND role IS NOT NULL THEN md5('{' || role || '} says: ' || text) END AS digest, CASE WHEN role IS NULL AND text IS NULL THEN 'missing field: role, text' WHEN role IS NULL THEN 'missing field: role' WHEN text IS NULL THEN 'missing field: text' END AS reason FROM conversations",
)
def prompts_rendered(spark, d):
    rows = t(spark, d, "conversations").withColumn("id", F.struct("conv_id", "turn"))
    made = summarize.rendered(rows, "{{{role}}} says: {text}")
    return made.select("id.conv_id", "id.turn", F.md5(F.col("prompt").cast("binary")).alias("digest"), "reason")
