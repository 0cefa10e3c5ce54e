"""Queries of sources and sinks, of small text columns, of parsed answers and of the pipelines' last steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import places, resolve, schema
from ..shared import shared_folder
from ..sources import config, gazetteer, tables
from . import news, relations
from .catalogue import MENTIONS, _labels, _mentions, _sql_labels, articles_of, query, sql_name, t

# Sources and sinks

#: Dump lines of suppliers: every seventh is too short, every third of another class, some populations are no numbers.
SUPPLIED = "s_suppkey % 7 <> 0 AND s_suppkey % 3 <> 2"


@query(
    "gazetteer_dump",
    f"SELECT s_suppkey AS entry_id, s_name AS name, (s_suppkey * 37 % 180 - 90)::DOUBLE AS lat, CASE WHEN s_suppkey % 3 = 0 THEN 'A' ELSE 'P' END AS feature_class, CASE WHEN s_suppkey % 5 = 0 THEN 0 ELSE s_nationkey * 10 END::BIGINT AS population FROM supplier WHERE {SUPPLIED} AND (s_suppkey % 11 <> 0 OR s_suppkey % 5 = 0)",
)
def gazetteer_dump(spark, d):
    k = F.col("s_suppkey")
    said = F.when(k % 5 == 0, "").when(k % 11 == 0, "many").otherwise((F.col("s_nationkey") * 10).cast("string"))
    fields = {0: k, 1: F.col("s_name"), 2: F.col("s_name"), 4: k * 37 % 180 - 90, 5: k * 91 % 360 - 180, 6: F.when(k % 3 == 0, "A").when(k % 3 == 1, "P").otherwise("S"), 14: said}
    whole = F.concat_ws("\t", *(fields.get(i, F.lit("")).cast("string") for i in range(19)))
    dump, kept = shared_folder(spark, "dump"), shared_folder(spark, "gazetteer")
    t(spark, d, "supplier").select(F.when(k % 7 == 0, F.concat_ws("\t", k.cast("string"), "s_name")).otherwise(whole).alias("value")).write.text(dump)
    gazetteer.write_table(gazetteer.read_dump(spark, dump), kept)
    return gazetteer.read_table(spark, kept).select("entry_id", "name", "lat", "feature_class", "population")


@query("collection_scan", "SELECT doc_id, n_chars FROM documents WHERE lang = 'en'")
def collection_scan(spark, d):
    return tables.scan(spark, f"{d}/documents.parquet", ["doc_id", "n_chars"], lang="en")


@query("recent_window", "SELECT doc_id, source FROM documents ORDER BY doc_id % 31 DESC, doc_id LIMIT 5000")
def recent_window(spark, d):
    dated = t(spark, d, "documents").select("doc_id", "source", (F.col("doc_id") % 31).alias("date"))
    return tables.newest(dated, tie="doc_id").select("doc_id", "source")


@query(
    "partition_upsert",
    "WITH fresh AS (SELECT o_custkey AS doc_id, o_orderkey AS ord, 'new' AS state FROM orders WHERE o_custkey % 3 = 0 AND o_orderkey % 2 = 0) SELECT o_custkey AS doc_id, o_orderkey AS ord, 'old' AS state FROM orders WHERE o_custkey NOT IN (SELECT doc_id FROM fresh) UNION ALL SELECT * FROM fresh",
)
def partition_upsert(spark, d):
    rows = t(spark, d, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("ord"))
    fresh = rows.where("doc_id % 3 = 0 AND ord % 2 = 0").withColumn("state", F.lit("new"))
    path = shared_folder(spark, "upserted")
    tables.upsert_partitions(rows.withColumn("state", F.lit("old")), path, buckets=16)
    for _ in range(2):  # the second time changes nothing
        tables.upsert_partitions(fresh, path, buckets=16)
    return spark.read.parquet(path).select("doc_id", "ord", "state")


@query(
    "taxonomy_rows",
    """WITH topics AS (SELECT 'topic' AS kind, row_number() OVER (ORDER BY source) - 1 AS pos, source AS hypothesis, 0.5::DOUBLE AS threshold FROM (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL)),
scopes AS (SELECT 'scope', row_number() OVER (ORDER BY lang) - 1, lang || ': written in ' || lang, 0.35 FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)),
banned AS (SELECT 'black', row_number() OVER (ORDER BY source) - 1, 'Adverts of ' || source, 0.8 FROM (SELECT source FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 AND source IS NOT NULL GROUP BY 1))
SELECT kind, pos::INT AS pos, hypothesis, threshold FROM topics UNION ALL SELECT * FROM scopes UNION ALL SELECT * FROM banned UNION ALL SELECT 'white', 0, 'about a city', 0.4""",
)
def taxonomy_rows(spark, d):
    """A taxonomy whose topics are the sources, scopes the languages, and blacklist the sources of toxic texts: few, whatever the table's size."""
    docs = t(spark, d, "documents")

    def names(df, c: str) -> list[str]:
        found = [r[c] for r in df.where(F.col(c).isNotNull()).select(c).distinct().orderBy(c).limit(10_001).collect()]
        if len(found) > 10_000:
            raise ValueError(f"more than 10,000 values of {c} are no taxonomy")
        return found

    bad = docs.join(t(spark, d, "labels").where("toxic = 1"), "doc_id")
    taxonomy = {"labels": names(docs, "source"), "relevance_hypothesis": " about a city ", "blacklist_labels": [f"Adverts of {s}" for s in names(bad, "source")], "scope_hypotheses": {x: f"written in {x} " for x in names(docs, "lang")}, "top_k": 2, "blacklist_threshold": 0.8}
    return config.hypotheses(spark, taxonomy)


# Text columns


@query(
    "street_spans",
    """WITH c AS (SELECT c_custkey AS doc_id, length(c_name) + 9 AS s, 'Calle Mayor ' || c_custkey AS one, 'Plaza Nueva ' || c_nationkey AS two FROM customer)
SELECT doc_id, 0 AS ord, one AS text, s::INT AS start_char, (s + length(one))::INT AS end_char, 'street' AS hint FROM c UNION ALL SELECT doc_id, 1, two, (s + length(one) + 10)::INT, (s + length(one) + 10 + length(two))::INT, 'street' FROM c""",
)
def street_spans(spark, d):
    said = F.concat("c_name", F.lit(" vive en Calle Mayor "), F.col("c_custkey").cast("string"), F.lit(", piso 2; Plaza Nueva "), F.col("c_nationkey").cast("string"), F.lit("."))
    return places.street_spans(t(spark, d, "customer").select(F.col("c_custkey").alias("doc_id"), said.alias("text")))


@query(
    "text_pieces",
    r"""SELECT doc_id, md5(CASE WHEN length(source) > 0 THEN source || '. ' || text ELSE text END) AS premise, CASE WHEN length(lang) > 0 THEN 'Lang: ' || lang ELSE '' END AS line,
replace('from {} to {}', '{}', coalesce(source, '')) AS filled, '- ' || coalesce(source, '') || chr(10) || '- ' || coalesce(lang, '') AS bullets,
contains(lower(source), lower(lang)) OR contains(lower(lang), lower(source)) AS alike FROM documents""",
)
def text_pieces(spark, d):
    source, lang, known = F.col("source"), F.col("lang"), lambda c: F.coalesce(c, F.lit(""))
    return t(spark, d, "documents").select(
        "doc_id",
        F.md5(tx.premise(source, F.col("text")).cast("binary")).alias("premise"),
        tx.labelled_line("Lang", lang).alias("line"),
        tx.filled("from {} to {}", known(source)).alias("filled"),
        tx.bullets(F.array(known(source), known(lang))).alias("bullets"),
        tx.names_match(source, lang).alias("alike"),
    )


# Answers

#: Line items as entities of three types, and one relation type that not all of them may stand in.
ASKED = schema.ExtractionSchema((schema.EntityType("A"), schema.EntityType("N"), schema.EntityType("R")), (schema.RelationType("O", "", ("A", "N"), ("R", "N")),))


@query(
    "extracted_relations",
    """WITH e AS (SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS pos, l_returnflag AS type, l_partkey::VARCHAR AS name FROM lineitem),
r AS (SELECT l_orderkey AS doc_id, l_linenumber - 1 AS head, (l_suppkey % 9)::BIGINT AS tail, l_linestatus AS type FROM lineitem)
SELECT r.doc_id, r.head::BIGINT AS head, r.tail, r.type, h.name AS head_name, t.name AS tail_name FROM r JOIN e h ON h.doc_id = r.doc_id AND h.pos = r.head JOIN e t ON t.doc_id = r.doc_id AND t.pos = r.tail
WHERE r.type = 'O' AND h.type IN ('A', 'N') AND t.type IN ('R', 'N') AND r.doc_id % 10 <> 0""",
)
def extracted_relations(spark, d):
    from ..operators.extract import placed_relations

    listed = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus")))
    per = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(listed.alias("lines"))
    entities = F.transform("lines", lambda x: F.struct(x["l_partkey"].cast("string").alias("name"), x["l_returnflag"].alias("type")))
    ends = F.transform("lines", lambda x: F.struct((x["l_linenumber"] - 1).alias("head"), (x["l_suppkey"] % 9).alias("tail"), x["l_linestatus"].alias("type")))
    text = F.to_json(F.struct(F.lit("because").alias("reasoning"), entities.alias("entities"), ends.alias("relations")))
    answers = per.select("doc_id", F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("Sorry: "), text)).otherwise(text).alias("answer"))
    good = schema.parsed(answers, ASKED).where("status = 'ok'")
    found = placed_relations(good, schema.rules(spark, ASKED), "doc_id")
    return found.select("doc_id", "head", "tail", "type", "head_name", "tail_name")


@query(
    "ner_assembled",
    """WITH l AS (SELECT l_orderkey AS doc_id, l_linenumber // 3 AS chunk_no, row_number() OVER (PARTITION BY l_orderkey, l_linenumber // 3 ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS k, l_returnflag AS type, l_partkey::VARCHAR AS name, l_linestatus AS rel, l_suppkey % 4 - 1 AS t FROM lineitem WHERE (l_orderkey + l_linenumber // 3) % 10 <> 0),
e AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY chunk_no, k) - 1 AS pos, count(*) OVER (PARTITION BY doc_id, chunk_no) AS n FROM l)
SELECT h.doc_id, h.pos AS ord, h.pos AS head, t.pos AS tail, h.name AS head_name, t.name AS tail_name FROM e h JOIN e t ON t.doc_id = h.doc_id AND t.chunk_no = h.chunk_no AND t.k = h.t
WHERE h.rel = 'O' AND h.type IN ('A', 'N') AND t.type IN ('R', 'N')""",
)
def ner_assembled(spark, d):
    """Answers made of line items, in chunks: every tenth malformed, some ends outside their chunk."""
    from ..operators.extract import assembled

    listed = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", "l_linestatus")))
    per = t(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id"), F.floor(F.col("l_linenumber") / 3).alias("chunk_no")).agg(listed.alias("lines"))
    entities = F.transform("lines", lambda x: F.struct(x["l_partkey"].cast("string").alias("name"), x["l_returnflag"].alias("type")))
    ends = F.transform("lines", lambda x, i: F.struct(i.alias("head"), (x["l_suppkey"] % 4 - 1).alias("tail"), x["l_linestatus"].alias("type")))
    text = F.to_json(F.struct(F.lit("because").alias("reasoning"), entities.alias("entities"), ends.alias("relations")))
    bad = (F.col("doc_id") + F.col("chunk_no")) % 10 == 0
    answers = per.select("doc_id", "chunk_no", F.when(bad, F.concat(F.lit("Sorry: "), text)).otherwise(text).alias("answer"))
    return assembled(answers, ASKED)[1].select("doc_id", "ord", "head", "tail", "head_name", "tail_name")


@query(
    "storage_versions",
    "SELECT 1 AS version, p_partkey::VARCHAR AS id, p_name AS name, p_size::DOUBLE AS size, NULL::VARCHAR AS colour FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT 2, p_partkey::VARCHAR, p_name, NULL, split_part(p_name, ' ', 1) FROM part WHERE p_partkey % 2 = 1",
)
def storage_versions(spark, d):
    """Two versions of one table; the second schema has an attribute that the first lacks."""
    first = schema.ExtractionSchema((schema.EntityType("PART", "", (), (schema.Attribute("size", "number"),)),))
    second = schema.ExtractionSchema((schema.EntityType("PART", "", (), (schema.Attribute("size", "number"), schema.Attribute("colour", "string"))),))
    part, path = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_size").cast("double").alias("size"), F.col("p_partkey").alias("k")), shared_folder(spark, "storage")
    schema.append_version(part.where("k % 2 = 0"), first, path, 1)
    schema.append_version(part.where("k % 2 = 1").drop("size").withColumn("colour", F.substring_index("name", " ", 1)), second, path, 2)
    return schema.read_versions(spark, path, second).select("version", "id", "name", "size", "colour")


# The pipelines' last steps


@query(
    "merged_attributes",
    """WITH a AS (SELECT p_name AS cluster_id, 'size' AS name, CASE WHEN p_size % 5 <> 0 THEN p_size::VARCHAR END AS value, p_retailprice AS confidence, p_partkey AS ord FROM part UNION ALL SELECT p_name, 'kind', p_type, 1 / p_retailprice, p_partkey FROM part),
b AS (SELECT cluster_id, name, value FROM a WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY cluster_id, name ORDER BY confidence DESC, ord) = 1),
m AS (SELECT cluster_id, string_agg(name || '=' || value, '|' ORDER BY name) AS attributes FROM b GROUP BY 1)
SELECT DISTINCT p_name AS cluster_id, coalesce(attributes, '') AS attributes FROM part LEFT JOIN m ON m.cluster_id = p_name""",
)
def merged_attributes(spark, d):
    part = t(spark, d, "part")
    fact = lambda name, value, confidence: part.select(F.col("p_name").alias("cluster_id"), F.lit(name).alias("name"), value.alias("value"), confidence.alias("confidence"), F.col("p_partkey").alias("ord"))
    facts = fact("size", F.when(F.col("p_size") % 5 != 0, F.col("p_size").cast("string")), F.col("p_retailprice")).union(fact("kind", F.col("p_type"), 1 / F.col("p_retailprice")))
    found = resolve.with_attributes(part.select(F.col("p_name").alias("cluster_id")).distinct(), facts, "cluster_id")
    pairs = F.transform(F.array_sort(F.map_entries("attributes")), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.select("cluster_id", F.array_join(pairs, "|").alias("attributes"))


@query(
    "consolidated_edges",
    f"""WITH {MENTIONS}, c AS (SELECT doc_id, no, {sql_name('canonical_name')} AS cluster FROM ids), e AS (SELECT i.doc_id, i.no AS head, i.no + 1 AS tail, i.no % 3 AS type, i.no % 7 / 8.0 AS confidence FROM ids i)
SELECT h.cluster AS head, e.type::VARCHAR AS type, t.cluster AS tail, max(confidence)::DOUBLE AS confidence, count(*)::INT AS n_evidence, string_agg(DISTINCT e.doc_id, '|' ORDER BY e.doc_id) AS doc_ids
FROM e JOIN c h ON h.doc_id = e.doc_id AND h.no = e.head JOIN c t ON t.doc_id = e.doc_id AND t.no = e.tail GROUP BY 1, 2, 3""",
)
def consolidated_edges(spark, d):
    vertices = resolve.cluster_ids(resolve.premerge(_mentions(spark, d)))
    clusters = vertices.select("doc_id", "id", tx.normalize_name(F.col("canonical_name")).alias("cluster_id"))
    no = F.col("id").cast("long")
    edges = vertices.select("doc_id", F.col("id").alias("head_id"), (no % 3).cast("string").alias("type"), (no + 1).cast("string").alias("tail_id"), (no % 7 / 8).alias("confidence"), F.array(F.lit("said")).alias("evidence"), "ord")
    _, merged = relations.consolidated(vertices, edges, clusters)
    return merged.select("head", "type", "tail", "confidence", F.size("evidence").alias("n_evidence"), F.array_join("doc_ids", "|").alias("doc_ids"))


STATES = "states AS (SELECT doc_id, doc_id - doc_id % 5 AS cluster_id, CASE WHEN doc_id % 5 <> 0 THEN 'duplicate' WHEN doc_id % 3 = 0 THEN 'out_of_scope' ELSE 'indexed' END AS status FROM documents)"


def _states(spark, d):
    k = F.col("doc_id")
    return t(spark, d, "documents").select("doc_id", (k - k % 5).alias("cluster_id"), F.when(k % 5 != 0, "duplicate").when(k % 3 == 0, "out_of_scope").otherwise("indexed").alias("status"))


@query(
    "news_index",
    f"""WITH {STATES}, r AS (SELECT s.cluster_id, doc_id AS ord, source FROM documents JOIN states s USING (doc_id) WHERE s.cluster_id IN (SELECT cluster_id FROM states WHERE status = 'indexed')), f AS (SELECT cluster_id, source, min(ord) AS o FROM r GROUP BY ALL)
SELECT cluster_id, min(o) AS ord, string_agg(coalesce(source, '?'), '|' ORDER BY o) AS sources FROM f GROUP BY 1""",
)
def news_index(spark, d):
    articles = articles_of(t(spark, d, "documents"))
    odd = F.col("ord") % 2 == 1
    states = _states(spark, d)
    # One half is the older index, the other is merged into it; sources are put in order at the end.
    whole = news.index_articles(articles, states)
    old = news.index_articles(articles.where(~odd), states)
    both = news.index_articles(articles.where(odd), states, old).select("cluster_id", F.col("ord").alias("first"), F.array_sort("sources").alias("held"))
    same = whole.join(both, "cluster_id").where((F.col("first") == F.col("ord")) & F.array_sort("sources").eqNullSafe(F.col("held")))
    return same.select("cluster_id", "ord", F.array_join("sources", "|", "?").alias("sources"))


@query(
    "news_enriched",
    f"""WITH {STATES}, p AS (SELECT o_custkey AS doc_id, o_orderkey AS ord, CASE WHEN o_orderkey % 2 = 0 THEN 'region' ELSE 'city' END AS type, o_orderkey % 6 + 1 AS g FROM orders),
one AS (SELECT doc_id, type, type || ':' || g AS place_key, min(ord) AS ord FROM p GROUP BY ALL), per AS (SELECT doc_id, string_agg(place_key, '|' ORDER BY ord) AS places, bool_or(type = 'city') AS city, bool_or(type = 'region') AS region FROM one GROUP BY 1),
k AS (SELECT doc_id, string_agg(hypothesis, '|' ORDER BY rank) AS topics FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS rank FROM ({_sql_labels(20, 'topic')}) WHERE score >= 0.5) WHERE rank <= 3 GROUP BY 1),
b AS (SELECT doc_id, hypothesis, score FROM ({_sql_labels(3, 'scope')}) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) = 1)
SELECT doc_id, coalesce(places, '') AS places, coalesce(topics, '') AS topics, CASE WHEN score >= 0.35 THEN hypothesis WHEN coalesce(city, false) THEN 'city' WHEN coalesce(region, false) THEN 'regional' ELSE 'national' END AS scope
FROM states LEFT JOIN per USING (doc_id) LEFT JOIN k USING (doc_id) LEFT JOIN b USING (doc_id) WHERE status = 'indexed'""",
)
def news_enriched(spark, d):
    k, g = F.col("o_orderkey"), F.col("o_orderkey") % 6 + 1
    kind, none = F.when(k % 2 == 0, "region").otherwise("city"), lambda kind: F.lit(None).cast(kind)
    spots = t(spark, d, "orders").select(
        F.col("o_custkey").alias("doc_id"), k.alias("ord"), kind.alias("type"), F.lit("x").alias("text"), none("string").alias("name"), F.when(k % 2 == 0, g).alias("geonames_id"),
        F.when(k % 2 == 1, g).alias("city_id"), none("string").alias("city_name"), none("array<bigint>").alias("edge_ids"), none("double").alias("lat"), none("double").alias("lon"),
    )
    found = news.enriched(_states(spark, d), spots, _labels(spark, d, 20, "topic"), _labels(spark, d, 3, "scope"))
    joined = lambda c: F.coalesce(F.array_join(c, "|"), F.lit("")).alias(c)
    return found.select("doc_id", joined("places"), joined("topics"), "scope")
