"""Queries over the standard tables, each beside the DuckDB SQL that gives the same rows.

``query(name, sql)`` registers a function of (spark, sf_dir). All run over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as tx
from ..operators import knn, merge, places, resolve, scoring, similarity
from ..operators.graph import connected_components
from ..shared import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return put


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def texts(spark: SparkSession, d: str) -> DataFrame:
    """``documents``, dealt out where they come in fewer splits than there are cores; more splits stay as they are."""
    docs, cores = t(spark, d, "documents").select("doc_id", "text"), spark.sparkContext.defaultParallelism
    return docs.repartition(cores) if docs.rdd.getNumPartitions() < cores else docs


# SQL fragments


def sql_words(x: str) -> str:
    return rf"list_filter(string_split_regex({x}, '\s+'), lambda w: w <> '')"


SETS = f"""
docs AS (SELECT doc_id, {sql_words("strip_accents(lower(coalesce(text, '')))")} AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
                         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM docs),
classes AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY list_sort(s)) AS rep FROM sets WHERE len(s) > 0),
reps AS (SELECT doc_id, s FROM sets JOIN classes USING (doc_id) WHERE doc_id = rep),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM reps),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common, count(*)::DOUBLE / (a.n + b.n - count(*)) AS jaccard
  FROM items a JOIN items b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING count(*)::DOUBLE / (a.n + b.n - count(*)) >= 0.9)"""


def sql_reach(edges: str, nodes: str) -> str:
    """Components by closure: reach(x, y)."""
    return f"edges AS ({edges}), reach(x, y) AS (SELECT id, id FROM ({nodes}) UNION SELECT r.x, e.b FROM reach r JOIN edges e ON e.a = r.y)"


# Near-duplicate texts


@query("neardup_classes", f"WITH {SETS} SELECT doc_id, rep FROM classes")
def neardup_classes(spark, d):
    return similarity.classes(similarity.hashed_sets(texts(spark, d))).withColumnRenamed("id", "doc_id")


@query("neardup_pairs_exact", f"WITH {SETS} SELECT a, b, common::BIGINT AS common, round(jaccard, 9) AS jaccard FROM pairs")
def neardup_pairs_exact(spark, d):
    sets = written(similarity.hashed_sets(texts(spark, d)), "sets")
    reps = similarity.representatives(sets, written(similarity.classes(sets), "classes"))
    return similarity.jaccard_pairs(reps).withColumn("jaccard", F.round("jaccard", 9))


@query(
    "neardup_clusters",
    f"WITH RECURSIVE {SETS}, {sql_reach('SELECT a, b FROM pairs UNION SELECT b, a FROM pairs UNION SELECT doc_id, rep FROM classes UNION SELECT rep, doc_id FROM classes', 'SELECT doc_id AS id FROM docs')} SELECT x AS doc_id, min(y) AS cluster_id FROM reach GROUP BY x",
)
def neardup_clusters(spark, d):
    return similarity.near_duplicate_clusters(texts(spark, d))


SIGNED = f"""{SETS},
hashed AS (SELECT doc_id, ('0x' || substr(md5(unnest(s)), 1, 8))::UBIGINT AS h FROM sets),
mins AS (SELECT doc_id, i, min(((1 + (i * 2654435761 + 12345) % 2147483646)::UBIGINT * h + ((i * 2634445 + 7919) % 2147483647)::UBIGINT) % 2147483647::UBIGINT)::BIGINT AS m
  FROM hashed CROSS JOIN (SELECT unnest(range(128)) AS i) GROUP BY doc_id, i),
signed AS (SELECT doc_id, list(m ORDER BY i) AS sig FROM mins GROUP BY doc_id)"""


@query("minhash_signatures", f"WITH {SIGNED} SELECT d.doc_id, coalesce(len(sig), 0)::INT AS n, md5(coalesce(array_to_string(sig, ','), '')) AS digest FROM documents d LEFT JOIN signed USING (doc_id)")
def minhash_signatures(spark, d):
    signed = similarity.signed_texts(texts(spark, d))
    return signed.select(F.col("id").alias("doc_id"), F.size("signature").alias("n"), F.md5(F.array_join(F.col("signature").cast("array<string>"), ",").cast("binary")).alias("digest"))


@query(
    "minhash_pairs",
    f"""WITH {SIGNED}, s AS (SELECT doc_id, sig FROM signed JOIN reps USING (doc_id)),
bands AS (SELECT doc_id, k, sig[4 * k + 1:4 * k + 4] AS key FROM s CROSS JOIN (SELECT unnest(range(32)) AS k)),
near AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM bands x JOIN bands y ON x.k = y.k AND x.key = y.key AND x.doc_id < y.doc_id),
scored AS (SELECT a, b, len(list_filter(list_zip(x.sig, y.sig), lambda p: p[1] = p[2])) / 128.0 AS agreement FROM near JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b)
SELECT a, b, agreement::DOUBLE AS agreement FROM scored WHERE agreement >= 0.9""",
)
def minhash_pairs(spark, d):
    signed = written(similarity.signed_texts(texts(spark, d)), "signatures")
    reps = signed.where("key is not null").groupBy("key").agg(F.min("id").alias("id")).select("id")
    return similarity.banded_pairs(written(signed.join(reps, "id", "left_semi").select("id", "signature"), "representatives"))


def _item_sets(table: str, key: str) -> str:
    return f"SELECT {key}, unnest(list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM (SELECT {key}, {sql_words(chr(115) + 'trip_accents(lower(text))')} AS w FROM {table})"


@query(
    "benchmark_overlap",
    f"""WITH p AS ({_item_sets("benchmark", "item_id")}), q AS ({_item_sets("documents", "doc_id")}), n AS (SELECT item_id, count(*) AS size FROM p GROUP BY 1)
SELECT doc_id, item_id, count(*)::BIGINT AS n_common, round(count(*)::DOUBLE / size, 9) AS containment FROM q JOIN p USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id, size HAVING count(*) >= 0.8 * size""",
)
def benchmark_overlap(spark, d):
    return similarity.containment(texts(spark, d), t(spark, d, "benchmark"), id_col="doc_id", item_col="item_id").withColumn("containment", F.round("containment", 9))


# Text


@query("normalize_text", "SELECT doc_id, md5(strip_accents(lower(text))) AS digest FROM documents")
def normalize_text(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(tx.normalize(F.col("text")).cast("binary")).alias("digest"))


LOST = ", ".join(f"'{w}'" for w in (*tx.LEGAL_FORMS, *tx.HONORIFICS))


def sql_name(x: str) -> str:
    plain = rf"""regexp_replace(lower(strip_accents({x})), '[.,;:"''()\[\]]', ' ', 'g')"""
    return f"array_to_string(list_filter({sql_words(plain)}, lambda w: w NOT IN ({LOST})), ' ')"


NAMES = "SELECT p_partkey AS k, p_name AS name FROM part UNION ALL SELECT c_custkey, 'Dr. ' || c_name || ' S.L.' FROM customer UNION ALL SELECT s_suppkey, 'Doña (' || s_name || '), Inc' FROM supplier"


def _names(spark, d):
    part = t(spark, d, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"))
    customer = t(spark, d, "customer").select("c_custkey", F.concat(F.lit("Dr. "), "c_name", F.lit(" S.L.")))
    supplier = t(spark, d, "supplier").select("s_suppkey", F.concat(F.lit("Doña ("), "s_name", F.lit("), Inc")))
    return part.union(customer).union(supplier)


@query("name_normalize", f"SELECT k, name, {sql_name('name')} AS key FROM ({NAMES})")
def name_normalize(spark, d):
    return _names(spark, d).select("k", "name", tx.normalize_name(F.col("name")).alias("key"))


@query("fingerprint_ws", f"SELECT doc_id, md5(array_to_string({sql_words('lower(text)')}, ' ')) AS print FROM documents")
def fingerprint_ws(spark, d):
    return t(spark, d, "documents").select("doc_id", F.md5(tx.fingerprint(F.col("text")).cast("binary")).alias("print"))


def sql_sentence_count(x: str) -> str:
    return rf"len(list_filter(string_split_regex({x}, '[.!?]+'), lambda p: regexp_replace(p, '\s+', '', 'g') <> ''))"


@query("word_sentence_counts", f"SELECT doc_id, len({sql_words('text')})::INT AS n_words, {sql_sentence_count('text')}::INT AS n_sentences FROM documents")
def word_sentence_counts(spark, d):
    return t(spark, d, "documents").select("doc_id", tx.word_count(F.col("text")).alias("n_words"), tx.sentence_count(F.col("text")).alias("n_sentences"))


@query(
    "length_validator",
    f"""WITH p AS (SELECT doc_id, split_part(text, chr(10), 1) AS h, substr(text, length(split_part(text, chr(10), 1)) + 2) AS s FROM documents),
n AS (SELECT doc_id, len({sql_words('h')}) AS w, {sql_sentence_count('s')} AS k FROM p)
SELECT doc_id, w BETWEEN 8 AND 15 AND k BETWEEN 2 AND 4 AS ok, CASE WHEN w NOT BETWEEN 8 AND 15 THEN 'headline ' || w || ' words, want 8-15' WHEN k NOT BETWEEN 2 AND 4 THEN 'summary ' || k || ' sentences, want 2-4' END AS reason FROM n""",
)
def length_validator(spark, d):
    from ..operators.summarize import length_check

    first = F.substring_index("text", "\n", 1)
    docs = t(spark, d, "documents").select("doc_id", first.alias("headline"), F.substring("text", F.length(first) + 2, F.length("text")).alias("summary"))
    ok, reason = length_check(F.col("headline"), F.col("summary"))
    return docs.select("doc_id", ok.alias("ok"), reason.alias("reason"))


@query(
    "reduce_budget_n",
    rf"""WITH p AS (SELECT doc_id, len({sql_words('text')}) AS w, list_filter(string_split(replace(text, chr(10), ' '), '. '), lambda p: regexp_replace(p, '\s+', '', 'g') <> '') AS s FROM documents)
SELECT doc_id, greatest(1, floor(400 / greatest(list_avg(list_transform(s, lambda x: len({sql_words('x')}))), 1)))::INT AS n FROM p WHERE w > 400 AND len(s) > 2""",
)
def reduce_budget_n(spark, d):
    from ..operators.summarize import sentence_budget

    return t(spark, d, "documents").select("doc_id", sentence_budget(F.col("text")).alias("n")).where("n is not null")


@query("numbered_evidence", "SELECT conv_id, string_agg(rn || '. ' || text, chr(10) ORDER BY rn) AS evidence_text FROM (SELECT conv_id, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) AS rn FROM conversations) GROUP BY conv_id")
def numbered_evidence(spark, d):
    turns = F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))))
    return t(spark, d, "conversations").groupBy("conv_id").agg(tx.numbered(F.transform(turns, lambda x: x["text"])).alias("evidence_text"))


@query("chunk_flatten", r"SELECT conv_id, turn, i - 1 AS chunk_no, s[i] AS text FROM (SELECT conv_id, turn, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT conv_id, turn, list_filter(string_split(replace(text, chr(10), ' '), '. '), lambda p: regexp_replace(p, '\s+', '', 'g') <> '') AS s FROM conversations))")
def chunk_flatten(spark, d):
    return t(spark, d, "conversations").select("conv_id", "turn", F.posexplode(tx.sentences(F.col("text"))).alias("chunk_no", "text")).withColumn("chunk_no", F.col("chunk_no").cast("long"))


@query("text_chunks", "SELECT doc_id, (k // 512)::BIGINT AS chunk_no, count(*)::BIGINT AS n_words FROM (SELECT doc_id, unnest(range(len(" + sql_words("text") + "))) AS k FROM documents) GROUP BY 1, 2")
def text_chunks(spark, d):
    from ..operators.summarize import chunks

    return chunks(t(spark, d, "documents")).select("doc_id", "chunk_no", tx.word_count(F.col("text")).cast("long").alias("n_words"))


# Vectors


def _vectors(spark, d):
    return t(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")


SCORES = """v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings),
scored AS (SELECT q.id AS query_id, r.id AS id, round(list_cosine_similarity(q.v, r.v), 6) AS score FROM v q JOIN v r ON {on}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored)"""


@query("cosine_topk", f"WITH {SCORES.format(on='q.id % 20 = 0')} SELECT query_id, id, score, rank::INT AS rank FROM ranked WHERE rank <= 10")
def cosine_topk(spark, d):
    v = _vectors(spark, d)
    return knn.nearest(v.where("id % 20 = 0"), v)


@query("cosine_topk_typed", f"WITH {SCORES.format(on='q.id % 20 = 0 AND q.label = r.label')} SELECT query_id, id, score, rank::INT AS rank FROM ranked WHERE rank <= 10")
def cosine_topk_typed(spark, d):
    v = _vectors(spark, d)
    return knn.nearest(v.where("id % 20 = 0"), v, type_col="label")


def _decisions(match: float) -> str:
    return f"WITH {SCORES.format(on='q.id % 20 = 0')}, best AS (SELECT * FROM ranked r WHERE rank <= 10 AND id <> query_id QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY rank) = 1) SELECT query_id, CASE WHEN score >= {match} THEN 'match' ELSE 'no_match' END AS decision, CASE WHEN score >= {match} THEN id::VARCHAR END AS target_id, score FROM best"


@query("item_decision", _decisions(0.35))
def item_decision(spark, d):
    v = _vectors(spark, d)
    return knn.decide_items(v.where("id % 20 = 0"), v, match=0.35, low=0.25).withColumn("target_id", F.col("target_id").cast("string"))


@query("item_decision_default", _decisions(0.92))
def item_decision_default(spark, d):
    v = _vectors(spark, d)
    return knn.decide_items(v.where("id % 20 = 0"), v).withColumn("target_id", F.col("target_id").cast("string"))


def _clusters(on: str) -> str:
    near = "SELECT query_id AS a, id AS b FROM ranked WHERE rank <= 10 AND id <> query_id AND score >= 0.35"
    return f"WITH RECURSIVE {SCORES.format(on=on)}, near AS ({near}), {sql_reach('SELECT a, b FROM near UNION SELECT b, a FROM near', 'SELECT id FROM v')} SELECT x AS id, min(y) AS cluster_id FROM reach GROUP BY x"


@query("corpus_clusters", _clusters("true"))
def corpus_clusters(spark, d):
    return knn.cluster_corpus(_vectors(spark, d), merge=0.35, low=0.25)


@query("corpus_clusters_by_type", _clusters("q.label = r.label"))
def corpus_clusters_by_type(spark, d):
    return knn.cluster_corpus(_vectors(spark, d), merge=0.35, low=0.25, type_col="label")


# Entity resolution: a brand is a document, a part is a mention of an entity

MENTIONS = f"""mentions AS (SELECT p_brand AS doc_id, p_partkey AS ord, CASE WHEN p_size % 3 = 0 THEN 'Mr. ' || p_name WHEN p_size % 3 = 1 THEN upper(p_name) ELSE p_name END AS name,
  p_type AS type, CASE WHEN p_size % 2 = 0 THEN 'size ' || p_size END AS subtype, p_container AS evidence FROM (SELECT *, p_name || ' ' || p_size AS p_container FROM part)),
keyed AS (SELECT *, {sql_name('name')} AS key FROM mentions),
candidates AS (SELECT doc_id, key, type, arg_max(name, length(name) * 1000000000 - ord) AS canonical_name, arg_min(subtype, ord) FILTER (length(subtype) > 0) AS subtype, list(evidence ORDER BY ord) AS evidence, min(ord) AS ord FROM keyed GROUP BY doc_id, key, type),
first_names AS (SELECT doc_id, key, type, name, min(ord) AS o FROM keyed GROUP BY ALL),
names AS (SELECT doc_id, key, type, list(name ORDER BY o) AS names FROM first_names GROUP BY ALL),
ids AS (SELECT c.*, names, (row_number() OVER (PARTITION BY doc_id ORDER BY type_ord, ord) - 1) AS no FROM (SELECT *, min(ord) OVER (PARTITION BY doc_id, type) AS type_ord FROM candidates) c JOIN names USING (doc_id, key, type)),
name_ids AS (SELECT doc_id, name, min(no)::VARCHAR AS id FROM (SELECT doc_id, no, unnest(names) AS name FROM ids) GROUP BY ALL)"""


def _mentions(spark, d):
    size = F.col("p_size")
    name = F.when(size % 3 == 0, F.concat(F.lit("Mr. "), "p_name")).when(size % 3 == 1, F.upper("p_name")).otherwise(F.col("p_name"))
    return t(spark, d, "part").select(F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("ord"), name.alias("name"), F.col("p_type").alias("type"), F.when(size % 2 == 0, F.concat(F.lit("size "), size.cast("string"))).alias("subtype"), F.concat_ws(" ", "p_name", size.cast("string")).alias("evidence"))


@query("premerge_entities", f"WITH {MENTIONS} SELECT doc_id, key, type, canonical_name, array_to_string(names, '|') AS names, subtype, md5(array_to_string(evidence, '|')) AS evidence, ord FROM ids")
def premerge_entities(spark, d):
    found = resolve.premerge(_mentions(spark, d))
    return found.select("doc_id", "key", "type", "canonical_name", F.array_join("names", "|").alias("names"), "subtype", F.md5(F.array_join("evidence", "|").cast("binary")).alias("evidence"), "ord")


@query("cluster_ids", f"WITH {MENTIONS} SELECT doc_id, no::VARCHAR AS id, canonical_name, type FROM ids")
def cluster_ids(spark, d):
    return resolve.cluster_ids(resolve.premerge(_mentions(spark, d))).select("doc_id", "id", "canonical_name", "type")


@query("name_first_id", f"WITH {MENTIONS} SELECT * FROM name_ids")
def name_first_id(spark, d):
    return resolve.name_map(resolve.cluster_ids(resolve.premerge(_mentions(spark, d))))


LEFT = "clusters AS (SELECT doc_id, type, (ord // 50)::BIGINT AS cluster_ord, ord AS candidate_ord FROM candidates WHERE ord % 3 <> 0 UNION ALL SELECT doc_id, type, 99999, -1 FROM candidates WHERE ord % 7 = 0)"


@query(
    "leftover_singletons",
    f"""WITH {MENTIONS}, {LEFT}, held AS (SELECT c.* FROM clusters c SEMI JOIN candidates k ON c.doc_id = k.doc_id AND c.type = k.type AND c.candidate_ord = k.ord),
last AS (SELECT doc_id, type, max(cluster_ord) AS last FROM held GROUP BY ALL), rest AS (SELECT doc_id, type, ord FROM candidates k ANTI JOIN held h ON h.doc_id = k.doc_id AND h.type = k.type AND h.candidate_ord = k.ord)
SELECT * FROM held UNION ALL SELECT doc_id, type, coalesce(last, -1) + row_number() OVER (PARTITION BY doc_id, type ORDER BY ord), ord FROM rest LEFT JOIN last USING (doc_id, type)""",
)
def leftover_singletons(spark, d):
    found = resolve.premerge(_mentions(spark, d))
    clusters = found.where("ord % 3 <> 0").selectExpr("doc_id", "type", "ord div 50 AS cluster_ord", "ord AS candidate_ord")
    clusters = clusters.union(found.where("ord % 7 = 0").selectExpr("doc_id", "type", "99999L", "-1L"))
    return resolve.with_leftovers(found, clusters)



@query("unresolved_edge_drop", f"WITH {MENTIONS}, nexts AS (SELECT *, lead(name) OVER (PARTITION BY doc_id ORDER BY ord) AS tail FROM mentions), relations AS (SELECT doc_id, ord, name AS head, CASE WHEN ord % 5 = 0 THEN 'nobody' ELSE tail END AS tail FROM nexts) SELECT r.doc_id, r.ord, r.head, r.tail, h.id AS head_id, t.id AS tail_id FROM relations r JOIN name_ids h ON h.doc_id = r.doc_id AND h.name = r.head JOIN name_ids t ON t.doc_id = r.doc_id AND t.name = r.tail")
def unresolved_edge_drop(spark, d):
    said = _mentions(spark, d)
    after = F.lead("name").over(Window.partitionBy("doc_id").orderBy("ord"))
    relations = said.select("doc_id", "ord", F.col("name").alias("head"), after.alias("after")).select("doc_id", "ord", "head", F.when(F.col("ord") % 5 == 0, "nobody").otherwise(F.col("after")).alias("tail"))
    names = resolve.name_map(resolve.cluster_ids(resolve.premerge(said)))
    return resolve.rewrite_edges(relations, names).select("doc_id", "ord", "head", "tail", "head_id", "tail_id")


@query(
    "edge_collapse",
    f"""WITH e AS (SELECT l_suppkey AS doc_id, l_orderkey * 100 + l_linenumber * 10 + l_partkey % 10 AS ord, l_partkey::VARCHAR AS head_id, l_returnflag AS type, l_linestatus AS tail_id, CASE WHEN l_linenumber % 2 = 0 THEN ' Flag  ' ELSE 'flag ' END || l_returnflag AS evidence, CASE WHEN l_quantity > 25 THEN 'bulk' END AS subtype, l_discount AS confidence, l_extendedprice::VARCHAR AS attributes FROM lineitem),
k AS (SELECT *, array_to_string({sql_words('lower(evidence)')}, ' ') AS print FROM e),
m AS (SELECT *, row_number() OVER (PARTITION BY doc_id, head_id, type, tail_id, print ORDER BY confidence DESC, ord) AS top, row_number() OVER (PARTITION BY doc_id, head_id, type, tail_id, print ORDER BY ord) AS first FROM k)
SELECT doc_id, head_id, type, tail_id, print, max(confidence) AS confidence, max(CASE WHEN top = 1 THEN ord END) AS attributes_of, max(CASE WHEN first = 1 THEN subtype END) AS subtype, count(*)::INT AS n_evidence, min(ord) AS ord FROM m GROUP BY ALL""",
)
def edge_collapse(spark, d):
    line = t(spark, d, "lineitem")
    evidence = F.concat(F.when(F.col("l_linenumber") % 2 == 0, " Flag  ").otherwise("flag "), "l_returnflag")
    ord_ = F.col("l_orderkey") * 100 + F.col("l_linenumber") * 10 + F.col("l_partkey") % 10
    edges = line.select(F.col("l_suppkey").alias("doc_id"), ord_.alias("ord"), F.col("l_partkey").cast("string").alias("head_id"), F.col("l_returnflag").alias("type"), F.col("l_linestatus").alias("tail_id"), evidence.alias("evidence"), F.when(F.col("l_quantity") > 25, "bulk").alias("subtype"), F.col("l_discount").alias("confidence"), ord_.alias("attributes"))
    found = resolve.collapse_edges(edges)
    return found.select("doc_id", "head_id", "type", "tail_id", "print", "confidence", F.col("attributes").alias("attributes_of"), "subtype", F.size("evidence").alias("n_evidence"), "ord")


@query(
    "relation_rule_check",
    """WITH e AS (SELECT l_orderkey AS doc_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS pos, l_returnflag AS type, l_partkey::VARCHAR AS name FROM lineitem),
r AS (SELECT l_orderkey AS doc_id, l_linenumber AS ord, l_linenumber - 1 AS head, (l_suppkey % 9)::BIGINT AS tail, l_linestatus AS type FROM lineitem)
SELECT r.doc_id, r.ord, r.type, h.name AS head_name, t.name AS tail_name FROM r JOIN e h ON h.doc_id = r.doc_id AND h.pos = r.head JOIN e t ON t.doc_id = r.doc_id AND t.pos = r.tail
WHERE (r.type = 'O' AND h.type IN ('A', 'N') AND t.type IN ('R', 'N'))""",
)
def relation_rule_check(spark, d):
    line = t(spark, d, "lineitem")
    pos = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")) - 1
    entities = line.select(F.col("l_orderkey").alias("doc_id"), pos.cast("long").alias("pos"), F.col("l_returnflag").alias("type"), F.col("l_partkey").cast("string").alias("name"))
    relations = line.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("ord"), (F.col("l_linenumber") - 1).cast("long").alias("head"), (F.col("l_suppkey") % 9).alias("tail"), F.col("l_linestatus").alias("type"))
    rules = spark.createDataFrame([("O", ["A", "N"], ["R", "N"])], "type string, head_types array<string>, tail_types array<string>")
    return resolve.valid_relations(relations, entities, rules).select("doc_id", "ord", "type", "head_name", "tail_name")


@query("attr_highest_conf", "WITH e AS (SELECT user_id, event_type AS name, json_extract_string(props, '$.k') AS value, value AS confidence, event_id AS ord FROM events) SELECT user_id, name, arg_max(value, (confidence * 100)::BIGINT * 1000000000 - ord) AS value, max(confidence) AS confidence FROM e WHERE value IS NOT NULL GROUP BY ALL")
def attr_highest_conf(spark, d):
    events = t(spark, d, "events").select("user_id", F.col("event_type").alias("name"), F.get_json_object("props", "$.k").alias("value"), F.col("value").alias("confidence"), F.col("event_id").alias("ord"))
    return resolve.best_values(events, "user_id")


@query(
    "cluster_merge",
    """WITH m AS (SELECT p_name AS cluster_id, p_brand AS doc_id, p_partkey AS ord, p_name || CASE WHEN p_size % 4 = 0 THEN ' ' || p_type ELSE '' END AS name, p_type AS type, p_size::VARCHAR AS subtype, p_brand || ':' || p_size AS evidence FROM part),
r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY length(name) DESC, ord) AS top FROM m)
SELECT cluster_id, max(CASE WHEN top = 1 THEN name END) AS canonical_name, max(CASE WHEN top = 1 THEN type END) AS type, max(CASE WHEN top = 1 THEN subtype END) AS subtype, array_to_string(list_sort(list_distinct(list(name))), '|') AS aliases, array_to_string(list_sort(list_distinct(list(doc_id))), '|') AS doc_ids, md5(string_agg(evidence, '|' ORDER BY ord)) AS evidence FROM r GROUP BY cluster_id""",
)
def cluster_merge(spark, d):
    size = F.col("p_size").cast("string")
    name = F.concat("p_name", F.when(F.col("p_size") % 4 == 0, F.concat(F.lit(" "), "p_type")).otherwise(""))
    members = t(spark, d, "part").select(F.col("p_name").alias("cluster_id"), F.col("p_brand").alias("doc_id"), F.col("p_partkey").alias("ord"), name.alias("name"), F.col("p_type").alias("type"), size.alias("subtype"), F.array(F.concat("p_brand", F.lit(":"), size)).alias("evidence"))
    found = resolve.merge_clusters(members)
    return found.select("cluster_id", "canonical_name", "type", "subtype", F.array_join("aliases", "|").alias("aliases"), F.array_join("doc_ids", "|").alias("doc_ids"), F.md5(F.array_join("evidence", "|").cast("binary")).alias("evidence"))


@query(
    "canonical_remap",
    "WITH canon AS (SELECT p_partkey AS member_id, min(p_partkey) OVER (PARTITION BY p_name) AS canonical_id FROM part) SELECT h.canonical_id AS head, t.canonical_id AS tail, count(*)::BIGINT AS n FROM lineitem l JOIN canon h ON h.member_id = l_partkey JOIN canon t ON t.member_id = l_suppkey GROUP BY 1, 2",
)
def canonical_remap(spark, d):
    first = t(spark, d, "part").groupBy("p_name").agg(F.min("p_partkey").alias("canonical_id"))
    canon = t(spark, d, "part").join(first, "p_name").select(F.col("p_partkey").alias("member_id"), "canonical_id")
    # Equal edges are counted first, so what the joins move is distinct ends only.
    edges = t(spark, d, "lineitem").groupBy(F.col("l_partkey").alias("head"), F.col("l_suppkey").alias("tail")).agg(F.count("*").alias("n"))
    return resolve.remap(edges, canon).groupBy(F.col("head_canonical").alias("head"), F.col("tail_canonical").alias("tail")).agg(F.sum("n").alias("n"))


# Scores

EVENT_SCORES = "s AS (SELECT user_id AS doc_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, event_type AS hypothesis, value AS score FROM events)"


def _scores(spark, d):
    pos = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return t(spark, d, "events").select(F.col("user_id").alias("doc_id"), pos.alias("pos"), F.col("event_type").alias("hypothesis"), F.col("value").alias("score"))


def _short(stop: str) -> str:
    return f"WITH {EVENT_SCORES}, f AS (SELECT *, coalesce(sum(CASE WHEN {stop} THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k FROM s) SELECT doc_id, pos::INT AS pos, hypothesis, score FROM f WHERE k = 0"


@query("short_circuit_and", _short("score < 10"))
def short_circuit_and(spark, d):
    return scoring.short_circuit(_scores(spark, d), 10.0)


@query("short_circuit_blacklist", _short("score >= 90"))
def short_circuit_blacklist(spark, d):
    return scoring.short_circuit(_scores(spark, d), 90.0, blacklist=True)


@query("gate_or_and_exclusion", "SELECT user_id AS doc_id, coalesce(bool_or(event_type <> 'error' AND value >= 150), false) AND NOT coalesce(bool_or(event_type = 'error' AND value >= 200), false) AS in_scope FROM events GROUP BY 1")
def gate_or_and_exclusion(spark, d):
    kind = F.when(F.col("event_type") == "error", "black").otherwise("white")
    return scoring.in_scope(t(spark, d, "events").select(F.col("user_id").alias("doc_id"), kind.alias("kind"), F.col("value").alias("score")), 150.0, 200.0)


def _sql_labels(n: int, salt: str) -> str:
    return f"SELECT doc_id, i AS pos, 'label' || i AS hypothesis, ('0x' || substr(md5(doc_id || ':{salt}:' || i), 1, 4))::INT / 65536.0 AS score FROM documents CROSS JOIN (SELECT unnest(range({n})) AS i)"


def _labels(spark, d, n: int, salt: str):
    at = t(spark, d, "documents").select("doc_id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("pos"))
    drawn = F.conv(F.substring(F.md5(F.concat_ws(f":{salt}:", "doc_id", "pos").cast("binary")), 1, 4), 16, 10).cast("long") / 65536
    return at.select("doc_id", "pos", F.concat(F.lit("label"), "pos").alias("hypothesis"), drawn.alias("score"))


@query("topics_topk", f"SELECT doc_id, hypothesis, round(score, 9)::DOUBLE AS score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS rank FROM ({_sql_labels(20, 'topic')}) WHERE score >= 0.5) WHERE rank <= 3")
def topics_topk(spark, d):
    return scoring.top_labels(_labels(spark, d, 20, "topic")).select("doc_id", "hypothesis", F.round("score", 9).alias("score"), "rank")


@query(
    "scope_cascade",
    f"""WITH s AS ({_sql_labels(3, 'scope')}), b AS (SELECT doc_id, hypothesis, score FROM s QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) = 1)
SELECT doc_id, CASE WHEN score >= 0.7 THEN hypothesis WHEN doc_id % 3 = 0 THEN 'city' WHEN doc_id % 3 = 1 THEN 'regional' ELSE 'national' END AS scope FROM b""",
)
def scope_cascade(spark, d):
    best = scoring.best_label(_labels(spark, d, 3, "scope"))
    scope = scoring.scope_of(F.col("label"), F.col("score"), F.col("doc_id") % 3 == 0, F.col("doc_id") % 3 == 1, 0.7)
    return best.select("doc_id", scope.alias("scope"))


@query("label_softmax", f"WITH s AS ({_sql_labels(5, 'soft')}) SELECT doc_id, pos, round(exp(score) / sum(exp(score)) OVER (PARTITION BY doc_id), 9)::DOUBLE AS score FROM s")
def label_softmax(spark, d):
    return scoring.softmax(_labels(spark, d, 5, "soft")).select("doc_id", F.col("pos").cast("long").alias("pos"), F.round("score", 9).alias("score"))


@query("scorecard", "SELECT source AS case_id, lang, sum((quality = 1)::INT)::BIGINT AS n_expected, sum((quality = 1 AND n_chars >= 500)::INT)::BIGINT AS n_matched, sum((quality <> 1 AND n_chars >= 500)::INT)::BIGINT AS n_false, sum((quality = 1)::INT) = sum((quality = 1 AND n_chars >= 500)::INT) AND (sum((quality = 1)::INT) > 0 OR sum((quality <> 1 AND n_chars >= 500)::INT) = 0) AS passes FROM labels JOIN documents USING (doc_id) GROUP BY 1, 2")
def scorecard(spark, d):
    rows = t(spark, d, "labels").join(t(spark, d, "documents"), "doc_id").select(F.col("source").alias("case_id"), "lang", (F.col("quality") == 1).alias("expected"), (F.col("n_chars") >= 500).alias("got"))
    return scoring.scorecard(rows, keys=("lang",))


# Places: nations, regions and suppliers as a gazetteer

ENTRIES = """entries AS (SELECT r_regionkey::BIGINT AS entry_id, r_name AS name, 'A' AS feature_class, (r_regionkey % 2)::BIGINT AS population FROM region
UNION ALL SELECT 100 + n_nationkey, replace(n_name, 'NATION', 'Nación'), 'P', n_regionkey::BIGINT FROM nation UNION ALL SELECT 1000 + n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN upper(n_name) ELSE 'Región ' || n_regionkey END, 'A', NULL FROM nation
UNION ALL SELECT 100000 + s_suppkey, 'Nación_' || s_nationkey, 'P', floor(s_acctbal)::BIGINT FROM supplier),
idx AS (SELECT *, coalesce(population, 0) AS pop, strip_accents(lower(name)) AS key FROM entries)"""


def _entries(spark, d):
    part = lambda df, i, name, c, pop: df.select(i.cast("long").alias("entry_id"), name.alias("name"), F.lit(c).alias("feature_class"), pop.cast("long").alias("population"))
    region, nation, supplier = (t(spark, d, x) for x in ("region", "nation", "supplier"))
    rows = part(region, F.col("r_regionkey"), F.col("r_name"), "A", F.col("r_regionkey") % 2)
    rows = rows.union(part(nation, 100 + F.col("n_nationkey"), F.replace("n_name", F.lit("NATION"), F.lit("Nación")), "P", F.col("n_regionkey")))
    rows = rows.union(part(nation, 1000 + F.col("n_nationkey"), F.when(F.col("n_nationkey") % 2 == 0, F.upper("n_name")).otherwise(F.concat(F.lit("Región "), "n_regionkey")), "A", F.lit(None)))
    rows = rows.union(part(supplier, 100000 + F.col("s_suppkey"), F.concat(F.lit("Nación_"), "s_nationkey"), "P", F.floor("s_acctbal")))
    blank = F.lit(None)
    return rows.withColumns({"asciiname": F.translate("name", "óñ", "on"), "lat": blank.cast("double"), "lon": blank.cast("double"), "admin1_code": blank.cast("string")})


SPANS = "spans AS (SELECT c_nationkey::BIGINT AS doc_id, c_custkey AS ord, CASE c_custkey % 5 WHEN 0 THEN 'NACIÓN_' || c_nationkey WHEN 1 THEN 'nation_' || c_nationkey WHEN 2 THEN ' Asia ' WHEN 3 THEN 'Región ' || c_custkey % 7 ELSE 'Calle Región ' || c_custkey % 3 END AS text FROM customer)"


def _spans(spark, d):
    n, k = F.col("c_nationkey").cast("string"), F.col("c_custkey")
    text = F.when(k % 5 == 0, F.concat(F.lit("NACIÓN_"), n)).when(k % 5 == 1, F.concat(F.lit("nation_"), n)).when(k % 5 == 2, " Asia ").when(k % 5 == 3, F.concat(F.lit("Región "), (k % 7).cast("string"))).otherwise(F.concat(F.lit("Calle Región "), (k % 3).cast("string")))
    return t(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("doc_id"), k.alias("ord"), text.alias("text"), F.lit(None).cast("string").alias("hint"))


@query("gazetteer_index", f"WITH {ENTRIES} SELECT entry_id, key, pop AS population FROM idx")
def gazetteer_index(spark, d):
    return places.gazetteer_index(_entries(spark, d)).select("entry_id", "key", "population")


FOUND = f"WITH {ENTRIES}, {SPANS}, found AS (SELECT s.doc_id, s.ord, s.text, i.entry_id, i.feature_class, i.pop FROM spans s LEFT JOIN idx i ON i.key = strip_accents(lower(trim(s.text))))"


def _found(spark, d, some=lambda index: index):
    return places.looked_up(_spans(spark, d), some(places.gazetteer_index(_entries(spark, d))))


@query("span_lookup", f"{FOUND} SELECT doc_id, ord, entry_id::VARCHAR AS entry_id, feature_class FROM found")
def span_lookup(spark, d):
    return _found(spark, d).select("doc_id", "ord", F.col("entry_id").cast("string").alias("entry_id"), "feature_class")


@query(
    "span_type_classes",
    FOUND + r""", c AS (SELECT doc_id, ord, text, coalesce(array_to_string(list_sort(list_distinct(list(feature_class) FILTER (feature_class IS NOT NULL))), ''), '') AS classes FROM found GROUP BY ALL)
SELECT doc_id, ord, classes, CASE WHEN regexp_matches(text, '(?i)^calle\s+') THEN 'street' WHEN classes = 'AP' THEN 'ask' WHEN classes = 'A' THEN 'region' WHEN classes = 'P' THEN 'city' ELSE 'location' END AS type FROM c""",
)
def span_type_classes(spark, d):
    return places.span_types(_found(spark, d, places.key_classes)).select("doc_id", "ord", F.array_join("classes", "").alias("classes"), "type")


@query("region_argmax", f"{FOUND} SELECT doc_id, ord, arg_max(entry_id, pop * 1000000000 - entry_id) AS entry_id, max(pop) AS population FROM found WHERE feature_class = 'A' GROUP BY ALL")
def region_argmax(spark, d):
    return places.most_populous(_found(spark, d, lambda index: places.leading(index, "A")), "A").select("doc_id", "ord", "entry_id", "population")


@query("homonym_top10", f"{FOUND}, p AS (SELECT doc_id, ord, entry_id, row_number() OVER (PARTITION BY doc_id, ord ORDER BY pop DESC, entry_id)::INT AS rank FROM found WHERE feature_class = 'P') SELECT * FROM p WHERE rank <= 10")
def homonym_top10(spark, d):
    return places.homonyms(_found(spark, d, lambda index: places.leading(index, "P", places.CANDIDATES)).where("feature_class = 'P'")).select("doc_id", "ord", "entry_id", "rank")


#: Coordinates made from keys, the same here and in SQL.
TOWNS = "towns AS (SELECT s_nationkey::BIGINT AS doc_id, s_suppkey AS ord, CASE WHEN s_suppkey % 9 <> 0 THEN s_suppkey END AS city_id, s_name AS city_name, (s_suppkey * 37 % 180 - 90)::DOUBLE AS lat, CASE WHEN s_suppkey % 11 <> 0 THEN (s_suppkey * 91 % 360 - 180)::DOUBLE END AS lon FROM supplier)"
KM = "2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians({d}) - radians({b})) / 2), 2) + cos(radians({b})) * cos(radians({d})) * pow(sin((radians({e}) - radians({c})) / 2), 2))))"


def _towns(spark, d):
    k = F.col("s_suppkey")
    return t(spark, d, "supplier").select(F.col("s_nationkey").cast("long").alias("doc_id"), k.alias("ord"), F.when(k % 9 != 0, k).alias("city_id"), F.col("s_name").alias("city_name"), (k * 37 % 180 - 90).cast("double").alias("lat"), F.when(k % 11 != 0, (k * 91 % 360 - 180).cast("double")).alias("lon"))


@query(
    "nearest_city",
    f"""WITH {TOWNS}, p AS (SELECT c_nationkey::BIGINT AS doc_id, c_custkey AS ord, (c_custkey * 53 % 180 - 90)::DOUBLE AS lat, (c_custkey * 71 % 360 - 180)::DOUBLE AS lon FROM customer),
k AS (SELECT p.doc_id, p.ord, w.city_id, w.city_name, CASE WHEN w.lon IS NOT NULL THEN round({KM.format(b='p.lat', c='p.lon', d='w.lat', e='w.lon')}, 6) END AS km, w.ord AS city_ord FROM p LEFT JOIN towns w ON w.doc_id = p.doc_id AND w.lon IS NOT NULL AND w.city_id IS NOT NULL)
SELECT doc_id, ord, city_id::VARCHAR AS city_id, km FROM k QUALIFY row_number() OVER (PARTITION BY doc_id, ord ORDER BY km, city_ord) = 1""",
)
def nearest_city(spark, d):
    k = F.col("c_custkey")
    points = t(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("doc_id"), k.alias("ord"), (k * 53 % 180 - 90).cast("double").alias("lat"), (k * 71 % 360 - 180).cast("double").alias("lon"))
    return places.nearest_city(points, _towns(spark, d).where("city_id is not null")).select("doc_id", "ord", F.col("city_id").cast("string").alias("city_id"), F.round("km", 6).alias("km"))


def edges_digest(edge_id):
    """A street's digest, made once for all that name it."""
    return F.md5(F.array_join(places.edge_list(edge_id).cast("array<string>"), ",").cast("binary"))


@query(
    "street_in_city",
    f"""WITH {TOWNS}, st AS (SELECT c_nationkey::BIGINT AS doc_id, c_custkey AS ord, 'Calle Rúa ' || c_custkey % 40 AS text FROM customer),
ed AS (SELECT l_orderkey * 10 + l_linenumber AS edge_id, l_suppkey AS city_id, 'rua ' || l_partkey % 40 AS key FROM lineitem),
mid AS (SELECT doc_id, avg(lat) AS mlat, avg(lon) AS mlon FROM towns GROUP BY 1),
hit AS (SELECT st.doc_id, st.ord, w.city_id, w.ord AS city_ord, w.lat, w.lon, md5(array_to_string(list_sort(list_distinct(list(ed.edge_id))), ',')) AS edges FROM st JOIN towns w ON w.doc_id = st.doc_id AND w.city_id IS NOT NULL JOIN ed ON ed.city_id = w.city_id AND ed.key = lower('rua ' || st.ord % 40) GROUP BY ALL)
SELECT doc_id, ord, city_id, edges FROM hit JOIN mid USING (doc_id) QUALIFY row_number() OVER (PARTITION BY doc_id, ord ORDER BY coalesce({KM.format(b='lat', c='lon', d='mlat', e='mlon')}, 1e300), city_ord) = 1""",
)
def street_in_city(spark, d):
    streets = t(spark, d, "customer").select(F.col("c_nationkey").cast("long").alias("doc_id"), F.col("c_custkey").alias("ord"), F.concat(F.lit("Calle Rúa "), (F.col("c_custkey") % 40).cast("string")).alias("text"))
    edges = t(spark, d, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("edge_id"), F.col("l_suppkey").alias("city_id"), F.concat(F.lit("RUA "), (F.col("l_partkey") % 40).cast("string")).alias("name"))
    found = places.streets_in_cities(streets, _towns(spark, d), edges, gathered=edges_digest)
    return found.select("doc_id", "ord", "city_id", F.col("edge_ids").alias("edges"))


@query(
    "overlap_antijoin",
    """WITH h AS (SELECT l_orderkey AS doc_id, l_linenumber AS ord, l_partkey % 60 AS s, l_partkey % 60 + 8 AS e FROM lineitem WHERE l_linenumber % 2 = 0), x AS (SELECT l_orderkey AS doc_id, l_suppkey % 60 AS s, l_suppkey % 60 + 5 AS e FROM lineitem WHERE l_linenumber % 2 = 1)
SELECT doc_id, ord, s::INT AS start_char, e::INT AS end_char FROM h ANTI JOIN x ON h.doc_id = x.doc_id AND ((h.s >= x.s AND h.s < x.e) OR (h.e > x.s AND h.e <= x.e))""",
)
def overlap_antijoin(spark, d):
    line = t(spark, d, "lineitem")
    span = lambda key, n: [F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("ord"), (F.col(key) % 60).cast("int").alias("start_char"), (F.col(key) % 60 + n).cast("int").alias("end_char")]
    return places.uncovered(line.where("l_linenumber % 2 = 0").select(*span("l_partkey", 8)), line.where("l_linenumber % 2 = 1").select(*span("l_suppkey", 5)))


def sql_trigrams(x: str) -> str:
    p = f"('  ' || strip_accents(lower({x})) || ' ')"
    return f"list_distinct(list_transform(range(1, length({p}) - 1), lambda i: substr({p}, i, 3)))"


@query(
    "city_exact_preference",
    f"""WITH q AS (SELECT DISTINCT CASE c_custkey % 3 WHEN 0 THEN 'nación_' || c_nationkey WHEN 1 THEN 'Nation ' || c_nationkey ELSE 'Supplier#0000' || c_custkey % 300 END AS name FROM customer),
c AS (SELECT n_nationkey::BIGINT AS id, n_name AS name FROM nation UNION ALL SELECT 1000 + s_suppkey, s_name FROM supplier),
qg AS (SELECT name, len(g) AS nq, unnest(g) AS g FROM (SELECT name, {sql_trigrams('name')} AS g FROM q)), cg AS (SELECT id, city, len(g) AS nc, unnest(g) AS g FROM (SELECT id, name AS city, {sql_trigrams('name')} AS g FROM c)),
p AS (SELECT name, id, city, count(*)::DOUBLE / (nq + nc - count(*)) AS sim, strip_accents(lower(name)) = strip_accents(lower(city)) AS exact FROM qg JOIN cg USING (g) GROUP BY name, id, city, nq, nc)
SELECT name, id AS city_id, city AS city_name FROM p WHERE exact OR sim >= 0.3 QUALIFY row_number() OVER (PARTITION BY name ORDER BY exact DESC, sim DESC, id) = 1""",
)
def city_exact_preference(spark, d):
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    name = F.when(k % 3 == 0, F.concat(F.lit("nación_"), n)).when(k % 3 == 1, F.concat(F.lit("Nation "), n)).otherwise(F.concat(F.lit("Supplier#0000"), (k % 300).cast("string")))
    cities = t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name")).union(t(spark, d, "supplier").select(1000 + F.col("s_suppkey"), "s_name"))
    return places.matched_city(t(spark, d, "customer").select(name.alias("name")), cities)


@query(
    "place_dedup",
    """WITH p AS (SELECT o_custkey AS doc_id, o_orderkey AS ord, o_orderkey % 4 AS k, o_orderkey % 6 AS g, 'Pláce ' || o_orderkey % 5 AS text FROM orders),
keyed AS (SELECT *, CASE k WHEN 0 THEN 'region:' || CASE WHEN g <> 0 THEN g::VARCHAR ELSE strip_accents(lower(text)) END WHEN 1 THEN 'city:' || CASE WHEN g <> 0 THEN g::VARCHAR ELSE strip_accents(lower(text)) END
  WHEN 2 THEN 'street:' || CASE WHEN g >= 3 THEN '[' || g || ',' || (g + 10) || ']' ELSE CASE WHEN g = 0 THEN '-' ELSE g::VARCHAR END || '|' || strip_accents(lower(text)) END ELSE 'location:' || CASE WHEN g = 1 THEN '1' WHEN g = 3 THEN '0.3333,0.6667' ELSE strip_accents(lower(text)) END END AS place_key FROM p)
SELECT doc_id, place_key, min(ord) AS ord FROM keyed GROUP BY ALL""",
)
def place_dedup(spark, d):
    k, g = F.col("o_orderkey") % 4, F.col("o_orderkey") % 6
    kind = F.when(k == 0, "region").when(k == 1, "city").when(k == 2, "street").otherwise("location")
    edges = F.when((k == 2) & (g >= 3), F.array(g + 10, g)).otherwise(F.array().cast("array<bigint>"))
    rows = t(spark, d, "orders").select(
        F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("ord"), kind.alias("type"), F.concat(F.lit("Pláce "), (F.col("o_orderkey") % 5).cast("string")).alias("text"), F.lit(None).cast("string").alias("name"),
        F.when((k == 0) | ((k == 3) & (g == 1)), g).alias("geonames_id"), F.when((k == 1) | ((k == 2) & (g > 0)), g).alias("city_id"), F.lit(None).cast("string").alias("city_name"), edges.alias("edge_ids"),
        F.when((k == 3) & (g == 3), F.lit(1 / 3)).alias("lat"), F.when((k == 3) & (g == 3), F.lit(2 / 3)).alias("lon"),
    )
    return places.distinct_places(rows).select("doc_id", "place_key", "ord")


# Pipelines

MERGED = "SELECT md5(text) AS text_key, min(doc_id) AS ord, array_to_string(list(source ORDER BY o), '|') AS sources, min(day)::VARCHAR AS date FROM (SELECT text, source, min(doc_id) AS doc_id, min(doc_id) AS o, min(DATE '2024-01-01' + (doc_id % 31)::INT) AS day FROM documents GROUP BY text, source) GROUP BY text"


def articles_of(docs: DataFrame) -> DataFrame:
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 31).cast("int"))
    return docs.select(F.md5(F.col("text").cast("binary")).alias("text_key"), F.col("doc_id").alias("ord"), "source", F.concat(F.lit("doc:"), "doc_id").alias("url"), day.alias("date"))


@query("article_merge", MERGED)
def article_merge(spark, d):
    return merge.merge_articles(articles_of(t(spark, d, "documents")), "text_key").select("text_key", "ord", F.array_join("sources", "|").alias("sources"), F.col("date").cast("string").alias("date"))


@query("stream_ingest_equals_batch", MERGED)
def stream_ingest_equals_batch(spark, d):
    from ..streaming.ingest import ingest_articles

    return ingest_articles(spark, d).select("text_key", "ord", F.array_join("sources", "|").alias("sources"), F.col("date").cast("string").alias("date"))


@query(
    "news_status_counts",
    f"""WITH RECURSIVE {SETS}, {sql_reach('SELECT a, b FROM pairs UNION SELECT b, a FROM pairs UNION SELECT doc_id, rep FROM classes UNION SELECT rep, doc_id FROM classes', 'SELECT doc_id AS id FROM docs')},
c AS (SELECT x AS doc_id, min(y) AS cluster_id FROM reach GROUP BY x), s AS ({_sql_labels(2, 'gate')}),
g AS (SELECT doc_id, bool_or(pos = 0 AND score >= 0.4) AND NOT bool_or(pos = 1 AND score >= 0.7) AS ok FROM s GROUP BY doc_id)
SELECT status, count(*)::BIGINT AS n FROM (SELECT CASE WHEN doc_id <> cluster_id THEN 'duplicate' WHEN NOT ok THEN 'out_of_scope' ELSE 'indexed' END AS status FROM c JOIN g USING (doc_id)) GROUP BY 1""",
)
def news_status_counts(spark, d):
    from .news import statuses

    gate = _labels(spark, d, 2, "gate").withColumn("kind", F.when(F.col("pos") == 0, "white").otherwise("black"))
    return statuses(texts(spark, d), gate).groupBy("status").agg(F.count("*").alias("n"))


@query(
    "relation_graph",
    f"""WITH {MENTIONS}, nexts AS (SELECT *, lead(name) OVER (PARTITION BY doc_id ORDER BY ord) AS tail FROM mentions), e AS (SELECT n.doc_id, n.ord, h.id AS head_id, t.id AS tail_id, {sql_words('lower(n.evidence)')} AS w FROM nexts n JOIN name_ids h ON h.doc_id = n.doc_id AND h.name = n.name JOIN name_ids t ON t.doc_id = n.doc_id AND t.name = n.tail)
SELECT doc_id, head_id, tail_id, array_to_string(w, ' ') AS print, count(*)::INT AS n_evidence, min(ord) AS ord FROM e GROUP BY ALL""",
)
def relation_graph(spark, d):
    from .relations import document_graph

    said = _mentions(spark, d)
    after = F.lead("name").over(Window.partitionBy("doc_id").orderBy("ord"))
    relations = said.select("doc_id", "ord", F.col("name").alias("head"), after.alias("tail"), F.lit("next").alias("type"), "subtype", "evidence", F.lit(1.0).alias("confidence"), F.lit(None).cast("string").alias("attributes"))
    _, edges = document_graph(said, relations)
    return edges.select("doc_id", "head_id", "tail_id", "print", F.size("evidence").alias("n_evidence"), "ord")


@query("event_dedup_watermark", "SELECT user_id, event_type, count(*)::BIGINT AS n FROM (SELECT DISTINCT user_id, event_type, props FROM events) GROUP BY 1, 2")
def event_dedup_watermark(spark, d):
    from ..streaming.ingest import distinct_events

    return distinct_events(spark, d).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


@query("graph_components", "WITH RECURSIVE l AS (SELECT DISTINCT s_nationkey::BIGINT AS a, s_suppkey % 100 + 1000 AS b FROM supplier), " + sql_reach("SELECT a, b FROM l UNION SELECT b, a FROM l", "SELECT n_nationkey::BIGINT AS id FROM nation UNION SELECT b FROM l") + " SELECT x AS id, min(y) AS cluster_id FROM reach GROUP BY x")
def graph_components(spark, d):
    links = t(spark, d, "supplier").select(F.col("s_nationkey").cast("long").alias("a"), (F.col("s_suppkey") % 100 + 1000).alias("b"))
    nodes = t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("id")).union(links.select("b"))
    return connected_components(nodes, links)
