"""Operators on small literal tables, one per trap of order, ties and missing values."""

from pyspark.sql import functions as F

from lexmill.operators import knn, merge, places, resolve, schema, scoring, similarity, summarize
from lexmill.operators.graph import connected_components


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_components(spark):
    nodes = spark.range(12)
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 4), (6, 5), (7, 7), (8, 99)] + [(i, i + 1) for i in range(9, 11)], "a long, b long")
    got = dict(rows(connected_components(nodes, links)))
    assert got == {0: 0, 1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 7, 8: 8, 9: 9, 10: 9, 11: 9}
    assert len(rows(connected_components(nodes, links.limit(0)))) == 12


def test_near_duplicates(spark):
    base = " ".join(f"w{i}" for i in range(60))
    docs = [(1, base), (2, base), (3, base + " tail"), (4, "short one"), (5, "SHORT  óne"), (6, None), (7, ""), (8, " ".join(f"v{i}" for i in range(60)))]
    got = dict(rows(similarity.near_duplicate_clusters(spark.createDataFrame(docs, "doc_id long, text string"))))
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7, 8: 8}


def test_exact_join_against_brute_force(spark):
    import random

    rnd = random.Random(5)
    docs = [(i, " ".join(rnd.choice("abcdef") for _ in range(rnd.randrange(3, 30)))) for i in range(60)]
    docs += [(100 + i, docs[i][1] + " z") for i in range(30)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    sets = similarity.shingle_sets(table)
    known = {r["id"]: set(r["shingles"]) for r in sets.collect()}
    want = {(a, b) for a in known for b in known if a < b and known[a] and known[b] and len(known[a] & known[b]) / len(known[a] | known[b]) >= 0.6}
    hashed = similarity.hashed_sets(table)
    assert {r["id"]: len(r["shingles"]) for r in hashed.collect()} == {i: len(s) for i, s in known.items()}
    assert {(r["a"], r["b"]) for r in similarity.jaccard_pairs(hashed, 0.6).collect()} == want and want
    label = {k: k for k in known}
    for _ in known:
        for a, b in want:
            label[a] = label[b] = min(label[a], label[b])
    assert dict(rows(similarity.jaccard_components(hashed, 0.6))) == label


def test_nearest_ties_and_zero_vectors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None)], "id long, vector array<double>")
    got = rows(knn.nearest(v, v, k=2, block=2).select("query_id", "rank", "id"))
    assert got == [(1, 1, 1), (1, 2, 2), (2, 1, 1), (2, 2, 2), (3, 1, 3), (3, 2, 1)]
    assert dict(rows(knn.decide_items(v.where("id = 1"), v, match=0.9).select("query_id", "target_id"))) == {1: 2}
    said = spark.createDataFrame([(1, 3, "yes"), (2, 3, "unsure")], "id_a long, id_b long, verdict string")
    got = dict(rows(knn.cluster_corpus(v.where("id < 4"), merge=0.99, low=0.0, verdicts=said)))
    assert got == {1: 1, 2: 1, 3: 1}


ENTITIES = [("d", 0, "Ana Pérez", "P", None, "e0"), ("d", 1, "Dra. Ana Perez", "P", "", "e1"), ("d", 2, "ANA PEREZ", "P", "boss", None), ("d", 3, "Acme", "O", None, "e3"), ("d", 4, "Ana Pérez", "O", None, "e4")]
ENTITY = "doc_id string, ord long, name string, type string, subtype string, evidence string"


def test_premerge_ids_and_edges(spark):
    merged = resolve.cluster_ids(resolve.premerge(spark.createDataFrame(ENTITIES, ENTITY)))
    got = {(r["type"], r["key"]): r for r in merged.collect()}
    ana = got["P", "ana perez"]
    assert ana["canonical_name"] == "Dra. Ana Perez" and ana["names"] == ["Ana Pérez", "Dra. Ana Perez", "ANA PEREZ"] and ana["subtype"] == "boss" and ana["evidence"] == ["e0", "e1"]
    assert (ana["id"], got["O", "acme"]["id"], got["O", "ana perez"]["id"]) == ("0", "1", "2")
    names = resolve.name_map(merged)
    relations = spark.createDataFrame([("d", 0, "Ana Pérez", "Acme", "AT", "x", "In  Acme", 0.5, "a"), ("d", 1, "Dra. Ana Perez", "Acme", "AT", None, "in acme", 0.5, "b"), ("d", 2, "Nobody", "Acme", "AT", None, "in acme", 0.9, "c")], "doc_id string, ord long, head string, tail string, type string, subtype string, evidence string, confidence double, attributes string")
    (edge,) = resolve.collapse_edges(resolve.rewrite_edges(relations, names)).collect()
    assert (edge["head_id"], edge["tail_id"], edge["subtype"], edge["attributes"], edge["evidence"]) == ("0", "1", "x", "a", ["In  Acme", "in acme"])


def test_leftovers(spark):
    merged = resolve.premerge(spark.createDataFrame(ENTITIES, ENTITY))
    clusters = spark.createDataFrame([("d", "O", 0, 3), ("d", "O", 1, 77)], "doc_id string, type string, cluster_ord long, candidate_ord long")
    assert rows(resolve.with_leftovers(merged, clusters)) == [("d", "O", 0, 3), ("d", "O", 1, 4), ("d", "P", 0, 0)]


def test_short_circuit(spark):
    s = spark.createDataFrame([(1, 0, "a", 0.9), (1, 1, "b", 0.2), (1, 2, "c", 0.8), (2, 0, "a", None)], "doc_id int, pos int, hypothesis string, score double")
    assert [r[2] for r in rows(scoring.short_circuit(s, 0.5).where("doc_id = 1"))] == ["a", "b"]
    assert [r[2] for r in rows(scoring.short_circuit(s, 0.85, blacklist=True).where("doc_id = 1"))] == ["a"]
    assert [r[1] for r in rows(scoring.top_labels(s.where("doc_id = 1"), 0.5, 1).select("doc_id", "hypothesis"))] == ["a"]


def test_streets_and_overlap(spark):
    docs = spark.createDataFrame([(1, "Obras en Calle Mayor, hoy. En la callejuela no."), (2, None), (3, "c/ Álamo 5")], "doc_id long, text string")
    found = places.street_spans(docs)
    assert rows(found.select("doc_id", "text", "start_char", "end_char")) == [(1, "Calle Mayor", 9, 20), (3, "c/ Álamo 5", 0, 10)]
    tagged = spark.createDataFrame([(1, 15, 20), (3, 3, 8)], "doc_id long, start_char int, end_char int")
    assert rows(places.uncovered(found, tagged).select("doc_id")) == [(3,)]


def test_nearest_city_without_coordinates(spark):
    points = spark.createDataFrame([(1, 0, 40.0, -3.0), (2, 0, 0.0, 0.0)], "doc_id long, ord long, lat double, lon double")
    cities = spark.createDataFrame([(1, 0, 7, "far", 0.0, 0.0), (1, 1, 8, "near", 40.1, -3.0), (2, 0, 9, "lost", None, None)], "doc_id long, ord long, city_id long, city_name string, lat double, lon double")
    assert rows(places.nearest_city(points, cities).select("doc_id", "city_id")) == [(1, 8), (2, None)]


def test_merge_is_free_of_order(spark):
    a = [("k", 2, "s1", "u2", "2024-01-05"), ("k", 1, "s2", "u1", "2024-02-01"), ("k", 3, "s2", "u3", None)]
    df = lambda r: spark.createDataFrame(r, "key string, ord long, source string, url string, date string")
    assert rows(merge.merge_articles(df(a), "key")) == rows(merge.merge_articles(df(a[::-1]), "key")) == [("k", 1, ["s2", "s1"], ["u1", "u2", "u3"], "2024-01-05")]


def test_schema(spark):
    s = schema.ExtractionSchema((schema.EntityType("ORG", "", (schema.Subtype("CLUB"),), (schema.Attribute("size", "number"),)), schema.EntityType("PER")), (schema.RelationType("IN", "", ("PER",), ("ORG",)),))
    g = schema.grammar(s)
    assert g["properties"]["entities"]["items"]["oneOf"][0]["properties"]["subtype"]["anyOf"][0]["enum"] == ["CLUB"]
    assert schema.grammar(schema.ExtractionSchema())["properties"]["entities"] == {"type": "array", "maxItems": 0} and not s.faults()
    answer = '{"reasoning":"","entities":[{"name":"A","type":"PER"},{"name":"B","type":"ORG","attributes":{"size":3}}],"relations":[{"head":0,"tail":1,"type":"IN"},{"head":1,"tail":0,"type":"IN"},{"head":0,"tail":9,"type":"IN"},{"head":0,"tail":1,"type":"X"}]}'
    read = schema.parsed(spark.createDataFrame([("d", answer), ("e", "no json")], "doc_id string, answer string"), s)
    assert dict(rows(read.select("doc_id", "status"))) == {"d": "ok", "e": "malformed"}
    good = read.where("status = 'ok'")
    kept = resolve.valid_relations(schema.flat_relations(good), schema.flat_entities(good), schema.rules(spark, s))
    assert rows(kept.select("ord", "head_name", "tail_name")) == [(0, "A", "B")]


def test_summaries(spark):
    docs = spark.createDataFrame([(1, "Short text."), (2, "alpha beta gamma. " * 150 + "The end comes here. Alpha beta again")], "doc_id long, text string")
    got = dict(rows(summarize.reduced(docs)))
    assert got[1] == "Short text." and 0 < len(got[2].split()) < 456
    good = "one two three four five six seven eight"

    def generate(df):
        short = F.when(F.col("prompt").contains("words"), good).when(F.col("id") == 1, "too short").otherwise(good)
        return df.select("id", F.when(F.col("id") != 3, F.struct(short.alias("headline"), F.lit("A. B.").alias("summary"))).alias("result"))

    asked = spark.createDataFrame([(1, "p"), (2, "p"), (3, "p")], "id long, prompt string")
    got = {r["id"]: (r["headline"], r["status"]) for r in summarize.summarize(asked, "article", generate).collect()}
    assert got == {1: (good, "ok"), 2: (good, "ok"), 3: (None, "error")}


def test_adapters(spark):
    from lexmill.operators import adapters

    def build():
        def model(batch):
            if any(x is None for x in batch):
                raise ValueError("no text")
            return [x.upper() for x in batch]

        return model

    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: (r["answer"], r["error"]) for r in adapters.applied(df, "text", build, tries=1).collect()}
    assert got == {1: ('"A"', None), 2: (None, "ValueError: no text")}
    assert dict(rows(adapters.rewritten(df, build).select("doc_id", "text"))) == {1: "A", 2: None}
