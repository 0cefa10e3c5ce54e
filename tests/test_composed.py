"""The composed operators on small literal tables: asked types, missing scores, failures, ties."""

import pytest
from pyspark.sql import functions as F

from lexmill.functions.text import head_sum, rejection
from lexmill.operators import geotag, places, resolve, scoring, similarity, summarize

ENTRY = "entry_id long, name string, asciiname string, lat double, lon double, feature_class string, feature_code string, admin1_code string, population long"
SPAN = "doc_id long, ord int, text string, start_char int, end_char int, hint string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def gazetteer(spark):
    entry = lambda i, name, c, pop, lat=40.0, lon=-3.0, code="29": (i, name, name, lat, lon, c, "X", code, pop)
    return places.gazetteer_index(spark.createDataFrame([
        entry(1, "Madrid", "P", 300), entry(2, "Madrid", "A", 700), entry(3, "Galicia", "A", 50), entry(4, "Vigo", "P", 20, 42.2, -8.7),
        entry(5, "Santiago", "P", 9, 42.9, -8.5), entry(6, "Santiago", "P", 90, -33.0, -70.0), entry(7, "Perdida", "P", None, 41.0, -4.0), entry(8, "Faro", "P", 3, 42.3, -8.8), entry(8, "Faro", "A", 3),
    ], ENTRY))


def test_geotag(spark):
    spans = [(1, 0, "Madrid"), (1, 1, "Galicia"), (1, 2, "Vigo"), (1, 3, "Santiago"), (1, 4, "Calle Real"), (1, 5, "Faro"), (1, 6, "Nowhere"), (2, 0, "Perdida"), (2, 1, "Calle Real"), (3, 0, "Galicia")]
    spans = spark.createDataFrame([(d, o, t, 0, 1, "") for d, o, t in spans], SPAN)
    cities = spark.createDataFrame([(10, "Madrid"), (11, "vigo"), (12, "Santiago")], "id long, name string")
    edges = spark.createDataFrame([(100, 11, "Rúa Real"), (101, 11, "Calle real"), (102, 10, "Calle Mayor")], "edge_id long, city_id long, name string")
    # Madrid is asked and said to be a city, Faro a location; of two Santiagos the smaller is scored best.
    asked = spark.createDataFrame([(1, 0, 0, 0.1), (1, 0, 1, 0.8), (1, 0, 2, 0.1), (1, 5, 0, 0.2), (1, 5, 1, 0.2), (1, 5, 2, 0.6)], "doc_id long, ord int, pos int, score double")
    found, trace = geotag.geotag(spans, gazetteer(spark), cities, edges, type_scores=asked)
    got = [(r["doc_id"], r["place_no"], r["type"], r["text"], r["geonames_id"], r["city_id"], r["edge_ids"], r["confidence"]) for r in found.orderBy("doc_id", "place_no").collect()]
    assert got == [
        (1, 0, "region", "Galicia", 3, None, None, 1.0), (1, 1, "city", "Madrid", 1, 10, None, 1.0), (1, 2, "city", "Vigo", 4, 11, None, 1.0), (1, 3, "city", "Santiago", 6, 12, None, 0.0),
        (1, 4, "street", "Calle Real", None, 11, [101], 1.0), (1, 5, "location", "Faro", 8, 11, None, 1.0), (3, 0, "region", "Galicia", 3, None, None, 1.0),
    ]
    assert {(r["doc_id"], r["ord"]): (r["type"], r["detected_id"]) for r in trace.collect()}[2, 0] == ("city", None)  # no place, but context
    assert trace.count() == 10
    none, _ = geotag.geotag(spans.limit(0), gazetteer(spark), cities, edges)
    assert none.count() == 0


def test_city_scores_and_ties(spark):
    index = gazetteer(spark)
    found = places.homonyms(places.looked_up(spark.createDataFrame([(1, 0, "Santiago", 0, 1, "")], SPAN), index).where("feature_class = 'P'"))
    scores = spark.createDataFrame([(1, 0, "Santiago", 0.4)], "doc_id long, ord int, name string, score double")
    assert [(r["entry_id"], r["confidence"]) for r in geotag.chosen_city(found, scores).collect()] == [(6, 0.4)]


def test_resolved_entities_and_failures(spark):
    mentions = [(1, 0, "Ana", "person", None, "e0"), (1, 1, "Ana Ruiz", "person", "mayor", "e1"), (1, 2, "Club", "org", None, "e2"), (1, 3, "ana", "person", None, "e3"), (1, 4, "Luis", "person", None, "e4"), (2, 0, "X", "person", None, "f")]
    found = resolve.premerge(spark.createDataFrame(mentions, "doc_id long, ord int, name string, type string, subtype string, evidence string"))

    def refine(groups):  # joins the first two and names one position too many; fails for document 2
        cluster = F.array(F.struct(F.lit("Ana Ruiz").alias("canonical_name"), F.lit("mayor").alias("subtype"), F.array(F.lit(0), F.lit(1), F.lit(9)).alias("members")))
        return groups.select("doc_id", "type", F.when(F.col("doc_id") == 1, cluster).alias("clusters"))

    got = rows(resolve.resolved_entities(found, resolve.refined(found, refine)).select("doc_id", "id", "canonical_name", "names", "type", "subtype", "evidence"))
    assert got == [
        (1, "0", "Ana Ruiz", ["Ana", "ana", "Ana Ruiz"], "person", "mayor", ["e0", "e3", "e1"]), (1, "1", "Luis", ["Luis"], "person", None, ["e4"]),
        (1, "2", "Club", ["Club"], "org", None, ["e2"]), (2, "0", "X", ["X"], "person", None, ["f"]),
    ]
    failed = resolve.refined(found, lambda g: g.select("doc_id", "type", F.lit(None).cast("array<struct<canonical_name:string,subtype:string,members:array<int>>>").alias("clusters")))
    assert resolve.resolved_entities(found, failed).count() == 5  # all candidates alone


def test_asked_in_turn(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "b"), (3, "a")], "doc_id long, text string")
    asked = []

    def score(left, hypotheses):
        asked.append(left.count())
        return left.select("doc_id", F.lit(0).alias("pos"), F.lit(hypotheses[0]).alias("hypothesis"), F.contains("text", F.lit(hypotheses[0])).cast("double").alias("score"))

    got = rows(scoring.asked_in_turn(docs, ["a", "b", "c"], score, 0.5))
    assert got == [(1, 0, "a", 1.0), (1, 1, "b", 1.0), (1, 2, "c", 1.0), (2, 0, "a", 0.0), (3, 0, "a", 1.0), (3, 1, "b", 0.0)]
    assert asked == [3, 2, 1]


def test_first_recent(spark):
    same, other = [*range(128)], [*range(200, 328)]
    near = [*range(116), *range(900, 912)]
    new = spark.createDataFrame([(1, same), (2, other), (3, [])], "id long, signature array<long>")
    window = spark.createDataFrame([(10, near, 5), (11, same, 5), (12, same, 4), (1, same, 9)], "id long, signature array<long>, date int")
    assert rows(similarity.first_recent(new, window)) == [(1, 10), (2, None), (3, None)]


def test_prompts_and_requests(spark):
    data = spark.createDataFrame([(1, "x", ["p", "q"], "s"), (2, None, [], None)], "id long, title string, evidence array<string>, subtype string")

    def generate(prompts):
        return prompts.select("id", F.struct(F.col("prompt").alias("description")).alias("result"))

    got = rows(summarize.summarize_fields(data, "entity_desc", "{title}: {evidence_text} {subtype_line}", generate))
    assert got[0] == (1, "x: 1. p\n2. q Subtipo: s", "ok", None) and got[1] == (2, None, "error", "missing field: title")
    assert rows(summarize.rendered(data, "{nothing}{{}}").select("reason")) == [("missing field: nothing",)] * 2
    asked = spark.createDataFrame([(" ", ["a"]), ("t", []), ("t", None), ("t", ["a"]), (None, None)], "text string, h array<string>")
    assert [r[0] for r in asked.select(rejection(F.col("text"), F.col("h"))).collect()] == ["blank text", "nothing asked", "nothing asked", None, "blank text"]
    assert asked.select(head_sum(F.lit("h"), F.lit("s"))).first()[0] == "h\ns"


def test_span_union_edges(spark):
    tagged = spark.createDataFrame([(1, "Vigo", "LOC", 5, 9), (1, "Ana", "PER", 0, 3), (1, "?", None, 0, 1)], "doc_id long, text string, label string, start_char int, end_char int")
    streets = spark.createDataFrame([(1, 0, "calle A", 0, 6, "street"), (1, 1, "calle B", 9, 12, "street"), (2, 0, "calle C", 0, 4, "street")], SPAN)
    assert rows(geotag.span_union(tagged, streets)) == [(1, 0, "Vigo", 5, 9, ""), (1, 1, "calle B", 9, 12, "street"), (2, 0, "calle C", 0, 4, "street")]


@pytest.mark.parametrize("most", [1, 5])
def test_geo_context(spark, most):
    cities = spark.createDataFrame([(1, 3, "B"), (1, 1, "A"), (1, 9, "A"), (2, 0, "C")], "doc_id long, ord int, city_name string")
    assert dict(rows(geotag.geo_context(cities, most))) == {1: "A" if most == 1 else "A, B", 2: "C"}
