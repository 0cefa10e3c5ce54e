"""Models' answers: extraction in one call, classification, verdicts; schemas, taxonomies, storage versions and observed counts."""

import json
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexmill.operators import adapters, attributes, extract, schema, scoring
from lexmill.plans import news, relations
from lexmill.shared import shared_folder
from lexmill.sources import config, tables

SPEC = schema.ExtractionSchema((schema.EntityType("PER", "a person", (schema.Subtype("BOSS", "leads"),), (schema.Attribute("age", "number", "in years"),)), schema.EntityType("ORG")), (schema.RelationType("IN", "works for", ("PER",), ("ORG",), (), (schema.Attribute("since", "string"),)),))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_extract_in_one_call(spark):
    """Two words a chunk: a name and a firm. Positions go on over chunks; a malformed answer is asked again; ends outside the chunk go."""

    def build():
        asked = {}

        def model(batch):
            out = []
            for p in batch:
                assert p["system"] == schema.catalogue(SPEC) and json.loads(p["grammar"]) == schema.grammar(SPEC)
                person, firm = p["user"].split(" ")
                asked[p["user"]] = asked.get(p["user"], 0) + 1
                answer = {"reasoning": "", "entities": [{"name": person, "type": "PER", "attributes": {"age": 3}}, {"name": firm, "type": "ORG"}], "relations": [{"head": 0, "tail": 1, "type": "IN"}, {"head": 0, "tail": 2, "type": "IN"}, {"head": 1, "tail": 0, "type": "IN"}, {"head": -1, "tail": 1, "type": "IN"}]}
                out.append("Sorry" if person == "bad" else json.dumps(answer) if person == "text" else answer)
            return out

        return model

    docs = spark.createDataFrame([(1, "ann acme bob bolt text core"), (2, "bad acme cid core"), (3, ""), (4, None)], "doc_id long, text string")
    entities, relations_, status = extract.extract(docs, SPEC, build, size=2, pause=0.0)
    assert rows(entities.select("doc_id", "pos", "chunk_no", "name")) == [(1, 0, 0, "ann"), (1, 1, 0, "acme"), (1, 2, 1, "bob"), (1, 3, 1, "bolt"), (1, 4, 2, "text"), (1, 5, 2, "core"), (2, 0, 1, "cid"), (2, 1, 1, "core")]
    assert rows(relations_.select("doc_id", "ord", "head", "tail", "head_name", "tail_name")) == [(1, 0, 0, 1, "ann", "acme"), (1, 4, 2, 3, "bob", "bolt"), (1, 8, 4, 5, "text", "core"), (2, 0, 0, 1, "cid", "core")]
    assert rows(status.select("doc_id", "chunk_no", "status")) == [(1, 0, "ok"), (1, 1, "ok"), (1, 2, "ok"), (2, 0, "malformed"), (2, 1, "ok")]


def test_an_outage_waits_once(spark, monkeypatch):
    seen, paused, plan = [], [], {}

    class Down:
        def __call__(self, batch):
            seen.append(len(batch))
            raise OSError("down")

    docs = spark.createDataFrame([(i, "x") for i in range(5)], "id long, text string").coalesce(1)
    got = adapters.applied(docs, "text", Down, tries=3, pause=0.0).collect()
    assert [r["error"] for r in got] == ["OSError: down"] * 5 and all(r["answer"] is None for r in got)
    # The same function here, where its calls and pauses show.
    monkeypatch.setattr(adapters, "time", SimpleNamespace(sleep=paused.append))
    with monkeypatch.context() as m:
        m.setattr(type(docs), "mapInArrow", lambda self, f, s: plan.setdefault("run", f))
        adapters.applied(docs, "text", Down, tries=3)
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(["x"] * 5)], ["id", "text"])
    assert [b.num_rows for b in plan["run"](iter([batch]))] == [5]
    # Three tries of the batch, three of its first row, one of each of the others.
    assert seen == [5, 5, 5, 1, 1, 1, 1, 1, 1, 1] and paused == [1.0, 2.0, 1.0, 2.0]


def test_classification_in_one_call(spark):
    table = {("a", "x"): 0.9, ("a", "y"): 0.2, ("a", "z"): 0.9, ("b", "x"): 0.1, ("b", "y"): 0.8, ("b", "z"): 0.3}

    def build():
        return lambda batch: [table[p["text"], p["hypothesis"].removeprefix("about ")] for p in batch]

    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    score = lambda df, labels: adapters.scores(df, labels, build, template="about {}")
    found, ranked = scoring.nli(docs, ["x", "y", "z"], score)
    assert rows(found) == [(1, 0, "x", 0.9), (1, 1, "y", 0.2), (1, 2, "z", 0.9), (2, 0, "x", 0.1), (2, 1, "y", 0.8), (2, 2, "z", 0.3)]
    assert rows(ranked) == [(1, ["x", "z", "y"], [0.9, 0.9, 0.2]), (2, ["y", "z", "x"], [0.8, 0.3, 0.1])]
    assert rows(scoring.nli(docs, ["x", "y", "z"], score, threshold=0.5)[0].select("doc_id", "hypothesis")) == [(1, "x"), (1, "y"), (2, "x")]
    assert rows(scoring.nli(docs, ["x", "y", "z"], score, threshold=0.5, blacklist=True)[0].select("doc_id", "hypothesis")) == [(1, "x"), (2, "x"), (2, "y")]
    shares = scoring.nli(docs, ["x", "y"], score, exclusive=True)[0].groupBy("doc_id").agg(F.round(F.sum("score"), 9))
    assert rows(shares) == [(1, 1.0), (2, 1.0)]


def test_verdicts_and_questions(spark):
    def build():
        def model(batch):
            assert {p["question"] for p in batch} <= {adapters.question("entity")}
            return [{"same": "yes", "other": "no"}.get(p["text_b"], "perhaps") for p in batch]

        return model

    pairs = spark.createDataFrame([(1, 2, "same", "same"), (1, 3, "same", "other"), (1, 4, "same", "?")], "id_a long, id_b long, text_a string, text_b string")
    assert rows(adapters.verdicts(pairs, build)) == [(1, 2, "yes"), (1, 3, "no"), (1, 4, "unsure")]
    assert adapters.question("relation") == adapters.QUESTIONS["relation"] and adapters.question("else") == adapters.OTHER_QUESTION


def test_schema_texts_and_keys(spark):
    assert schema.catalogue(SPEC).split("\n") == ["ENTIDADES", "- PER: a person", "    subtipo BOSS: leads", "    atributo age (number): in years", "- ORG:", "RELACIONES", "- IN: works for [sujeto: PER; objeto: ORG]", "    atributo since (string):"]
    again = schema.ExtractionSchema(tuple(SPEC.entity_types), tuple(SPEC.relation_types))
    assert again.key() == SPEC.key() != schema.ExtractionSchema().key() and len(SPEC.key()) == 40
    df = spark.createDataFrame([({"a": "x"},), ({},), (None,)], "m map<string,string>")
    assert [r[0] for r in df.select(schema.attribute(F.col("m"), "a")).collect()] == ["x", "", ""]


def test_ontology_file(tmp_path):
    raw = {"entity_types": [{"name": "PER", "attributes": [{"name": "age", "datatype": "number", "description": ""}]}, {"name": "BIG_ORG", "subtypes": [{"name": "CLUB", "description": "d"}]}], "relation_types": [{"name": "IN", "head_types": ["PER"], "tail_types": ["BIG_ORG"]}]}
    good, bad = tmp_path / "o.json", tmp_path / "bad.json"
    good.write_text(json.dumps(raw))
    found = config.ontology(str(good))
    assert [e.name for e in found.entity_types] == ["PER", "BIG_ORG"] and found.relation_types[0].tail_types == ("BIG_ORG",)
    raw["relation_types"][0] |= {"name": "in", "head_types": ["NONE"]}
    bad.write_text(json.dumps(raw))
    with pytest.raises(ValueError, match="in: not upper snake case; in: NONE is no entity type"):
        config.ontology(str(bad))


def test_json_cases(spark, tmp_path):
    (tmp_path / "cases.json").write_text('[\n {"id": 1, "expected": ["a"]},\n {"id": 2, "expected": []}\n]')
    assert rows(tables.json_cases(spark, str(tmp_path / "cases.json")).select("id", F.size("expected"))) == [(1, 1), (2, 0)]


def test_storage_versions_merge(spark):
    path = shared_folder(spark, "storage-test")
    old = schema.ExtractionSchema((schema.EntityType("PER", "", (), (schema.Attribute("age", "number"),)),))
    schema.append_version(spark.createDataFrame([("1", "ann", 3.0)], "id string, name string, age double"), old, path, 1)
    for name in ("lost", "bob"):  # the second time replaces the first
        schema.append_version(spark.createDataFrame([("2", name, "1999")], "id string, name string, since string"), SPEC, path, 2)
    got = schema.read_versions(spark, path, SPEC)
    assert rows(got.select("version", "id", "name", "age", "since")) == [(1, "1", "ann", 3.0, None), (2, "2", "bob", None, "1999")]
    assert set(schema.storage_type(SPEC).fieldNames()) <= set(got.columns)


def test_best_attributes_as_variant(spark):
    data = [("k", 1, 0.5, '{"a": 1, "b": null, "c": {"x": [1, 2]}}'), ("k", 2, 0.9, '{"a": "two", "b": 5, "q\\"uote": true}'), ("k", 3, 0.9, '{"a": 3}'), ("k", 4, None, '{"z": 1}'), ("m", 1, 0.1, "no json"), ("m", 2, 0.1, "[1]"), ("n", 1, 0.1, None)]
    df = spark.createDataFrame(data, "key string, ord long, confidence double, attributes string")
    order = F.struct(-F.coalesce("confidence", F.lit(float("-inf"))), "ord")
    got = {r["key"]: json.loads(r["j"]) for r in attributes.best_attributes(df, ["key"], order).select("key", F.to_json("attributes").alias("j")).collect()}
    assert got == {"k": {"a": "two", "b": 5, "c": {"x": [1, 2]}, 'q"uote': True, "z": 1}}


def test_graph_tables_keep_rows_small(spark):
    vertices = spark.createDataFrame([("d1", "0", "Ann", "PER", None, ["Ann", "A."], ["x", "y"], 0, '{"age": 1}', 0.2), ("d2", "0", "Anna", "PER", "s", ["Anna"], ["z"], 3, '{"age": 2}', 0.9), ("d2", "1", "Anne", "PER", None, ["Anne", "Ann"], [], 1, None, None)], "doc_id string, id string, canonical_name string, type string, subtype string, names array<string>, evidence array<string>, ord long, attributes string, confidence double")
    clusters = spark.createDataFrame([("d1", "0", "c"), ("d2", "0", "c"), ("d2", "1", "c")], "doc_id string, id string, cluster_id string")
    edges = spark.createDataFrame([("d2", "0", "KNOWS", "1", 0.4, ["said"], 0, '{"w": 1}'), ("d2", "1", "KNOWS", "0", 0.6, ["told", "said"], 1, '{"w": null}'), ("d2", "1", "KNOWS", "9", 0.6, ["lost"], 1, "{}")], "doc_id string, head_id string, type string, tail_id string, confidence double, evidence array<string>, ord long, attributes string")
    folder = shared_folder(spark, "graph-test")
    relations.write_graph(relations.graph_tables(vertices, edges, clusters), folder)
    read = lambda name, **equal: relations.read_graph(spark, folder, name, **equal)
    assert rows(read("vertices", cluster_id="c").withColumn("attributes", F.to_json("attributes"))) == [("c", "Anne", "PER", None, 3, 2, 3, '{"age":2}')]
    assert rows(read("edges").withColumn("attributes", F.to_json("attributes"))) == [("c", "KNOWS", "c", 0.6, 1, 3, '{"w":1}')]
    assert rows(read("aliases")) == [("c", "A.", 1), ("c", "Ann", 2), ("c", "Anna", 1), ("c", "Anne", 1)]
    assert rows(read("vertex_docs")) == [("c", "d1", 1), ("c", "d2", 2)]
    assert [tuple(r) for r in read("vertex_evidence").orderBy("doc_id", "ord", "pos").collect()] == [("c", "d1", 0, 0, "x"), ("c", "d1", 0, 1, "y"), ("c", "d2", 3, 0, "z")]
    assert read("edge_evidence", head="c").count() == 3
    _, none = relations.consolidated(vertices, edges, clusters)
    assert rows(none.select("head", "tail", "confidence", "evidence")) == [("c", "c", 0.6, ["said", "told", "said"])]


def test_counts_are_seen_while_rows_are_written(spark):
    states = spark.range(100).select(F.when(F.col("id") % 4 == 0, "indexed").otherwise("duplicate").alias("status"))
    watched, counts = news.counted(states)
    watched.write.parquet(f"{shared_folder(spark, 'observed')}/rows")
    assert counts() == {"indexed": 25, "duplicate": 75}
