"""What a review of round 3 found: results that differed, and steps that grew faster than their input."""

import datetime
import math
from itertools import product

from pyspark.sql import functions as F

from lexmill.operators import geotag, places

HEAD = "entry_id long, name string, feature_class string, population long, key string"


def km(a, b, c, d):
    h = math.sin((math.radians(c) - math.radians(a)) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin((math.radians(d) - math.radians(b)) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(h, 1.0)))


def noisy(most=20):
    """Points and two cities each, equally far but for noise that makes the second one nearer."""
    for lat, lon, d in product(range(1, 60, 7), range(3, 170, 11), range(1, 40, 3)):
        for first, second in (((lat, lon - d), (lat, lon + d)), ((lat, lon + d), (lat, lon - d))):
            if most and 0 < km(lat, lon, *first) - km(lat, lon, *second) < 1e-9:
                most -= 1
                yield (lat, lon), first, second


def test_equal_distances_take_the_first_city(spark):
    cases = list(noisy())
    assert cases
    points = spark.createDataFrame([(i, 0, float(p[0]), float(p[1])) for i, (p, _, _) in enumerate(cases)], "doc_id long, ord long, lat double, lon double")
    cities = [(i, k, k + 1, f"c{k}", float(c[0]), float(c[1])) for i, (_, *two) in enumerate(cases) for k, c in enumerate(two)]
    cities = spark.createDataFrame(cities, "doc_id long, ord long, city_id long, city_name string, lat double, lon double")
    assert {r["city_id"] for r in places.nearest_city(points, cities).collect()} == {1}


def gazetteer(spark):
    rows = [(i, f"n{i}", "AP"[i % 2], i * 7 % 10, "x" if i % 3 else "y") for i in range(60)]
    return spark.createDataFrame(rows, HEAD).withColumns({"lat": F.lit(1.0), "lon": F.lit(2.0), "admin1_code": F.lit("a")})


def spans(spark):
    return spark.createDataFrame([(i % 3, i, "X" if i % 4 else ("y" if i % 8 else "z"), None) for i in range(40)] + [(9, 99, None, None)], "doc_id long, ord long, text string, hint string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_dealt_key_gives_every_pair_once(spark, monkeypatch):
    asked, index = spans(spark), gazetteer(spark)
    want = [(r["ord"], e["entry_id"]) for r in asked.collect() for e in index.collect() if r["text"] and r["text"].lower() == e["key"]]
    want += [(r["ord"], None) for r in asked.collect() if r["text"] in ("z", None)]
    monkeypatch.setattr(places, "SPANS_A_TASK", 4)
    monkeypatch.setattr(places, "ENTRIES_A_TASK", 3)
    assert rows(places.looked_up(asked, index).select("ord", "entry_id")) == sorted(want, key=repr)


def test_leading_entries_are_all_that_homonyms_need(spark):
    asked, index = spans(spark), gazetteer(spark)
    some = places.looked_up(asked, places.leading(index, "P", 3))
    assert some.count() <= 3 * asked.count()
    whole = places.looked_up(asked, index).where("feature_class = 'P'")
    keep = ("doc_id", "ord", "entry_id", "rank")
    assert rows(places.homonyms(some.where("feature_class = 'P'"), k=3).select(*keep)) == rows(places.homonyms(whole, k=3).select(*keep))


def test_classes_of_a_key_are_all_that_types_need(spark):
    asked, index = spans(spark), gazetteer(spark)
    some = places.looked_up(asked, places.key_classes(index))
    assert some.count() <= 2 * asked.count()
    keep = ("doc_id", "ord", "classes", "type")
    assert rows(places.span_types(some).select(*keep)) == rows(places.span_types(places.looked_up(asked, index)).select(*keep))


def town(spark):
    streets = spark.createDataFrame([(0, i, f"Calle Mayor {i % 2}") for i in range(50)], "doc_id long, ord long, text string")
    cities = spark.createDataFrame([(0, i, 1 + i % 3, f"c{i % 3}", float(i % 3), 0.0) for i in range(30)], "doc_id long, ord long, city_id long, city_name string, lat double, lon double")
    edges = spark.createDataFrame([(10 * c + k, c, f"Calle Mayor {k % 2}") for c in (2, 3) for k in range(4)], "edge_id long, city_id long, name string")
    return streets, cities, edges


def test_street_digests_are_made_once_a_street(spark):
    text = lambda e: F.array_join(places.edge_list(e).cast("array<string>"), ",")
    found = places.streets_in_cities(*town(spark), gathered=text)
    assert {(r["ord"] % 2, r["city_id"], r["edge_ids"]) for r in found.collect()} == {(0, 2, "20,22"), (1, 2, "21,23")}
    assert found.count() == 50


def test_alike_streets_of_the_nearest_city(spark):
    streets, cities, edges = town(spark)
    edges = edges.withColumn("name", F.concat("name", F.lit(" bis")))
    text = lambda e: F.array_join(places.edge_list(e).cast("array<string>"), ",")
    found = places.streets_in_cities(streets, cities, edges, least=0.3, gathered=text)
    assert {(r["ord"] % 2, r["city_id"], r["edge_ids"]) for r in found.collect()} == {(0, 2, "20,22"), (1, 2, "21,23")}


def test_geotag_gathers_a_streets_edges_as_told(spark):
    index = places.gazetteer_index(spark.createDataFrame([(5, "Here", None, 1.0, 1.0, "P", "x", 3)], "entry_id long, name string, asciiname string, lat double, lon double, feature_class string, admin1_code string, population long"))
    asked = spark.createDataFrame([(0, 0, "here", None), (0, 1, "Calle Sol", None)], "doc_id long, ord long, text string, hint string")
    cities = spark.createDataFrame([(7, "Here")], "id long, name string")
    edges = spark.createDataFrame([(3, 7, "Calle Sol"), (1, 7, "Sol")], "edge_id long, city_id long, name string")
    found, _ = geotag.geotag(asked, index, cities, edges, gathered=lambda e: F.count_distinct(e))
    assert [(r["type"], r["edge_ids"]) for r in found.orderBy("place_no").collect()] == [("city", None), ("street", 2)]


def test_stream_versions_merge_by_ord(spark, tmp_path):
    from lexmill.streaming import ingest

    day = datetime.date(2024, 1, 1)
    columns = "text_key string, ord long, source string, url string, date date"
    for k, part in enumerate(([("k", 9, "late", "u9", day)], [("k", 1, "early", "u1", day), ("k", 20, "late", "u20", day)])):
        spark.createDataFrame(part, columns).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
    for k in range(2):
        stream = spark.readStream.schema(columns).parquet(f"{tmp_path}/in/{k}")
        ingest.ingest(stream, f"{tmp_path}/index/{k}")
    from lexmill.operators.merge import first_parts, of_parts

    both = spark.read.parquet(f"{tmp_path}/index/0").unionByName(spark.read.parquet(f"{tmp_path}/index/1"))
    assert [(r["ord"], r["sources"], r["urls"]) for r in of_parts(first_parts(both.drop("version"), "text_key"), "text_key").collect()] == [(1, ["early", "late"], ["u1", "u9", "u20"])]


def test_leaders_are_those_of_a_stable_sort():
    import numpy as np

    from lexmill.operators.knn import leaders

    score = np.round(np.random.default_rng(3).random((50, 300)), 1)
    assert (leaders(score, 10) == np.argsort(-score, axis=1, kind="stable")[:, :10]).all()


def test_one_call_of_the_stream_state_serves_many_bands():
    import numpy as np
    import pandas as pd

    from lexmill.streaming.recent import RecentBand

    class Cell:
        held = None
        exists = lambda self: self.held is not None
        get = lambda self: self.held

        def update(self, row):
            self.held = row

    class Handle:
        getValueState = lambda self, *_: Cell()
        listTimers = lambda self: []
        registerTimer = lambda self, at: None

    state = RecentBand(window=10)
    state.init(Handle())
    a, b = (np.full(128, x, dtype=np.int32).tobytes() for x in (1, 2))
    give = lambda *rows: [tuple(r) for df in state.handleInputRows((0,), iter([pd.DataFrame(rows, columns=["band", "seq", "id", "ms", "sign"])]), None) for r in df.itertuples(index=False)]
    assert give((7, 1, 1, 0, a), (8, 1, 1, 0, b), (7, 2, 2, 0, a), (8, 3, 3, 0, a)) == [(2, 2, 1, 1)]
    assert sorted(give((7, 5, 5, 0, a), (8, 5, 6, 0, b), (9, 5, 7, 0, b))) == [(5, 5, 2, 2), (6, 5, 1, 1)]
    assert give((7, 30, 8, 0, a)) == [] and len(state.state.held[1]) == 8


def test_relations_find_their_ends_in_their_own_row(spark):
    from lexmill.operators.extract import placed_relations

    e, r = "array<struct<name:string,type:string>>", "array<struct<head:long,tail:long,type:string>>"
    made = [(1, ([("a", "A"), ("r", "R"), ("n", None)], [(0, 1, "O"), (1, 0, "O"), (0, 2, "O"), (0, 3, "O"), (-1, 1, "O"), (0, 1, "X"), (0, 1 << 40, "O"), (None, 1, "O")])), (2, (None, [(0, 1, "O")]))]
    read = spark.createDataFrame(made, f"doc_id long, parsed struct<entities:{e},relations:{r}>")
    allowed = spark.createDataFrame([("O", ["A"], ["R"])], "type string, head_types array<string>, tail_types array<string>")
    found = placed_relations(read, allowed, "doc_id")
    assert [tuple(r) for r in found.select("doc_id", "ord", "head", "tail", "head_name", "tail_name").collect()] == [(1, 0, 0, 1, "a", "r")]
    assert "SortMergeJoin" not in found._jdf.queryExecution().toString()


def test_exact_city_names_are_compared_with_nothing(spark, monkeypatch):
    compared = []
    monkeypatch.setattr(places, "similar", lambda a, h, _f=places.similar, **k: (compared.extend(r["name"] for r in a.collect()), _f(a, h, **k))[1])
    names = spark.createDataFrame([("Évora",), ("evoras",), (None,)], "name string")
    cities = spark.createDataFrame([(4, "evora"), (3, "EVORA"), (9, "Evoras do Sul")], "id long, name string")
    assert sorted(map(tuple, places.matched_city(names, cities).collect())) == [("evoras", 3, "EVORA"), ("Évora", 3, "EVORA")]
    assert compared == ["evoras"]
