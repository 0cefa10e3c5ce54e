"""Vector index, names by trigrams, the recent window as stream state, and the folded index, each against brute force."""

import os
from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.operators import fuzzy, knn, places, vector_index
from lexmill.operators.similarity import hashed_bands
from lexmill.plans.catalogue import _vectors
from lexmill.shared import shared_folder
from lexmill.streaming import folded, recent

DATA = os.environ.get("LEXMILL_TESTDATA", "/root/testdata/sf0.001")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# Vectors


@pytest.fixture(scope="module")
def vectors(spark):
    """Clusters of very different sizes, copies, another size, nulls and zeros."""
    rng = np.random.default_rng(1)
    centre = rng.normal(size=(6, 8))
    of = rng.choice(6, 900, p=[0.5, 0.2, 0.1, 0.1, 0.05, 0.05])
    out = [(i, (centre[c] + rng.normal(0, 0.3, 8)).tolist(), "ab"[i % 2]) for i, c in enumerate(of)]
    out += [(1000 + i, out[3][1], "a") for i in range(40)] + [(2000 + i, rng.normal(size=5).tolist(), "a") for i in range(7)]
    out += [(3000, None, "a"), (3001, [0.0] * 8, "b"), (3002, [], "b")]
    return spark.createDataFrame(out, "id long, vector array<double>, label string").repartition(4).cache()


@pytest.mark.parametrize("kind", [None, "label"])
def test_exact_search_is_the_full_product(vectors, kind):
    queries = vectors.where("id % 20 = 0 or id >= 1990")
    index = vector_index.build(vectors, vector_index.fit(vectors, lists=12), type_col=kind)
    assert sum(index.sizes.values()) == 947  # every row but those without length
    want = rows(knn.nearest(queries, vectors, type_col=kind).select("query_id", "id", "score", "rank"))
    assert rows(vector_index.search(queries, index, exact=True, probes=1, type_col=kind, block=64).select("query_id", "id", "score", "rank")) == want


def test_recall_of_the_probed_lists(spark, vectors):
    for v in (vectors, _vectors(spark, DATA), _vectors(spark, "/root/testdata/sf0.01")):
        queries = v.where("id % 20 = 0")
        index = vector_index.build(v, vector_index.fit(v))
        got = vector_index.search(queries, index).select("query_id", "id")
        want = knn.nearest(queries, v).select("query_id", "id")
        assert got.join(want, ["query_id", "id"]).count() >= 0.9 * want.count()


def test_clusters_by_index(vectors):
    index = vector_index.build(vectors, vector_index.fit(vectors, lists=9))
    found = vector_index.search(vectors, index, exact=True)
    assert rows(knn.cluster_corpus(vectors, found=found)) == rows(knn.cluster_corpus(vectors))


def test_only_scores_that_may_count_are_looked_for(vectors):
    index = vector_index.build(vectors, vector_index.fit(vectors, lists=9), type_col="label")
    want = rows(knn.nearest(vectors, vectors, type_col="label").select("query_id", "id", "score", "rank").where("score >= 0.97"))
    got = vector_index.search(vectors, index, exact=True, least=0.97, type_col="label", block=100)
    assert want and rows(got.select("query_id", "id", "score", "rank")) == want
    assert rows(knn.cluster_corpus(vectors, merge=0.97, found=got)) == rows(knn.cluster_corpus(vectors, merge=0.97, type_col="label"))


def test_queries_travel_by_slabs_not_by_lists(spark):
    x = np.random.default_rng(2).normal(size=(3000, 16))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, vector array<double>")
    store = spark.sparkContext._jsc.sc().statusStore()
    moved = lambda: sum(store.executorList(False).apply(i).totalShuffleWrite() for i in range(store.executorList(False).size()))
    index = vector_index.build(v, vector_index.fit(v, lists=60))
    before = moved()
    got = rows(vector_index.search(v, index, exact=True).select("query_id", "id", "score", "rank"))
    assert moved() - before < 10 * v.count() * 16 * 8  # some 60 times the vectors when each list got a copy
    assert got == rows(knn.nearest(v, v).select("query_id", "id", "score", "rank"))


def test_slabs_hold_every_list_once():
    sizes = {-1: 25, 0: 3, 1: 4, 2: 9, 3: 30, 4: 2, 6: 8}
    assert vector_index.packed(sizes, 10) == {-1: (0, 3), 0: (3, 1), 1: (3, 1), 2: (4, 1), 3: (5, 3), 4: (8, 1), 6: (8, 1)}


@pytest.mark.parametrize("tighten", [True, False])
@pytest.mark.parametrize("digits", [1, 6])
def test_pairs_of_a_tile_with_copies_and_ties(monkeypatch, tighten, digits):
    monkeypatch.setattr(vector_index, "SLICE", 7)
    monkeypatch.setattr(vector_index, "CHUNK", 50)
    rng = np.random.default_rng(3)
    y = vector_index.unit(rng.normal(size=(333, 6)))
    y[40:200] = y[3]
    x = vector_index.unit(np.concatenate([y[::20] + rng.normal(0, 1e-4, (17, 6)), y[3:6], rng.normal(size=(5, 6))]))
    for bound in (-np.inf, 0.3, 1.0, 2.0):
        want = []
        for i, score in enumerate(np.round(x @ y.T, digits)):
            best = sorted(range(len(y)), key=lambda j: (-score[j], j))[:4]
            want += [(i, j, score[j]) for j in best if score[j] >= bound]
        assert [*zip(*vector_index.best_pairs(x, y, np.full(len(x), bound), 4, digits, tighten))] == want


def test_index_of_nothing(vectors):
    none = vectors.limit(0)
    empty = vector_index.build(none, vector_index.fit(none))
    assert vector_index.search(vectors.where("id < 5"), empty).count() == 0
    index = vector_index.build(vectors, vector_index.fit(vectors, lists=3))
    assert vector_index.search(none, index, exact=True).count() == 0


# Names


def gram_set(name):
    p = "  " + name.lower() + " "
    return {p[i : i + 3] for i in range(len(p) - 2)}


@pytest.mark.parametrize("least", [0.0, 0.3, 0.75, 1.0])
def test_similar_and_containing_equal_all_pairs(spark, least):
    rng = np.random.default_rng(2)
    name = lambda: "".join(rng.choice(list("abcab x"), rng.integers(0, 9)))
    asked = [(int(rng.integers(0, 3)), name()) for _ in range(60)] + [(0, None), (1, ""), (2, "ÁB"), (9, "abc")]
    held = [(int(rng.integers(0, 3)), name()) for _ in range(60)] + [(0, None), (1, "a"), (2, "abÉ"), (8, "abc")]
    a, h = (spark.createDataFrame(x, "city int, name string") for x in (asked, held))
    plain = lambda n: n.replace("Á", "a").replace("É", "e").lower()
    pairs = {(c, x, y) for c, x in asked for d, y in held if c == d and x is not None and y is not None}
    jaccard = lambda x, y: len(gram_set(plain(x)) & gram_set(plain(y))) / len(gram_set(plain(x)) | gram_set(plain(y)))
    if least:  # at 0 names without a common trigram count too, which a join on trigrams cannot find
        got = {(c, x, y): s for c, x, y, s in rows(fuzzy.similar(a, h, scope=("city",), least=least))}
        assert got == pytest.approx({p: jaccard(*p[1:]) for p in pairs if jaccard(*p[1:]) >= least})
    assert rows(fuzzy.containing(a, h, scope=("city",))) == sorted(((c, x, y) for c, x, y in pairs if x.strip() and plain(x) in plain(y)), key=repr)


def test_street_of_the_city_itself_comes_first(spark):
    streets = spark.createDataFrame([(1, 0, "Calle Mayor"), (1, 1, "Calle Mayro"), (1, 2, "Calle Zzz"), (2, 0, "Calle Mayor")], "doc_id long, ord long, text string")
    cities = spark.createDataFrame([(1, 5, 10, "A", 0.0, 0.0), (2, 5, 20, "B", 0.0, 0.0)], "doc_id long, ord long, city_id long, city_name string, lat double, lon double")
    edges = spark.createDataFrame([(1, 10, "Mayor"), (2, 10, "mayor"), (3, 10, "Mayora"), (4, 20, "Mayores"), (5, 20, "otra")], "edge_id long, city_id long, name string")
    got = {(r["doc_id"], r["ord"]): r["edge_ids"] for r in places.streets_in_cities(streets, cities, edges, least=0.3).collect()}
    assert got == {(1, 0): [1, 2], (1, 1): [1, 2], (2, 0): [4]}
    assert {(r["doc_id"], r["ord"]) for r in places.streets_in_cities(streets, cities, edges).collect()} == {(1, 0)}


# Streams


def signed(spark, n=160):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 30, (5, 128))
    out = []
    for i in range(n):
        s = base[rng.integers(0, 5)].copy()
        s[rng.choice(128, rng.integers(0, 20), replace=False)] = rng.integers(0, 1 << 30)
        out.append((1000 - i, i if i % 7 else max(0, i - 1), datetime(2024, 1, 1 + i // 40), s.tolist()))
    return out, spark.createDataFrame(out, "id long, seq long, ts timestamp, signature array<long>")


@pytest.mark.parametrize("window,batches", [(5000, 1), (10, 1), (10, 5)])
def test_stream_state_gives_the_newest_earlier_copy(spark, window, batches):
    out, df = signed(spark)
    folder = shared_folder(spark, "recent-test")
    got = rows(recent.matches(recent.arrivals(df, folder, batches), folder, window=window))
    assert got == rows(recent.previous_match(df, window=window))
    keys = {}
    for i, _, band in hashed_bands(df, 32).select("id", "seq", "band").collect():
        keys.setdefault(i, set()).add(band)
    want = []
    for i, q, _, s in out:
        near = [(p, -j) for j, p, _, o in out if q - window <= p < q and keys[i] & keys[j] and np.mean(np.array(s) == np.array(o)) >= 0.9]
        if near:
            p, j = max(near)
            want.append((i, q, -j, p))
    assert got == sorted(want, key=repr)


def articles(spark, n):
    out = [(f"k{i % 17}", i, f"s{i % 3}", f"u{i}", date(2024, 1, 1 + i % 28), None, [float(i)]) for i in range(n)]
    return spark.createDataFrame(out, "key string, ord long, source string, url string, date date, signature array<long>, vector array<float>")


def test_runs_fold_and_a_failed_fold_does_no_harm(spark, monkeypatch):
    folder = shared_folder(spark, "folded-test")
    index = folded.FoldedIndex(spark, folder, fan=3, cut=None)
    whole = articles(spark, 60)
    part = lambda k: whole.where(F.floor(F.col("ord") / 5) == k)
    for k in range(12):
        if k == 5:
            with monkeypatch.context() as m:
                m.setattr(index, "write", lambda rows, level, turn, write=index.write: write(rows, level, turn) if level == 0 else (_ for _ in ()).throw(OSError("disk")))
                with pytest.raises(OSError):
                    index.append(part(k), k)
            index.append(part(k), k)  # it comes again: it is in, and changes nothing
        else:
            index.append(part(k), k)
        runs = index.manifest()["runs"]
        assert len(runs) <= 3 * 3 + (k == 5)
    index.fold()
    assert len(index.manifest()["runs"]) <= 2 * 3 and max(r["level"] for r in index.manifest()["runs"]) == 2
    want = {}
    for r in whole.orderBy("ord").collect():
        w = want.setdefault(r["key"], [r["ord"], [], [], r["date"], r["vector"]])
        w[1] += [r["source"]] * (r["source"] not in w[1])
        w[2].append(r["url"])
        w[3] = min(w[3], r["date"])
    assert {r["key"]: [r["ord"], r["sources"], r["urls"], r["date"], r["vector"]] for r in index.latest().collect()} == want
    with pytest.raises(RuntimeError):
        index.commit(99, [], index.manifest()["number"] - 1)


def test_near_copies_join_what_is_indexed(spark):
    rng = np.random.default_rng(8)
    a, b, c = (rng.integers(0, 1 << 30, 128).tolist() for _ in range(3))
    schema = articles(spark, 1).schema
    near = lambda s: [7] + s[1:]
    day = date(2024, 5, 1)
    index = folded.FoldedIndex(spark, shared_folder(spark, "near-test"), fan=2)
    index.append(spark.createDataFrame([("A", 1, "s", "u1", day, a, None), ("B", 2, "s", "u2", day, b, None)], schema), 0)
    index.append(spark.createDataFrame([("A2", 3, "t", "u3", date(2023, 1, 1), near(a), None), ("C", 4, "s", "u4", day, c, None), ("C2", 5, "s", "u5", day, near(c), None), ("D", 6, "s", "u6", day, None, None)], schema), 1)
    got = {r["key"]: (r["ord"], r["sources"], r["urls"], r["date"]) for r in index.latest().collect()}
    assert got == {"A": (1, ["s", "t"], ["u1", "u3"], date(2023, 1, 1)), "B": (2, ["s"], ["u2"], day), "C": (4, ["s"], ["u4", "u5"], day), "D": (6, ["s"], ["u6"], day)}


def test_folded_documents_with_near_copies(spark):
    index = folded.folded_articles(spark, DATA, batches=4, near=True)
    whole = folded.folded_articles(spark, DATA, batches=4)
    near, exact = index.latest(), whole.latest()
    assert near.count() < exact.count()
    urls = lambda df: sorted(r["u"] for r in df.select(F.explode("urls").alias("u")).collect())
    assert urls(near) == urls(exact)


def test_single_precision_vectors_travel_as_they_are(spark):
    rows = spark.range(50).selectExpr("id", "array(cast(id + 1 as float), cast(3 as float)) as vector")
    index = vector_index.build(rows, vector_index.fit(rows, lists=3))
    assert index.rows.schema["vector"].dataType.elementType.typeName() == "float"
    got = vector_index.search(rows, index, k=4, exact=True)
    assert sorted(got.collect()) == sorted(knn.nearest(rows, rows, k=4).select(got.columns).collect())
