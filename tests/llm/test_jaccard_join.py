"""The n-gram Jaccard join against brute force, with tiles small enough to be cut."""

import random
import re

import pytest

from lexmill.llm import jaccard_join, shared_shingles


def brute(rows, n, percent):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    head = [*range(len(rows))]

    def find(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                head[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k, len(sets[i]), least.get(find(i))) for i, (k, _) in enumerate(rows)), key=repr)


def corpus(seed):
    rnd = random.Random(seed)
    rows = []
    for family in range(6):
        base = [f"f{family}w{rnd.randrange(400)}" for _ in range(rnd.randrange(30, 120))]
        for _ in range(rnd.randrange(3, 25)):
            words = [rnd.choice(["x", "y", "z"]) + str(rnd.randrange(99)) if rnd.random() < 0.02 else w for w in base]
            rows.append(" ".join(words[: len(words) - rnd.randrange(0, 6)]))
    rows += rows[:9] + [" ".join(rows[k].split()[::-1]) for k in range(4)] + ["A b C", "a B c", "a b", None, "", " \n ", "a b c d"]
    return [*enumerate(rows)]


@pytest.mark.parametrize("seed, n, percent, tile", [(1, 4, 85, 4), (2, 5, 80, 1024)])
def test_components(spark, monkeypatch, seed, n, percent, tile):
    monkeypatch.setattr(jaccard_join, "TILE", tile)
    monkeypatch.setattr(jaccard_join, "SHARE", 3)
    if tile == 4:  # blocks of few shingles, in many buckets
        monkeypatch.setattr(shared_shingles, "BLOCK", 300)
        monkeypatch.setattr(shared_shingles, "BLOCK_DOCS", 3)
        monkeypatch.setattr(shared_shingles, "BUCKET", 200)
    rows = corpus(seed) + [(None, "a b c d e f g"), (None, "A B C D E F G"), (3, "same id other text now")]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), n=n, percent=percent)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, n, percent)


def test_empty(spark):
    assert jaccard_join.op7_tile_jaccard(spark, "", spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_ruled_out(spark):
    """Exactly the documents of which too few shingles occur in another are ruled out."""
    rnd = random.Random(8)
    word = lambda: f"w{rnd.randrange(10**6)}"
    shared = [word() for _ in range(100)]
    # 97 shingles of 4 words in all; the first k are shared.
    texts = {k: " ".join(shared[: k + 3] + [word() for _ in range(97 - k)]) for k in (97, 84, 83, 82, 81, 40)}
    docs = spark.createDataFrame([(k, t) for k, t in texts.items()] + [(0, " ".join(shared)), (1, None)], "doc_id long, text string")
    out = {r["node"] for r in shared_shingles.cannot_link(docs, 97 * 7, 4, 85).collect()}
    nodes = dict(zip(texts, shared_shingles.nodes_of(shared_shingles.shingle_sets([*texts.values()], 4)).tolist()))
    assert {k for k, node in nodes.items() if node in out} == {82, 81, 40}  # 83 of 97 is the first share of 85 percent
