"""Lexical search, conversation trie and attention scores against brute force."""

import hashlib
import math
import re
import resource
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lexmill.llm import attention_lm as lm
from lexmill.llm import lexical_search as search
from lexmill.llm import prefix_trie as trie
from lexmill.llm.common import tokenizer_file

PIECE = "piece_bpe_32k.model"


# Search


def small(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def ranked(docs, items, top):
    held = [(i, Counter(re.findall(search.TERM, small(t)))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = defaultdict(set)
    for item, text in items:
        wanted[item] |= {*re.findall(search.TERM, small(text))}
    out = []
    for item, terms in wanted.items():
        found = []
        for doc, c in held:
            m = 50 + 50 * sum(c.values()) * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, k, doc, -s) for k, (s, _, _, doc) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("window", [1, 7, search.WINDOW])
def test_search_equals_brute_force(spark, window):
    rng = np.random.default_rng(3)
    words = ["ab", "Ab", "ÄB", "äb", "c9", "x_y", "日本", "é", "zz", "\x00q", "-", "~", "one", "two", "three"]
    docs = [(int(i) * 10**15, " ".join(rng.choice(words, rng.integers(0, 30)))) for i in rng.permutation(60)]
    docs += [docs[0], (docs[1][0], "one zz zz"), (None, "one two"), (None, "two"), (7, None), (8, ""), (9, "-- \t"), (11, "zz " * 3000 + "one")]
    items = [(1, "one two-three"), (2, "AB; äb ÄB"), (3, None), (4, ""), (5, "absent"), (6, "日本 é \x00Q c9"), (6, "zz"), (None, "x y")]
    got = search.lexical_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), spark.createDataFrame(items, "item_id long, text string"), top=5, window=window, block=4)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == ranked(docs, items, 5)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, item long, rank int, ids long")
    items = spark.createDataFrame([(1, "one", 3, "x")], "item_id long, text string, id long, terms string")
    got = search.lexical_search(none, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0
    some = spark.createDataFrame([(1, "one", 3, 4, 5)], none.schema)
    assert search.lexical_search(some, items.limit(0)).count() == 0
    assert search.lexical_search(some, items).count() == 1


# Trie


def nodes(turns):
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(x)] for c, x in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:]
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children, leaves, saved = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in children
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode()) if k else 0
    ends = {k: ",".join(str(c) for c in sorted(m) if len(built[c]) == len(k)) for k, m in members.items()}
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children[k], leaves[k], saved[k], hashlib.sha256(ends[k].encode()).hexdigest()) for k, m in members.items()), key=repr)


def conversations(seed, n):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(n):
        length = int(rng.choice([0, 1, 1, 2, 3, 5, 9, 12]))
        shared = int(rng.integers(0, 3))
        for t in range(length):
            rows.append((c, t if rng.random() < 0.9 else None, "u" if t % 2 else None, f"é{int(rng.integers(0, 3)) if t > shared else 0}"))
    return rows


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_trie_equals_brute_force(spark, parts):
    rows = conversations(parts, 120)
    rows += [(200 + c, t, "r", "same") for c in range(30) for t in range(400 if c < 3 else 4)]  # long paths, copies
    rows += [(-7, 0, "r", "x"), (None, 0, "r", "lost"), (301, 5, None, None), (301, 5, None, None), (302, 0, "ab", "c"), (303, 0, "a", "bc")]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = trie.conversation_trie(spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, node long")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((tuple(r) for r in got), key=repr) == nodes(rows)


def test_trie_of_nothing_and_of_turnless(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie.conversation_trie(spark.createDataFrame([], schema)).count() == 0
    lone = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)  # its family's first is absent
    rows = [(lone, 0, "r", "gone")]
    got = trie.conversation_trie(spark.createDataFrame(rows, schema)).collect()
    assert [tuple(r) for r in got] == nodes(rows) and got[0]["n_leaves"] == 1


# Scores


def texts(n, seed=0):
    rng = np.random.default_rng(seed)
    tongues = [["the ", "of ", "and ", "house ", "Tree, "], ["der ", "und ", "haus ", "Baum, ", "über "]]
    return ["".join(rng.choice(tongues[i % 2], rng.integers(1, 80))) for i in range(n)]


def base_of(rows):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    words = lambda t: [small(w) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    counts, docs = Counter(), 0
    for i, t in rows:
        if not held(i):
            counts.update(words(t))
            docs += 1
    total, distinct = sum(counts.values()) + docs, len(counts) + (docs > 0)
    for i, t in rows:
        c = [counts[w] for w in words(t)] + [docs]
        yield i, held(i), len(c), sum(x > 0 for x in c), total, round(sum(math.log10((x + 1) / (total + distinct + 1)) for x in c), 6)


@pytest.mark.parametrize("most", [0, 3, lm.LEXICON])
def test_base_scores_equal_brute_force(spark, most):
    rows = [*enumerate(texts(60)), (None, "the house"), (None, None), (3, ""), (5, "x" * 70 + " the " + "y" * 2000), (70, "x" * 70 + " x y ÄÖ ab"), (70, "x" * 70 + " x y ÄÖ ab"), (71, "😀 " * 3)]
    path = tokenizer_file(PIECE)
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row int").withColumnRenamed("row", "key").repartition(3)
    learned = lm.learn(docs.where(~lm.held_out("doc_id")).select(docs.doc_id.alias("key"), "text"), path, lexicon=most)
    got = lm.score_texts(docs, learned, path).collect()
    want = [(i, n, known, base) for i, _, n, known, _, base in base_of(rows)]
    assert sorted(((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got), key=repr) == sorted(want, key=repr)
    assert learned[3]["tokens"] == next(base_of(rows))[4]
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_subwords_of_long_words_count(spark):
    path = tokenizer_file(PIECE)
    given = [*texts(30), "https://example.org/" + "pages/of/the/house/" * 9 + " the house", "ÄÖ😀" * 40 + " garden " + "ÄÖ😀" * 40, "x" * 30_000, None, ""] * 2
    docs = spark.createDataFrame([*enumerate(given)], "key long, text string").repartition(3)
    model, counts, _, sums = lm.counted(docs, path)
    uni, pieces = np.zeros(lm.PIECES), lm.Pieces(path)
    for text in given:
        uni += np.bincount(pieces(lm.words_of(text))[0], minlength=lm.PIECES)
    uni[lm.END] = len(given)
    rank = np.full(lm.PIECES, lm.RARE, dtype=np.int16)
    rank[np.lexsort((np.arange(lm.PIECES), -uni))[: lm.OWN]] = np.arange(lm.OWN)
    assert np.array_equal(model.rank, rank)
    assert np.allclose(np.exp(model.spare[rank == lm.RARE]) * (uni[rank == lm.RARE] + 0.5).sum() - 0.5, uni[rank == lm.RARE], atol=1e-6)
    after, edge = np.zeros((lm.OWN + 2, lm.OWN + 2)), lm.OWN + 1
    for word in (w for text in given for w in lm.words_of(text)):
        way = [edge, *rank[pieces([word])[0]], edge]
        np.add.at(after, (way[:-1], way[1:]), 1)
    assert np.allclose(model.flat, lm.started(uni, after, rank, model.spare, len(given)).flat)
    words = Counter(lm.name_of(w).decode() for text in given for w in lm.words_of(text))
    assert {r["word"]: r["n"] for r in counts.collect()} == words and sums["tokens"] == words.total() + len(given)


def model_of(seed=1):
    rng = np.random.default_rng(seed)
    rank = np.minimum(np.arange(lm.PIECES), lm.RARE).astype(np.int16)
    spare = np.where(rank == lm.RARE, -np.log((rank == lm.RARE).sum()), 0.0)
    return lm.Model(rng.normal(0, 0.3, lm.Model.size()), rank, spare)


def test_windows_score_each_id_once_as_attention_by_hand():
    path = tokenizer_file(PIECE)
    lex, model = lm.Lexicon([b"the", b"house"], np.array([5, 3]), path), model_of()
    given = [None, "", "the house " * 40, "one"]
    read = lex.read(given)
    got = read.scores(model)
    pieces = lm.Pieces(path)
    for text, score in zip(given, got):
        ids = pieces(lm.words_of(text))[0].tolist() + [lm.END]
        u = [lm.BEGIN] * (lm.SPAN - lm.STEP + 1) + model.rank[ids].tolist()
        total = 0.0
        for t, target in enumerate(u[lm.SPAN - lm.STEP + 1 :]):
            here = t + lm.SPAN - lm.STEP  # place of the id before the target
            back = range(t // lm.STEP * lm.STEP, here + 1)
            a = np.array([model.query[u[here]] @ model.key[u[s]] + model.bias[here - s] for s in back])
            a = np.exp(a - a.max())
            h = (a / a.sum()) @ model.value[[u[s] for s in back]] + model.direct[u[here]]
            first = model.head @ h + model.head_bias
            first -= np.log(np.exp(first).sum())
            group = sum(target >= c for c in lm.CUTS[1:])
            total += first[target if target < lm.HEAD else lm.HEAD + group]
            if target >= lm.HEAD:
                rows = slice(lm.CUTS[group] - lm.HEAD, lm.CUTS[group + 1] - lm.HEAD)
                second = model.tail[rows] @ h + model.tail_bias[rows]
                total += second[target - lm.CUTS[group]] - np.log(np.exp(second).sum())
            total += model.spare[ids[t]]
        assert score == pytest.approx(total, rel=1e-4)


def test_next_ids_sum_to_one():
    model, rng = model_of(), np.random.default_rng(5)
    x = np.repeat(rng.integers(0, lm.OWN, (1, lm.SPAN + 1)), lm.OWN + 1, axis=0)
    x[:, -1] = np.arange(lm.OWN + 1)
    last = model.forward(x)[0].reshape(-1, lm.STEP)[:, -1]
    assert np.exp(last.astype(float)).sum() == pytest.approx(1, abs=1e-4)
    assert np.exp(model.spare[model.rank == lm.RARE]).sum() == pytest.approx(1)


def test_gradient_by_differences():
    model, rng = model_of(), np.random.default_rng(9)
    x = rng.integers(0, lm.OWN + 2, (6, lm.SPAN + 1))
    g = model.gradient(x)
    loss = lambda m: -m.forward(x)[0].astype(float).sum() / max(1, (x[:, lm.SPAN - lm.STEP + 1 :] != lm.BEGIN).sum())
    for at in [*np.argsort(-np.abs(g))[:12], *rng.choice(np.flatnonzero(np.abs(g) > 1e-3), 12)]:
        up, down = model.with_weights(model.flat), model.with_weights(model.flat)
        up.flat[at] += 1e-2
        down.flat[at] -= 1e-2
        assert (loss(up) - loss(down)) / 2e-2 == pytest.approx(g[at], rel=0.05, abs=2e-4)


def test_every_training_text_gives_gradients(spark):
    path, model = tokenizer_file(PIECE), model_of()
    shared = spark.sparkContext.broadcast(("every", [b"the"], np.array([5])))
    for i, text in enumerate(["the house", "a garden of the house", "no garden", "the house again"]):
        one = spark.createDataFrame([(i, text)], "key long, text string").coalesce(1)
        assert not np.array_equal(lm.train(one, model, shared, path).flat, model.flat)


def test_gradients_do_not_ask_the_system_for_memory_again():
    model, rng = model_of(), np.random.default_rng(4)
    x = rng.integers(0, lm.OWN, (256, lm.SPAN + 1))

    def run(batches):
        for _ in batches:
            faults = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
            model.gradient(x)
            yield resource.getrusage(resource.RUSAGE_SELF).ru_minflt - faults

    assert np.median([*lm.roomy(run)(iter(range(12)))][2:]) < 300  # some 2400 pages where freed memory goes back


def test_texts_are_read_once_for_training_and_scores(spark):
    path, start = tokenizer_file(PIECE), model_of()
    given = [*enumerate(texts(40)), (None, "the house"), (7, None), (8, ""), (9, "😀 ÄÖ " * 30)]
    docs = spark.createDataFrame(given, "key long, text string").coalesce(1)
    shared = spark.sparkContext.broadcast(("once", [b"the", b"house"], np.array([5, 3])))
    rows = lm.encoded(docs, start, shared, path)
    assert "text" not in rows.columns and rows.count() == len(given)
    model = lm.train(rows, start, shared, path)
    assert np.array_equal(model.flat, lm.train(docs, start, shared, path).flat)
    counts = spark.createDataFrame([("the", 5), ("house", 3)], "word string, n long")
    got = lm.scored(rows, (model, counts, shared, {"docs": 2, "tokens": 10, "distinct": 3})).collect()
    want = lm.Lexicon([b"the", b"house"], np.array([5, 3]), path).read([t for _, t in given]).scores(model) / math.log(10)
    near = lambda pairs: sorted(((k, round(float(v), 2)) for k, v in pairs), key=repr)
    assert near((r["key"], r["score"]) for r in got) == near((k, v) for (k, _), v in zip(given, want))


def test_a_batch_of_texts_without_words(spark):
    path, start = tokenizer_file(PIECE), model_of()
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "doc_id long, text string").coalesce(1)
    counts = spark.createDataFrame([("the", 5)], "word string, n long")
    shared = spark.sparkContext.broadcast(("wordless", [b"the"], np.array([5])))
    got = lm.score_texts(docs, (start, counts, shared, {"docs": 2, "tokens": 7, "distinct": 2}), path).collect()
    assert [(r["n_tokens"], r["n_known"]) for r in got] == [(1, 1)] * 3
    assert {round(r["base_score"], 9) for r in got} == {round(math.log10(3) - math.log10(10), 9)}


def test_held_out_texts_score_better_than_by_words_alone(spark):
    docs = spark.createDataFrame([*enumerate(texts(700, 4))], "doc_id long, text string")
    got = lm.op13_attention_scores(spark, "", docs).where("held_out").groupBy().sum("score", "base_score").first()
    assert got["sum(score)"] > got["sum(base_score)"]
    again = lm.op13_attention_scores(spark, "", docs.limit(0))
    assert again.count() == 0
