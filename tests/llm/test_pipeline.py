"""The stages of the pipeline one after the other against brute force on a small corpus."""

import collections
import random
import re

from test_jaccard_join import brute as brute_components
from test_text_operators import brute_templates

import corpus_pipeline as pipeline
from lexmill.llm import mixing, repetition
from lexmill.llm.common import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randrange(2, 7)))
    texts = ["\n".join(" ".join(word() for _ in range(rnd.randrange(4, 12))) for _ in range(6)) for _ in range(30)]
    texts += [texts[0], texts[1], texts[2] + " tail", "same word " * 30, "too short", None, ""]
    texts += [t + "\nAll rights reserved by the owner 2024" for t in texts[5:15]]
    return [(i, t, "en", rnd.choice(["s0", "s0", "s1", None]), len(t or "")) for i, t in enumerate(texts)]


def test_stages(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    stage = dict(pipeline.STAGES)
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "mixing sources to target weights", "BPE encoding and decoding"]
    local = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)

    kept = local(stage["quality rules"](spark, docs, ""))
    good = lambda g: g["n_words"] >= 10 and 100 * g["n_repeat_words"] <= 20 * g["n_words"] and g["covered_words"] <= repetition.MOST_COVERED * g["n_words"] and g["longest_repeat"] <= repetition.LONGEST
    assert kept == sorted((r for r, g in zip(rows, repetition.measured([r[1] for r in rows], repetition.MIN_WORDS)) if good(g)), key=repr)

    lines = local(stage["line dedup"](spark, spark.createDataFrame(kept, SCHEMA), ""))
    want = dict(brute_templates([(r[0], r[1]) for r in kept], keep_first=True))
    assert lines == sorted(((r[0], want[r[0]], r[2], r[3], len(want[r[0]])) for r in kept if want[r[0]].split() or want[r[0]] == r[1]), key=repr)

    single = local(stage["n-gram Jaccard join"](spark, spark.createDataFrame(lines, SCHEMA), ""))
    head = {k: c for k, _, c in brute_components([(r[0], r[1]) for r in lines], pipeline.SHINGLE, pipeline.PERCENT)}
    assert single == [r for r in lines if head[r[0]] == r[0]] and len(single) < len(lines)

    mixed = local(stage["mixing sources to target weights"](spark, spark.createDataFrame(single, SCHEMA), ""))
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    size, took = collections.Counter(), collections.Counter()
    for r in single:
        size[r[3]] += count(r[1])
    for r in mixed:
        took[r[3]] += count(r[1])
        assert any(s[0] == r[0] and s[1].startswith(r[1]) for s in single)
    keys = mixing.code_point_order([*size])
    goals = mixing.targets([size[k] for k in keys], [1 + i % 3 for i in range(len(keys))], 3)
    assert [took[k] for k in keys] == [int(g + 1e-6) for g in goals]

    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    found = stage["BPE encoding and decoding"](spark, spark.createDataFrame(mixed, SCHEMA), "").collect()
    assert sorted((r["doc_id"], r["ids"]) for r in found) == sorted((r[0], library.encode(r[1], add_special_tokens=False).ids) for r in mixed)
    assert all(r["round_trip"] for r in found)


def test_null_and_repeated_ids(spark):
    rnd = random.Random(4)
    text = lambda: " ".join("".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(40))
    a, b, c, d, e, f = (text() for _ in range(6))
    row = lambda i, t, source="s0": (i, t, "en", source, len(t))
    # Without an id, alone and beside a numbered copy; an id thrice for one text and once for another; negative ids.
    rows = [row(None, a), row(None, a), row(None, b), row(3, b), row(5, c), row(5, c), row(5, c), row(5, d), row(-2, e), row(1, e + " more"), row(None, f, None), row(None, f, None)]
    single = [row(None, a), row(3, b), row(5, c), row(5, d), row(-2, e), row(None, f, None)]
    stage = dict(pipeline.STAGES)
    local = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    got = stage["n-gram Jaccard join"](spark, spark.createDataFrame(rows, SCHEMA), "")
    assert local(got) == sorted(single, key=repr)

    count = lambda found: collections.Counter({k: sum(len(r[1].split()) for r in found if r[3] == k) for k in ("s0", None)})
    for given in (single, rows):
        mixed = local(stage["mixing sources to target weights"](spark, spark.createDataFrame(given, SCHEMA), ""))
        assert all(any(r[0] == s[0] and s[1].startswith(r[1]) and r[2:4] == s[2:4] and r[4] == len(r[1]) for s in given) for r in mixed)
        goals = mixing.targets([count(given)[k] for k in ("s0", None)], [1, 2], 3)
        assert [count(mixed)[k] for k in ("s0", None)] == [int(g + 1e-6) for g in goals]
    found = stage["BPE encoding and decoding"](spark, spark.createDataFrame(mixed, SCHEMA), "").collect()
    assert len(found) == len(mixed) and all(r["round_trip"] for r in found)


def test_nothing_in_nothing_out(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for _, f in pipeline.STAGES:
        docs = f(spark, docs, "")
    assert docs.count() == 0
