"""Nulls, empty texts, a long text, ties, repeated rows, clashing columns and empty tables through every query of documents."""

import pytest

from lexmill.llm import queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, id long, node long, place string, ids array<int>, start long, shard int, kept boolean, size long"
MORE = ("k", 1, 2, "p", [1], 3, 4, True, 5)
LONG = " ".join(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}" for i in range(40_000))
TEXTS = [None, "", " \n\t ", "one", "The quick brown fox jumps over the lazy dog.\npassword = hunter2hunter", "Der schnelle braune Fuchs springt über den faulen Hund", "Der schnelle braune Fuchs springt über den faulen Hund", LONG]
NAMES = [n for n in queries.queries() if n not in ("op2_warc_shards", "op11_bucket_search", "op12_conversation_trie")]


@pytest.mark.parametrize("name", NAMES)
def test_rows_in_rows_out(spark, name):
    rows = [(i, t, "en" if i % 2 else "de", "s" if i % 3 else None, len(t or ""), *MORE) for i, t in enumerate(TEXTS)]
    rows += [rows[4], (4, "another text of the same id", "en", "s", 1, *MORE), (None, "a text without id", None, "s", 1, *MORE), (None, None, None, None, None, *MORE)]
    run = queries.queries()[name]
    found = run(spark, "", spark.createDataFrame(rows, SCHEMA))
    got = found.collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] for r in got), key=repr) == sorted((r[0] for r in rows), key=repr)
    empty = run(spark, "", spark.createDataFrame([], SCHEMA))
    assert empty.columns == found.columns and empty.count() == 0
