"""Functions on small literal tables."""

import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.functions import geo, text, vector


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x"))).first()[0]


def test_accents(spark):
    plain = lambda s: "".join(c for c in unicodedata.normalize("NFD", s.lower()) if unicodedata.category(c) != "Mn")
    for s in ("Ñandú ÁÉÍ", "øæß ç", "ȩ́", "Åström", "", "ΆΈ", None):
        assert one(spark, s, text.normalize) == (None if s is None else plain(s))


@settings(max_examples=20, deadline=None)
@given(st.text(alphabet="aáñ ÇÜß.9", max_size=12))
def test_normalize_twice_is_once(s):
    table = str.maketrans(dict(zip(text.accent_table()[0], text.accent_table()[1])))
    assert s.lower().translate(table).lower().translate(table) == s.lower().translate(table)


def test_names(spark):
    cases = {"Dr. Ana Pérez, S.L.": "ana perez s l", "ACME Inc": "acme", "Dr.": "", 'O"Neil (Sr)': "o neil", "x y": "x y"}
    for name, key in cases.items():
        assert one(spark, name, text.normalize_name) == key


def test_counts_and_shingles(spark):
    assert one(spark, "One. Two!? \n", text.sentence_count) == 2
    assert one(spark, " a  b\tc ", text.word_count) == 3
    cut = lambda c: text.shingles(text.words(c))
    assert one(spark, "a b c d", cut) == ["a b c", "b c d"]
    assert one(spark, "a b", cut) == ["a b"]
    assert one(spark, "  ", cut) == []
    assert one(spark, "  A \n B ", text.fingerprint) == "a b"
    assert one(spark, ["x", "y"], text.numbered, "array<string>") == "1. x\n2. y"
    assert one(spark, "Avda. de la Paz", text.is_street) and not one(spark, "Callejón", text.is_street)
    assert one(spark, "C/ Mayor 3", text.without_street_prefix) == "Mayor 3"


def test_vectors_and_distance(spark):
    row = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0], [0.0, 0.0])], "a array<float>, b array<float>, z array<float>")
    got = row.select(vector.cosine(F.col("a"), F.col("b")), vector.cosine(F.col("a"), F.col("z")), vector.agreement(F.col("a"), F.col("b")), vector.agreement(F.array().cast("array<float>"), F.array().cast("array<float>"))).first()
    assert abs(got[0] - 0.5**0.5) < 1e-9 and got[1] is None and got[2] == 0.5 and got[3] == 0.0
    km = spark.range(1).select(geo.haversine(F.lit(40.4168), F.lit(-3.7038), F.lit(41.3874), F.lit(2.1686))).first()[0]
    assert abs(km - 505) < 2


def test_composed_hangul_comes_apart(spark):
    import unicodedata

    texts = ["한국어 Éa", "가힣각", "ㄱ ascii", "Ñandú", "각".encode().decode() + "é" * 3, None]
    folded = lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFD", t.lower()) if not unicodedata.combining(c))
    from lexmill.functions.text import normalize

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r["n"] for r in df.select(normalize(df.t).alias("n")).collect()] == [folded(t) for t in texts]
