"""The base columns of the secret scan from their contract alone, and the decoding of output codes by plain loops."""

import hashlib
import math
import os
import re

import numpy as np
import pyarrow.parquet as pq
import pytest

from lexmill.llm import langid, secret_scan

DATA = os.environ.get("LEXMILL_TESTDATA", "/root/testdata/sf0.001")
PATTERNS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[1]) >= 8),
    "access": (r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16),
    "hex": (r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
}


def base_of(text):
    spans = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, (pattern, good)) in enumerate(PATTERNS.items()) for m in re.finditer(pattern, text or "", re.ASCII) if good(m)]
    spans.sort()
    count = lambda name: sum(s.startswith(name) for *_, s in spans)
    return count("assign"), count("access"), count("hex"), hashlib.sha256(",".join(s for *_, s in spans).encode()).hexdigest(), [s for *_, s in spans]


def test_base_of_secrets(spark):
    docs = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{DATA}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    h = "0123456789abcdef"
    odd = [None, "", f"é API_KEY = 'short' apikey:{h}{h}", f"Token=\"{h}\" token=abc.def-ghi_jkl secret : password=12345678", f"AKIA{'A1' * 6} AKIA{'A1' * 5} xAKIA{'Z' * 40}", f"{h}{h[:15]} {h}{h} {h.upper()}{h}", f"passwd={h * 3}", "SECRET=aaaaaaaaſecret=bbbbbbbb PAſSWORD=cccccccc toKen=dddddddd", "password password=abcdefgh=ijkl"]
    docs += [(10**6 + i, t) for i, t in enumerate(odd)]
    got = {r["doc_id"]: r for r in secret_scan.op6_secret_scan(spark, "", spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert len(got) == len(docs)
    for doc, text in docs:
        want = base_of(text)
        assert (got[doc]["n_assign"], got[doc]["n_access"], got[doc]["n_hex"], got[doc]["base_sha256"]) == want[:4], text
        assert {*want[4]} <= {*filter(None, got[doc]["spans"].split(","))}
    assert sum(r["n_assign"] + r["n_access"] + r["n_hex"] for r in got.values()) > 5


@pytest.mark.parametrize("n", [2, 3, 5, 9])
def test_codes_are_decoded_as_by_hand(n):
    rng = np.random.default_rng(n)
    counts = rng.integers(0, 50, (n, langid.BUCKETS)).astype(float)
    counts[1] = counts[0] if n > 2 else counts[1]  # two languages that tie: the first stands
    names = [f"l{i}" for i in range(n)]
    model = langid.Model(names, counts)
    texts = ["the quick brown fox", "ein Satz über Äpfel", "x", "", None, "123 456", "word " * 500]
    for text, (lang, score, unsure) in zip(texts, model.predict(texts)):
        if not text or not any(map(str.isalpha, text)):
            assert (lang, score, unsure) == ("und", 0.0, False)
            continue
        grams = langid.ngrams(text).astype(float)
        total = grams.sum()
        loss = []
        for k in range(n):
            own = 0.0
            for b in range(model.code.shape[1]):
                margin = (sum(grams[i] * model.weights[i, b] for i in np.flatnonzero(grams)) / total - model.middle[b]) / model.gap[b]
                x = -langid.SHARPNESS * min(1, math.sqrt(total / 60)) * margin * model.code[k, b]
                own += model.trust[b] * (x + math.log1p(math.exp(-x)) if x > 0 else math.log1p(math.exp(x)))
            loss.append(own)
        like = [math.exp(min(loss) - x) for x in loss]
        like = [x / sum(like) for x in like]
        assert score == pytest.approx(max(like), rel=1e-2, abs=1e-3)
        best = [k for k in range(n) if like[k] >= max(like) - 1e-3]
        assert lang in {names[k] for k in best}
        if n > 2:
            assert lang != "l1"
        top = sorted(like)
        if abs(top[-1] - top[-2] - langid.AMBIGUOUS) > 1e-2:
            assert unsure == (top[-1] - top[-2] < langid.AMBIGUOUS)
