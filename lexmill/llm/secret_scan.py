"""Secret scans: fixed patterns, and a battery of randomness tests over token-like runs.

A run of 20 and more characters of an encoding's alphabet is a candidate. Its encoding
is inferred from its characters (hex, base32, base64, base64url). Its parts of that length
between slashes and plus signs, and between hyphens and underscores, are candidates too:
keys stand in paths, and two alphabets in one run. The battery asks how
well the run agrees with independent, uniform symbols of that alphabet:

* chi-squared of the symbol counts (over bins of about five expected symbols),
* a runs test of the symbols' upper against lower half,
* the serial correlation of neighbouring symbols.

The three p-values are joined by Fisher's method. The reverse question, whether text
could look so random, is a one-sided test of the mean log-likelihood ratio of uniform
symbols against a word-like model: a chain of upper case, lower case, digits and signs,
which in words, names, paths and numbers seldom change, and letters as in running text
within a case. Its error falls with the length. Within
each document the latter p-values go through a step-up false-discovery procedure whose
weights are proportional to length, so that long runs are found without short ones
flooding in. A run that survives and that the battery does not reject is a secret;
of overlapping ones the longest.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table

#: Fixed patterns. Upper and lower case of ASCII letters only.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
HINTS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
PARTS = (re.compile(r"[A-Za-z0-9_-]{20,}"), re.compile(r"[A-Za-z0-9+/]{20,}"))
#: Relative frequencies of letters in running Latin text, in per mille.
LETTERS = dict(zip("etaoinshrdlcumwfgypbvkjxqz", (127, 91, 82, 75, 70, 67, 63, 61, 60, 43, 40, 28, 28, 24, 24, 22, 20, 20, 19, 15, 10, 8, 2, 2, 1, 1)))
#: What follows a lower-case letter, an upper-case one, a digit and a sign in word-like runs.
CLASSES = ("lower", "upper", "digit", "sign")
FOLLOWS = {"lower": (0.87, 0.04, 0.03, 0.06), "upper": (0.45, 0.45, 0.04, 0.06), "digit": (0.05, 0.03, 0.77, 0.15), "sign": (0.60, 0.20, 0.17, 0.03)}
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
FALSE_DISCOVERIES = 0.001
REJECT = 0.0005


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi2_tail(x: float, k: int) -> float:
    """Wilson and Hilferty's approximation."""
    return normal_tail(((max(x, 0) / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k)))


def encoding_of(run: str) -> str | None:
    used = set(run)
    return next((name for name, letters in ALPHABETS.items() if used <= set(letters)), None)


def battery(run: str, alphabet: str) -> float:
    """Fisher's joint p-value of the three tests under independent uniform symbols."""
    at, n, m = {c: i for i, c in enumerate(alphabet)}, len(run), len(alphabet)
    x = [at[c] for c in run]
    bins = max(2, min(m, n // 5))
    counts = Counter(i * bins // m for i in x)
    size = Counter(i * bins // m for i in range(m))
    chi = sum((counts[b] - n * size[b] / m) ** 2 / (n * size[b] / m) for b in range(bins))
    p = [2 * min(q := chi2_tail(chi, bins - 1), 1 - q)]  # too even is no chance either
    high = [2 * i >= m for i in x]
    changes, up = sum(a != b for a, b in zip(high, high[1:])), sum(high)
    expected = 2 * up * (n - up) / n
    var = expected * (expected - 1) / (n - 1)
    p.append(2 * normal_tail(abs(changes - expected) / math.sqrt(var)) if var > 0 else 1e-12)
    mean = sum(x) / n
    spread = sum((i - mean) ** 2 for i in x)
    r = sum((a - mean) * (b - mean) for a, b in zip(x, x[1:])) / spread if spread else 1.0
    p.append(2 * normal_tail(abs(r + 1 / n) * math.sqrt(n)))
    return chi2_tail(-2 * sum(math.log(max(q, 1e-12)) for q in p), 6)


def class_of(c: str) -> str:
    return "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "sign"


def _word_model(alphabet: str) -> tuple[dict[tuple[str, str], float], float, float]:
    """For each class and the symbol behind it the log-ratio of uniform to word-like, and the ratio's mean and deviation for word-like runs."""
    held = [k for k in CLASSES if any(class_of(c) == k for c in alphabet)]
    follows = {k: {j: v for j, v in zip(CLASSES, FOLLOWS[k]) if j in held} for k in CLASSES}
    follows = {k: {j: v / sum(row.values()) for j, v in row.items()} for k, row in follows.items()}
    weight = {c: LETTERS[c.lower()] + 6 if c.isalpha() else 1 for c in alphabet}
    total = {k: sum(w for c, w in weight.items() if class_of(c) == k) for k in held}
    chance = {(k, c): follows[k][class_of(c)] * weight[c] / total[class_of(c)] for k in CLASSES for c in alphabet}
    share = dict.fromkeys(held, 1 / len(held))
    for _ in range(200):
        share = {j: sum(share[k] * follows[k][j] for k in held) for j in held}
    ratio = {x: -math.log(len(alphabet) * v) for x, v in chance.items()}
    mean = sum(share[k] * chance[k, c] * ratio[k, c] for k in held for c in alphabet)
    return ratio, mean, math.sqrt(sum(share[k] * chance[k, c] * (ratio[k, c] - mean) ** 2 for k in held for c in alphabet))


MODELS = {name: _word_model(letters) for name, letters in ALPHABETS.items()}


def wordlike_p(run: str, name: str) -> float:
    """How probable a ratio as high is for word-like text of this length."""
    ratio, mean, spread = MODELS[name]
    classes = ["sign", *map(class_of, run)]
    return normal_tail((sum(ratio[x] for x in zip(classes, run)) / len(run) - mean) * math.sqrt(len(run)) / (1.5 * spread))


def candidates(text: str) -> set[tuple[int, int, str]]:
    """(start, end, run without padding) of every run and of its parts."""
    found = set()
    for m in CANDIDATE.finditer(text):
        run = m[0].rstrip("=")
        parts = [(m.start() + p.start(), p[0]) for part in PARTS for p in part.finditer(run)] + [(m.start(), run)]
        found |= {(a, m.end() if a + len(r) == m.start() + len(run) else a + len(r), r) for a, r in parts}
    return found


def random_spans(text: str) -> list[tuple[int, int]]:
    found = [(wordlike_p(run, name), len(run), a, b, run, name) for a, b, run in candidates(text) if (name := encoding_of(run))]
    if not found:
        return []
    mean = sum(x[1] for x in found) / len(found)
    ranked = sorted((p * mean / n, a, b, run, name) for p, n, a, b, run, name in found)
    last = max((i for i, x in enumerate(ranked, 1) if x[0] <= FALSE_DISCOVERIES * i / len(ranked)), default=0)
    spans = []
    for _, a, b, run, name in sorted(ranked[:last], key=lambda x: (x[1] - x[2], x[1])):
        if battery(run, ALPHABETS[name]) >= REJECT and not any(a < y and x < b for x, y in spans):
            spans.append((a, b))
    return sorted(spans)


def scan(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """The base spans and all spans, as (start, number of the kind, end)."""
    low = text.lower()
    base = []
    if any(h in low for h in HINTS):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base.sort()
    held = [(a, b) for a, _, b in base]
    more = [(a, 3, b) for a, b in random_spans(text) if not any(a < y and x < b for x, y in held)]
    return base, sorted(base + more)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``spans array<struct<kind, start, end, base>>`` in code points, end exclusive, by start.

    Null and empty texts give an empty array; whole texts are scanned; repeated rows stay;
    other columns are ignored. Lone-run tests overlap no base span; base spans may overlap one another.
    """
    small_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [[{"kind": KINDS[k], "start": a, "end": b, "base": k < 3} for a, k, b in scan(t or "")[1]] for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(rows, pa.list_(span))], ["key", "spans"])

    kind = source.schema["key"].dataType.simpleString()
    return source.mapInArrow(run, f"key {kind}, spans array<struct<kind:string,start:int,end:int,base:boolean>>").withColumnRenamed("key", id_col)


def op6_secret_scan(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Secrets in every text of ``documents``: base counts, the base spans' digest, all spans."""
    found = find_secrets(table(spark, sf_dir, "documents") if docs is None else docs)
    base = F.filter("spans", lambda s: s["base"])
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
