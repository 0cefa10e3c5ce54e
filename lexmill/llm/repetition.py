"""Quality rules from a suffix array over words: repeated passages within a document.

The words of a batch of documents form one sequence in which no suffix of one document
ties with another's. Prefix doubling ranks the suffixes: every round sorts only what
still ties. Adjacent suffixes share a prefix whose length (LCP) comes from the ranks of
all rounds, largest power first. For position i, the longest of the two LCPs beside it is
the longest passage from i on that occurs twice; the spans [i, i + LCP) of at least
``min_words`` words are the occurrences of maximal repeated passages, and their union is
what the document repeats. The rules limit the covered fraction and the longest repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table, tidy

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\r\x0b\x0c"
WINDOW = 5
#: The base rules: least words, and the percentage of words in repeated five-word windows.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: The method's own rules: repeats from so many words on count, their share, and the longest one. Of the good texts of the
#: labelled tables none comes near: at most a fifth of their words is covered, the longest repeat has 13 words.
MIN_WORDS, MOST_COVERED, LONGEST = 4, 0.25, 25


def repeats(words: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For every position the length of the longest passage from there that its document holds twice.

    ``words``: ids; ``doc``: the document's number at each word, never falling.
    Lengths under 4 come out as 0.
    """
    n = words.size
    longest = np.zeros(n, dtype=np.int32)
    if n < 2:
        return longest
    end = np.flatnonzero(np.append(doc[1:] != doc[:-1], True)) + 1
    end = np.repeat(end, np.diff(end, prepend=0)).astype(np.int32)  # of each position's document
    order = np.lexsort((words, doc))
    fresh = np.append(True, (words[order[1:]] != words[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]]))
    first = np.flatnonzero(fresh)
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.repeat(first, np.diff(first, append=n))
    tied = order[np.repeat(np.diff(first, append=n) > 1, np.diff(first, append=n))]
    levels, step = [rank], 1
    while tied.size:
        ahead = tied + step
        nxt = np.where(ahead < end[tied], rank[np.minimum(ahead, n - 1)], -1)
        by = np.argsort(rank[tied].astype(np.int64) << 32 | (nxt + 1), kind="stable")
        tied, nxt = tied[by], nxt[by]
        old = rank[tied]
        group = np.append(True, old[1:] != old[:-1])
        part = group | np.append(True, nxt[1:] != nxt[:-1])
        at = np.arange(tied.size)
        base = np.maximum.accumulate(np.where(group, at, 0))
        start = np.flatnonzero(part)
        size = np.diff(start, append=tied.size)
        rank = rank.copy()
        rank[tied] = old + np.repeat(at[start], size) - base
        levels.append(rank)
        step *= 2
        tied = tied[np.repeat(size > 1, size)]
    suffix = np.empty(n, dtype=np.int32)
    suffix[rank] = np.arange(n, dtype=np.int32)
    if len(levels) < 3:
        return longest
    four = levels[2][suffix]
    pair = np.flatnonzero(four[1:] == four[:-1])
    a, b = suffix[pair], suffix[pair + 1]
    lcp = np.zeros(pair.size, dtype=np.int32)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + lcp, b + lcp
        same = (x < end[a]) & (y < end[b])
        same[same] = levels[k][x[same]] == levels[k][y[same]]
        lcp[same] += 1 << k
    np.maximum.at(longest, a, lcp)
    np.maximum.at(longest, b, lcp)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in a repeated passage of at least ``least`` words."""
    at = np.flatnonzero(longest >= least)
    change = np.zeros(longest.size + 1, dtype=np.int64)
    np.add.at(change, at, 1)
    np.add.at(change, at + longest[at], -1)
    return np.cumsum(change[:-1]) > 0


def spans_of(mask: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2])]


def measured(texts: list[str | None], min_words: int) -> Iterator[dict]:
    """The figures of each text of a batch."""
    ids: dict[bytes, int] = {}
    number = ids.setdefault
    rows, sizes = [], []
    for text in texts:
        words = (text or "").encode().split()
        sizes.append(len(words))
        rows.append(np.fromiter((number(w, len(ids)) for w in words), dtype=np.int64, count=len(words)))
    doc = np.repeat(np.arange(len(texts)), sizes)
    longest = repeats(np.concatenate(rows) if rows else np.empty(0, np.int64), doc)
    window, spans = covered(longest, WINDOW), covered(longest, min_words)
    ends = np.cumsum([0, *sizes])
    for text, a, b in zip(texts, ends[:-1], ends[1:]):
        text = text or ""
        seen: set[str] = set()
        again = 0
        for line in text.split("\n"):
            if line.strip(BLANKS):
                again += line in seen
                seen.add(line)
        yield {
            "n_words": int(b - a),
            "word_chars": len(text) - sum(map(text.count, BLANKS)),
            "n_symbols": sum(map(text.count, SYMBOLS)),
            "n_dup_lines": again,
            "n_repeat_words": int(window[a:b].sum()),
            "covered_words": int(spans[a:b].sum()),
            "longest_repeat": int(longest[a:b].max(initial=0)),
            "spans": spans_of(spans[a:b]),
        }


def repetition_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, most_covered: float = MOST_COVERED, longest: int = LONGEST, keep: tuple[str, ...] = ()) -> DataFrame:
    """The figures of every text, the word spans that it repeats, and the verdict.

    ``spans``: first and last word of each run covered by repeats of ``min_words`` words and
    more; ``longest_repeat`` is 0 below 4 words. Null and empty texts have no word and fail
    the base rules. Repeated rows stay; ``keep`` names columns to carry, others are left out.
    """
    small_batches(docs.sparkSession, rows=1000, mb=4)
    source = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"), *(F.col(c).alias(f"kept_{c}") for c in keep))
    kept = [f"kept_{c}" for c in keep]
    span = pa.struct([("first", pa.int32()), ("last", pa.int32())])
    longs = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [*measured(batch.column("text").to_pylist(), min_words)]
            columns = [pa.array([r[c] for r in rows], pa.int64()) for c in longs] + [pa.array([r["spans"] for r in rows], pa.list_(span))]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(batch.column(c) for c in kept), *columns], ["key", *kept, *longs, "spans"])

    given = ", ".join(f"`{c}` {source.schema[c].dataType.simpleString()}" for c in ("key", *kept))
    found = source.mapInArrow(tidy(run), f"{given}, {', '.join(f'{c} long' for c in longs)}, spans array<struct<first:int,last:int>>")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    good = (F.col("covered_words") <= most_covered * F.col("n_words")) & (F.col("longest_repeat") <= longest)
    names = [F.col("key").alias(id_col), *(F.col(f"kept_{c}").alias(c) for c in keep)]
    return found.select(*names, *longs, "spans", failed.alias("base_failed"), (~failed & good).alias("kept"))


def op5_suffix_repetition(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """The quality figures and verdict for every text of ``documents``."""
    found = repetition_rules(table(spark, sf_dir, "documents") if docs is None else docs)
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "covered_words")


def _windows(k: int) -> str:
    return f"""win{k} AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (
  SELECT doc_id, i, array_to_string(w[i:i + {k - 1}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - {k - 2})) AS i FROM words)) x),
rep{k} AS (SELECT doc_id, sum(least({k}, coalesce(nx - i, {k})))::BIGINT AS n FROM (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM win{k} WHERE c > 1) GROUP BY doc_id)"""


#: The longest repeat exceeds LONGEST words where a window of one word more occurs twice.
ORACLE = rf"""
WITH words AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
{_windows(WINDOW)}, {_windows(MIN_WORDS)}, {_windows(LONGEST + 1)},
lines AS (SELECT doc_id, (count(*) - count(DISTINCT line))::BIGINT AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM words) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(l.n, 0) AS n_dup_lines, coalesce(a.n, 0) AS n_repeat_words, coalesce(b.n, 0) AS covered_words, c.n IS NOT NULL AS too_long
  FROM words LEFT JOIN lines l USING (doc_id) LEFT JOIN rep{WINDOW} a USING (doc_id) LEFT JOIN rep{MIN_WORDS} b USING (doc_id) LEFT JOIN rep{LONGEST + 1} c USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words,
       n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words) AND covered_words <= {MOST_COVERED} * n_words AND NOT too_long AS kept
FROM base
"""
