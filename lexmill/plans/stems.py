"""Stems of the words of ``documents``, beside SQL that takes the same steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stem as st
from .catalogue import query, t


def _end(x: str, *lists: str) -> str:
    return f"regexp_extract({x}, '({'|'.join(' '.join(lists).split())})$', 1)"


def _cut(x: str, s: str) -> str:
    return f"left({x}, length({x}) - length({s}))"


def _drop(x: str, region: str, *lists: str) -> str:
    s = _end(x, *lists)
    return f"(CASE WHEN {s} <> '' AND length({x}) - length({s}) >= {region} THEN {_cut(x, s)} ELSE {x} END)"


def _in(words: str) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words.split()) + ")"


V, C = f"[{st.VOWELS}]", f"[^{st.VOWELS}]"
IV = _end("rest", "iv os ic ad")
STEMS = f"""words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS word FROM documents),
a AS (SELECT word, length(word) - length(regexp_extract(word, '^(?:.{C}+{V}|{V}{V}+{C}|{C}{V}.)(.*)$', 1)) AS rv, regexp_extract(word, '^.*?{V}{C}(.*)$', 1) AS one, {_end('word', st.PRONOUNS)} AS s FROM words),
b AS (SELECT *, length(word) - length(one) AS r1, length(word) - length(regexp_extract(one, '^.*?{V}{C}(.*)$', 1)) AS r2, {_cut('word', 's')} AS base FROM a),
c AS (SELECT *, {_end('base', st.GERUNDS)} AS g FROM b),
d AS (SELECT word, rv, r1, r2, CASE WHEN s <> '' AND g <> '' AND length(base) - length(g) >= rv AND (g <> 'yendo' OR base LIKE '%uyendo') THEN {_cut('base', 'g')} || translate(g, 'éáí', 'eai') ELSE word END AS w FROM c),
e AS (SELECT *, {_end('w', st.PLAIN, st.ACTIONS, st.LOGIES, st.UTIONS, st.ENCES, 'amente mente', st.QUALITIES, st.IVES)} AS s FROM d),
f AS (SELECT *, {_cut('w', 's')} AS rest, length(w) - length(s) AS k FROM e),
one AS (SELECT word, rv, w, CASE WHEN s = '' THEN w
  WHEN s = 'amente' THEN CASE WHEN k < r1 THEN w WHEN {IV} <> '' AND length(rest) - length({IV}) >= r2 THEN CASE WHEN {IV} = 'iv' THEN {_drop(f"({_cut('rest', IV)})", 'r2', 'at')} ELSE {_cut('rest', IV)} END ELSE rest END
  WHEN k < r2 THEN w WHEN s IN {_in(st.PLAIN)} THEN rest WHEN s IN {_in(st.ACTIONS)} THEN {_drop('rest', 'r2', 'ic')} WHEN s IN {_in(st.LOGIES)} THEN rest || 'log' WHEN s IN {_in(st.UTIONS)} THEN rest || 'u' WHEN s IN {_in(st.ENCES)} THEN rest || 'ente'
  WHEN s = 'mente' THEN {_drop('rest', 'r2', 'ante able ible')} WHEN s IN {_in(st.QUALITIES)} THEN {_drop('rest', 'r2', 'abil ic iv')} ELSE {_drop('rest', 'r2', 'at')} END AS done FROM f),
g AS (SELECT *, {_end('substr(w, rv + 1)', st.Y_VERBS)} AS y, {_end('substr(w, rv + 1)', st.GU_VERBS, st.VERBS)} AS o FROM one),
two AS (SELECT word, rv, CASE WHEN done <> w THEN done WHEN y <> '' AND {_cut('w', 'y')} LIKE '%u' THEN {_cut('w', 'y')}
  WHEN o <> '' THEN CASE WHEN o IN {_in(st.GU_VERBS)} AND {_cut('w', 'o')} LIKE '%gu' THEN left(w, length(w) - length(o) - 1) ELSE {_cut('w', 'o')} END ELSE w END AS w FROM g),
h AS (SELECT *, {_end('w', 'os a o á í ó e é')} AS s FROM two),
stems AS (SELECT word, translate(CASE WHEN s = '' OR length(w) - length(s) < rv THEN w WHEN s IN ('e', 'é') AND {_cut('w', 's')} LIKE '%gu' AND length(w) - length(s) - 1 >= rv THEN left(w, length(w) - length(s) - 1) ELSE {_cut('w', 's')} END, 'áéíóú', 'aeiou') AS stem FROM h)"""


@query("spanish_stems", f"WITH {STEMS} SELECT word, stem FROM stems")
def spanish_stems(spark, d):
    """Every different word of the texts with its stem, found once a word."""
    words = t(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), 0)).alias("word")).distinct()
    return words.select("word", st.stem(F.col("word")).alias("stem"))
