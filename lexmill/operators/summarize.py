"""Summaries: budgets, extractive reduction, length checks and a second try for what fails them.

Generation itself is an adapter: a function of a DataFrame with ``prompt`` that adds
``result`` (and may fail row by row with a null). None is built in.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.stem import STOP_WORDS, stem
from ..functions.text import bullets, labelled_line, let, normalize, numbered, sentence_count, sentences, word_count, words

BUDGET, HEADLINE, SUMMARY, CHUNK = 400, (8, 15), (2, 4), 512


def length_check(headline: Column, summary: Column) -> tuple[Column, Column]:
    """Whether both are within their lengths, and why not; nulls count as empty."""
    w, s = word_count(F.coalesce(headline, F.lit(""))), sentence_count(F.coalesce(summary, F.lit("")))
    good_w, good_s = w.between(*HEADLINE), s.between(*SUMMARY)
    said = lambda what, n, unit, low, high: F.concat(F.lit(f"{what} "), n.cast("string"), F.lit(f" {unit}, want {low}-{high}"))
    reason = F.when(~good_w, said("headline", w, "words", *HEADLINE)).when(~good_s, said("summary", s, "sentences", *SUMMARY))
    return good_w & good_s, reason


def sentence_budget(text: Column, budget: int = BUDGET) -> Column:
    """How many sentences fit the word budget; null for texts within it or of at most two sentences."""


    def fits(parts: Column) -> Column:
        total = F.aggregate(F.transform(parts, word_count), F.lit(0), lambda s, n: s + n)
        return F.when(F.size(parts) > 2, F.greatest(F.lit(1), F.floor(budget / F.greatest(total / F.size(parts), F.lit(1.0)))).cast("int"))

    return F.when(word_count(text) > budget, let(sentences(text), fits))


def sentence_words(sentence: Column, *, stemmed: bool = True, stop: tuple[str, ...] = STOP_WORDS) -> Column:
    """The distinct words of a sentence, runs of letters and digits in lower case; ``stemmed`` without those of ``stop``, as Spanish stems."""
    found = F.regexp_extract_all(F.lower(sentence), F.lit(r"[\p{L}\p{N}]+"), 0)
    return F.array_distinct(F.transform(F.filter(found, lambda w: ~w.isin(*stop)), stem) if stemmed else found)


def rank_sentences(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = 15, damping: float = 0.85, stemmed: bool = True, stop: tuple[str, ...] = STOP_WORDS) -> DataFrame:
    """id, pos, sentence, rank weight: a walk over the sentences of a document that share words, or stems of words.

    The walk goes from a sentence to a word of it and on to a sentence with that word, which
    is the same as weighing pairs of sentences by common words but never makes the pairs.
    """
    s = docs.select(F.col(id_col).alias("id"), F.posexplode(sentences(F.col(text_col))).alias("pos", "sentence"))
    w = s.select("id", "pos", F.explode(sentence_words(F.col("sentence"), stemmed=stemmed, stop=stop)).alias("word"))
    deg_w = w.groupBy("id", "word").agg(F.count("*").alias("in_word"))
    deg_s = w.groupBy("id", "pos").agg(F.count("*").alias("in_sentence"))
    links = w.join(deg_w, ["id", "word"]).join(deg_s, ["id", "pos"])
    # Everything below is per document: a dozen small vectors, walked inside its group.
    per = links.groupBy("id").agg(F.collect_list(F.struct("pos", "word", "in_word", "in_sentence")).alias("links"))
    walked = F.pandas_udf(_walk(rounds, damping), "array<struct<pos:int,weight:double>>")
    weights = per.select("id", F.explode(walked("links")).alias("r")).select("id", "r.*")
    return s.join(weights, ["id", "pos"], "left").select(F.col("id").alias(id_col), "pos", "sentence", F.coalesce("weight", F.lit(0.0)).alias("weight"))


def _walk(rounds: int, damping: float):
    def walk(column):
        import numpy as np
        import pandas as pd

        out = []
        for links in column:
            pos, at = np.unique([x["pos"] for x in links], return_inverse=True)
            _, word = np.unique([x["word"] for x in links], return_inverse=True)
            to_word = 1.0 / np.array([x["in_sentence"] for x in links])
            to_pos = 1.0 / np.array([x["in_word"] for x in links])
            rank = np.full(pos.size, 1.0 / pos.size)
            for _ in range(rounds):
                held = np.bincount(word, weights=rank[at] * to_word)
                rank = (1 - damping) / pos.size + damping * np.bincount(at, weights=held[word] * to_pos, minlength=pos.size)
            out.append([{"pos": int(p), "weight": float(r)} for p, r in zip(pos, rank)])
        return pd.Series(out)

    import pandas as pd

    walk.__annotations__ = {"column": pd.Series, "return": pd.Series}
    return walk


def reduced(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", budget: int = BUDGET) -> DataFrame:
    """``id_col`` and the text, over budget only its best sentences in their order, joined by blanks."""
    sized = docs.select(F.col(id_col), F.col(text_col), sentence_budget(F.col(text_col), budget).alias("n"))
    long = sized.where("n is not null")
    ranked = rank_sentences(long, id_col=id_col, text_col=text_col).join(long.select(id_col, "n"), id_col)
    best = F.row_number().over(Window.partitionBy(id_col).orderBy(F.desc("weight"), "pos"))
    kept = ranked.withColumn("best", best).where("best <= n").groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", "sentence"))).alias("s"))
    short = F.array_join(F.transform("s", lambda x: F.concat(F.rtrim(x["sentence"]), F.when(x["sentence"].rlike(r"[.!?]\s*$"), "").otherwise("."))), " ")
    return sized.join(kept, id_col, "left").select(id_col, F.coalesce(F.nullif(short, F.lit("")), text_col).alias(text_col))


def chunks(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = CHUNK) -> DataFrame:
    """id, chunk_no, text: runs of ``size`` words joined by blanks."""
    w = words(F.col(text_col))
    parts = let(w, lambda w: F.transform(F.sequence(F.lit(0), F.floor((F.size(w) - 1) / size).cast("int")), lambda k: F.array_join(F.slice(w, k * size + 1, F.lit(size)), " ")))
    return docs.where(F.size(w) > 0).select(F.col(id_col), F.posexplode(parts).alias("chunk_no", "text")).withColumn("chunk_no", F.col("chunk_no").cast("long"))


@dataclass(frozen=True)
class Profile:
    """What a kind of summary reads, returns and must satisfy."""

    name: str
    outputs: tuple[str, ...]
    reducible: str
    check: Callable[[Column, Column], tuple[Column, Column]] | None = None
    retry_suffix: str = ""


PROFILES = {
    p.name: p
    for p in (
        Profile("article", ("headline", "summary"), "text", length_check, "\nHeadline of 8 to 15 words, summary of 2 to 4 sentences."),
        Profile("entity_desc", ("description",), "evidence_text"),
        Profile("relation_desc", ("description",), "evidence_text"),
        Profile("aggregate", ("description",), "evidence_text"),
    )
}


def profile(name: str) -> Profile:
    if name not in PROFILES:
        raise ValueError(f"unknown profile {name!r}")
    return PROFILES[name]


def prepared_fields(rows: DataFrame, label: str = "Subtipo") -> DataFrame:
    """Adds evidence_text and descriptions_text (from arrays, where there are any) and subtype_line."""
    out = rows
    if "evidence" in rows.columns:
        out = out.withColumn("evidence_text", numbered(F.col("evidence")))
    if "descriptions" in rows.columns:
        out = out.withColumn("descriptions_text", bullets(F.col("descriptions")))
    return out.withColumn("subtype_line", labelled_line(label, F.col("subtype")) if "subtype" in rows.columns else F.lit(""))


def summarize(rows: DataFrame, kind: str, generate: Callable[[DataFrame], DataFrame], id_col: str = "id") -> DataFrame:
    """id, the profile's outputs, ``status`` (ok, error) and ``reason``, for rows of (id, prompt).

    ``generate`` returns id and ``result``, a struct of the outputs, null where it failed.
    What fails the check is asked once more with the tightened prompt; that answer stands.
    """
    from ..shared import written

    p = profile(kind)
    first = written(generate(rows), "generated")
    if p.check:
        ok, _ = p.check(*(F.col(f"result.{c}") for c in p.outputs))
        judged = first.withColumn("ok", F.col("result").isNull() | ok)
        again = rows.join(judged.where("not ok").select(id_col), id_col, "left_semi").withColumn("prompt", F.concat("prompt", F.lit(p.retry_suffix)))
        second = written(generate(again), "generated").select(id_col, F.col("result").alias("second"))
        first = judged.join(second, id_col, "left").select(id_col, F.when(F.col("ok"), F.col("result")).otherwise(F.coalesce("second", "result")).alias("result"))
    status = F.when(F.col("result").isNull(), "error").otherwise("ok")
    return first.select(id_col, *(F.col(f"result.{c}").alias(c) for c in p.outputs), status.alias("status"), F.when(F.col("result").isNull(), "generation failed").alias("reason"))




def rendered(rows: DataFrame, template: str, id_col: str = "id") -> DataFrame:
    """id, ``prompt`` and ``reason``: the template with its ``{field}`` marks filled from columns, ``{{`` and ``}}`` for braces.

    A field that is no column or null leaves the prompt null and its name in ``reason``.
    """
    from string import Formatter

    parts, names = [], []
    for text, field, _, _ in Formatter().parse(template):
        parts.append(F.lit(text))
        if field is not None:
            names.append(field)
            parts.append(F.col(field).cast("string") if field in rows.columns else F.lit(None).cast("string"))
    lacks = F.array_compact(F.array(F.lit(None).cast("string"), *(F.when(F.col(n).isNull(), n) if n in rows.columns else F.lit(n) for n in dict.fromkeys(names))))
    reason = F.when(F.size(lacks) > 0, F.concat(F.lit("missing field: "), F.array_join(lacks, ", ")))
    return rows.select(id_col, F.concat(*parts).alias("prompt"), reason.alias("reason"))


def summarize_fields(rows: DataFrame, kind: str, template: str, generate: Callable[[DataFrame], DataFrame], *, id_col: str = "id") -> DataFrame:
    """``summarize`` from the fields: long text reduced, lists joined, the prompt rendered; a missing field is an error row, which the model is not asked."""
    p = profile(kind)
    fields = prepared_fields(rows)
    if p.reducible in fields.columns:
        short = reduced(fields.select(id_col, p.reducible), id_col=id_col, text_col=p.reducible)
        fields = fields.drop(p.reducible).join(short, id_col, "left")
    prompts = rendered(fields, template, id_col)
    good = summarize(prompts.where("reason is null").select(id_col, "prompt"), kind, generate, id_col)
    bad = prompts.where("reason is not null").select(id_col, *(F.lit(None).cast("string").alias(c) for c in p.outputs), F.lit("error").alias("status"), "reason")
    return good.unionByName(bad)
