"""Gates and choices over tables of scores (doc, pos, hypothesis, score), whatever gave the scores."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shared import written


def short_circuit(scores: DataFrame, threshold: float, *, blacklist: bool = False, doc: str = "doc_id", pos: str = "pos") -> DataFrame:
    """The hypotheses that are asked until one decides, that one included.

    A conjunction stops at the first score below the threshold, a blacklist at the first that reaches it.
    """
    stop = F.col("score") >= threshold if blacklist else F.col("score") < threshold
    before = Window.partitionBy(doc).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    return scores.withColumn("stops", F.coalesce(F.sum(stop.cast("int")).over(before), F.lit(0))).where("stops = 0").drop("stops")


def in_scope(scores: DataFrame, white: float, black: float, doc: str = "doc_id") -> DataFrame:
    """doc and in_scope: any whitelisted score reaches ``white`` and no blacklisted one ``black``. ``kind`` is white or black."""
    reached = lambda kind, t: F.coalesce(F.bool_or((F.col("kind") == kind) & (F.col("score") >= t)), F.lit(False))
    return scores.groupBy(doc).agg((reached("white", white) & ~reached("black", black)).alias("in_scope"))


def top_labels(scores: DataFrame, threshold: float = 0.5, k: int = 3, doc: str = "doc_id") -> DataFrame:
    """Of each document the ``k`` best labels that reach the threshold, ties by position; ``rank`` from 1."""
    rank = F.row_number().over(Window.partitionBy(doc).orderBy(F.desc("score"), "pos"))
    return scores.where(F.col("score") >= threshold).withColumn("rank", rank).where(F.col("rank") <= k)


def best_label(scores: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The label of the highest score, the first of equals."""
    top = F.max_by(F.struct("hypothesis", "score"), F.struct("score", -F.col("pos"))).alias("top")
    return scores.groupBy(doc).agg(top).select(doc, F.col("top.hypothesis").alias("label"), F.col("top.score").alias("score"))


def scope_of(best: Column, score: Column, has_city: Column, has_region: Column, threshold: float = 0.35) -> Column:
    """The best level if its score reaches the threshold, else what the places say: city, regional or national."""
    places = F.when(has_city, "city").when(has_region, "regional").otherwise("national")
    return F.when(score >= threshold, best).otherwise(places)


def softmax(scores: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Logits to shares over a document's labels, for labels that exclude one another."""
    every = Window.partitionBy(doc)
    raised = F.exp(F.col("score") - F.max("score").over(every))
    return scores.withColumn("raised", raised).withColumn("score", F.col("raised") / F.sum("raised").over(every)).drop("raised")


def sorted_labels(scores: DataFrame, doc: str = "doc_id") -> DataFrame:
    """doc, ``labels`` and ``scores``: all labels of a document by falling score, ties by position."""
    rows = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "pos", "hypothesis", "score")))
    part = lambda c: F.transform("rows", lambda x: x[c])
    return scores.groupBy(doc).agg(rows.alias("rows")).select(doc, part("hypothesis").alias("labels"), part("score").alias("scores"))


def asked_in_turn(docs: DataFrame, hypotheses: list[str], score: Callable[[DataFrame, list[str]], DataFrame], threshold: float, *, blacklist: bool = False, doc: str = "doc_id") -> DataFrame:
    """(doc, pos, hypothesis, score) of the hypotheses a model is asked until one decides.

    ``score`` gives (doc, pos, hypothesis, score) for texts and hypotheses, as ``adapters.scores``
    does. One hypothesis is asked at a time, and only of documents that none has decided, so the
    model is called no more than need be; there are as many rounds as hypotheses.
    """
    left, rounds = docs, []
    for k, hypothesis in enumerate(hypotheses):
        got = written(score(left, [hypothesis]).withColumn("pos", F.lit(k)), "asked")
        rounds.append(got.select(doc, "pos", "hypothesis", "score"))
        go = F.col("score") < threshold if blacklist else F.col("score") >= threshold
        left = left.join(got.where(go).select(doc), doc, "left_semi")
    return reduce(DataFrame.unionByName, rounds)


def nli(docs: DataFrame, hypotheses: list[str], score: Callable[[DataFrame, list[str]], DataFrame], *, threshold: float | None = None, blacklist: bool = False, exclusive: bool = False, doc: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Scores (doc, pos, hypothesis, score) of the hypotheses that were asked, and doc, labels and scores by falling score.

    Without a ``threshold`` all are asked at once; with one they are asked in turn until one
    decides. ``exclusive`` scores are logits of labels that exclude one another.
    """
    if threshold is None:
        got = written(score(docs, hypotheses).select(doc, "pos", "hypothesis", "score"), "scores")
    else:
        got = written(asked_in_turn(docs, hypotheses, score, threshold, blacklist=blacklist, doc=doc), "scores")
    got = softmax(got, doc) if exclusive else got
    return got, sorted_labels(got, doc)


def scorecard(found: DataFrame, *, keys: tuple[str, ...], case: str = "case_id") -> DataFrame:
    """Per case: expected, matched, false positives and whether it passes; ``expected`` and ``got`` are flags of each row."""
    both = F.col("expected") & F.col("got")
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    out = found.groupBy(case, *keys).agg(count(F.col("expected")).alias("n_expected"), count(both).alias("n_matched"), count(F.col("got") & ~F.col("expected")).alias("n_false"))
    return out.withColumn("passes", (F.col("n_expected") == F.col("n_matched")) & ((F.col("n_expected") > 0) | (F.col("n_false") == 0)))
