"""The corpus pipeline: stages over the documents, each written and read again by the next."""

from __future__ import annotations

import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.bpe import bpe_decode, bpe_encode
from lexmill.llm.common import WORD, cut, tokenizer_file, word_count
from lexmill.llm.jaccard_join import jaccard_components
from lexmill.llm.line_templates import drop_templates
from lexmill.llm.mixing import mix
from lexmill.llm.repetition import repetition_rules

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Near-duplicate stages take five words and a similarity of 0.8.
SHINGLE, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return repetition_rules(docs, keep=COLUMNS[1:]).where("kept").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates, which the first document of each keeps; one that had words and lost them all goes.

    So the join that follows still finds what near copies share in one of them.
    """
    found = drop_templates(docs, keep_first=True, keep=("lang", "source"))
    left = found.where((F.col("n_dropped") == 0) | (word_count(F.col("text")) > 0))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """``docs`` with ``key``, equal for rows of one id (or none), one text and ``more``; it sorts by id, null ids last."""
    number = F.lpad(F.hex(F.col("doc_id").cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    text = F.coalesce(F.sha1(F.col("text").cast("binary")), F.lit("-"))
    parts = (F.coalesce(F.concat(F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in more)
    return docs.select(*COLUMNS, F.concat(F.coalesce(number, F.lit("~")), text, *parts).alias("key"))


def one_each(rows: DataFrame) -> DataFrame:
    """One row per ``key``."""
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    found = rows.groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.min(F.struct(*rest)).alias("rest"))
    return found.select("key", "doc_id", "text", *(F.col(f"rest.{c}").alias(c) for c in rest))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of links the document with the least id, one without id only where none has one; repeated rows once."""
    docs = keyed(docs)
    kept = jaccard_components(docs, n=SHINGLE, percent=PERCENT, id_col="key").where("key = component_id").select("key").distinct()
    return one_each(docs.hint("merge").join(kept, "key", "left_semi")).select(*COLUMNS)


def first_words(text: str, count: str) -> Column:
    """A text column up to the end of so many words."""

    @F.arrow_udf("string")
    def cut_off(texts: pa.Array, counts: pa.Array) -> pa.Array:
        word, out = re.compile(WORD), []
        for text, n in zip(texts.to_pylist(), counts.to_pylist()):
            ends = (m.end() for k, m in enumerate(word.finditer(text), 1) if k == n)
            out.append(text[: next(ends, len(text))])
        return pa.array(out, pa.string())

    return cut_off(text, count)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document once for every round that takes it, cut where its source's last round ends."""
    docs = keyed(docs, "source")
    mixed, _ = mix(docs, id_col="key")
    taken = mixed.groupBy("id", "start", "round").agg(F.sum("n_words").alias("n_words"), F.min("from_word").alias("from_word"), F.first("size").alias("size"))
    # A round takes documents from their first word on: only its last document is cut, at its end.
    both = one_each(docs).join(taken.withColumnRenamed("id", "key"), "key")
    whole = both.where("n_words = size")
    part = both.where("n_words < size").withColumn("text", first_words("text", "n_words")).withColumn("n_chars", F.length("text").cast("long"))
    return whole.select(*COLUMNS).union(part.select(*COLUMNS))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it again."""
    path = tokenizer_file("byte_bpe_50k.json")
    # Rows of a document differ where the mix cut it, so its text's digest goes with its id.
    key = F.struct("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"))
    encoded = bpe_encode(docs.select(key.alias("key"), "text"), path, id_col="key")
    back = F.sha2(bpe_decode(F.col("ids"), path), 256)
    return encoded.select("key.doc_id", "key.source", F.size("ids").cast("long").alias("n_tokens"), "ids", (back == F.col("key.sha")).alias("round_trip"))


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates), ("mixing sources to target weights", source_mix), ("BPE encoding and decoding", bpe)]
#: Template trees grow line by line and mixing slots have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    (*first, last) = STAGES
    docs = reduce(lambda d, stage: cut(stage[1](spark, d, sf_dir), "stage"), first, docs)
    return last[1](spark, docs, sf_dir)
