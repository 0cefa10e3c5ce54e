"""Mixing sources to target weights along a low-discrepancy schedule.

Documents are shuffled within their source by a seeded digest of their id and laid end to
end; the words of a source so form blocks of ``block`` words. The schedule has 2^k slots.
Slot i takes the i-th van der Corput point, the bit-reversed i, and the source whose
interval of the cumulative weights holds that point. As the points of 2^k slots are exactly
the multiples of 2^-k and each interval is as many of these wide as its source needs
blocks, every source gets exactly its number of slots, evenly spread over the mix; slots
beyond the last interval stay empty. A slot's rank within its source counts the earlier
points in the interval, which has a closed form, and rank modulo the number of blocks is
the block it takes: a source is read anew only when all of it has been taken. The last
round through a source ends at the word where its target is reached.

Sums and offsets go through hash buckets of each source, so a source that holds a third of
all rows is spread over many tasks. Only one row per source reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import cut, table, word_count

#: More sources than this are refused: each is a row of the plan that every task holds.
MOST_SOURCES = 100_000


def targets(sizes: list[int], weights: list[float], most: int) -> list[float]:
    """Shares of the sum of ``sizes`` by ``weights``; none above ``most`` times its size, the excess going to the others by weight."""
    rest, left, out = float(sum(sizes)), float(sum(weights)), [0.0] * len(sizes)
    # Sources fill up in the order of size over weight: what one leaves over only helps to fill the next.
    order = sorted(range(len(sizes)), key=lambda i: sizes[i] / weights[i])
    for k, i in enumerate(order):
        if weights[i] * rest / left <= most * sizes[i]:
            for j in order[k:]:
                out[j] = weights[j] * rest / left
            break
        out[i] = float(most * sizes[i])
        rest, left = rest - out[i], left - weights[i]
    return out


@dataclass(frozen=True)
class Plan:
    """Per source, in the order of the cumulative weights: what there is and what the mix takes."""

    keys: list[str | None]
    sizes: list[int]
    goals: list[float]
    block: int

    def takes(self) -> list[int]:
        return [math.floor(g + 1e-6) for g in self.goals]

    def blocks(self) -> list[int]:
        return [-(-s // self.block) for s in self.sizes]

    def slots(self) -> list[int]:
        return [0 if not s else t // s * b + -(-(t % s) // self.block) for s, t, b in zip(self.sizes, self.takes(), self.blocks())]

    def bits(self) -> int:
        return max(1, (sum(self.slots()) - 1).bit_length()) if sum(self.slots()) else 0


def reverse_bits(x: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros_like(x)
    for b in range(bits):
        out |= (x >> b & 1) << (bits - 1 - b)
    return out


def points_before(slot: np.ndarray, bound: np.ndarray, bits: int) -> np.ndarray:
    """How many slots before ``slot`` have a point below ``bound``.

    The slots before i part into runs: for every bit b of i that is set, those that agree
    with i above b, have 0 there and anything below. Their points are evenly spaced.
    """
    count = np.zeros_like(slot)
    for b in range(bits):
        offset = reverse_bits(slot >> (b + 1) << (b + 1), bits)
        step = 1 << (bits - b)
        inside = np.clip(-((offset - bound) // step), 0, 1 << b)
        count += np.where(slot >> b & 1, inside, 0)
    return count


def schedule(spark, plan: Plan) -> DataFrame:
    """One row per filled slot: slot, source_no, rank, round, block, and the block's words [first_word, end_word) of the source's layout."""
    slots, bits = plan.slots(), plan.bits()
    edges = np.cumsum([0, *slots])
    sizes, blocks, takes, block = np.array([*plan.sizes, 0]), np.array([*plan.blocks(), 1]), np.array([*plan.takes(), 0]), plan.block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column(0).to_numpy()
            point = reverse_bits(slot, bits)
            filled = point < edges[-1]
            slot, point = slot[filled], point[filled]
            no = np.searchsorted(edges, point, side="right") - 1
            rank = points_before(slot, edges[no + 1], bits) - points_before(slot, edges[no], bits)
            turn, at = rank // blocks[no], rank % blocks[no]
            whole = takes[no] // np.maximum(sizes[no], 1)
            end = np.minimum((at + 1) * block, np.where(turn < whole, sizes[no], takes[no] % np.maximum(sizes[no], 1)))
            columns = [slot, no.astype("int32"), rank, turn, at, at * block, end]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["slot", "source_no", "rank", "round", "block", "first_word", "end_word"])

    kind = "slot long, source_no int, rank long, round long, block long, first_word long, end_word long"
    return spark.range(1 << bits if sum(slots) else 0).mapInArrow(run, kind)


def code_point_order(keys: list[str | None]) -> list[str | None]:
    return sorted((k for k in keys if k is not None)) + ([None] if None in keys else [])


def shuffle_key(id_col: Column, text_col: Column, seed: int) -> Column:
    """A row's place in the shuffle: by id and text, so that rows of one id, or of none, are dealt out as well."""
    text = F.coalesce(F.md5(text_col.cast("binary")), F.lit("-"))
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(":"), text).cast("binary"))


def lay_out(docs: DataFrame, *, block: int, seed: int, weights: tuple[float, ...], most: int, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, Plan]:
    """Every document with its place in its source's shuffled word layout, and the plan."""
    spark = docs.sparkSession
    sized = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"), shuffle_key(F.col(id_col), F.col(text_col), seed).alias("order")), "mix-sizes")
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    by = {r["source"]: r for r in rows}
    keys = code_point_order([*by])
    sizes = [by[k]["size"] for k in keys]
    plan = Plan(keys, sizes, targets(sizes, [weights[i % len(weights)] for i in range(len(keys))], most), block)
    digits = min(7, max(3, math.ceil(math.log(max([1, *(r["n"] for r in rows)]) / 2000 + 1, 16))))
    listed = spark.createDataFrame([(k, i, s, g) for i, (k, s, g) in enumerate(zip(keys, sizes, plan.goals))], T.StructType([T.StructField("source", T.StringType()), T.StructField("source_no", T.IntegerType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())]))
    sized = sized.join(F.broadcast(listed.withColumnRenamed("source", "known")), F.col("source").eqNullSafe(F.col("known")), "left").drop("known").withColumn("bucket", F.substring("order", 1, digits))
    buckets = sized.groupBy("source_no", "bucket").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select("source_no", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("source_no", "bucket").orderBy("order", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = sized.join(buckets, ["source_no", "bucket"]).withColumn("end", F.col("base") + F.sum("size").over(within))
    return placed.select("id", "source", "source_no", "source_size", "target", "size", (F.col("end") - F.col("size")).alias("start"), "end"), plan


def mix(docs: DataFrame, *, block: int = 256, seed: int = 17, weights: tuple[float, ...] = (1, 2, 3), most: int = 3, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """The mix, and the placed documents that it is made of.

    Sources are weighed by ``weights`` in code-point order, the null source last. The mix has
    a row per slot and document in it: slot, source_no, round, id, start, size, from_word (in the
    document) and n_words. A source may be taken up to ``most`` times. Null and empty texts have
    no words: they are placed and never taken. Null ids and repeated rows are placed like others;
    equal rows take equal shares of the shuffle's order in some order. No documents, no slots.
    """
    placed, plan = lay_out(docs, block=block, seed=seed, weights=weights, most=most, id_col=id_col, text_col=text_col, source_col=source_col)
    placed = cut(placed, "mix-layout")
    pieces = placed.where("size > 0").select("source_no", "id", "start", "end", "size", F.explode(F.expr(f"sequence(start div {block}, (end - 1) div {block})")).alias("block"))
    taken = schedule(docs.sparkSession, plan).join(pieces, ["source_no", "block"])
    first, last = F.greatest("first_word", "start"), F.least("end_word", "end")
    mixed = taken.where(last > first).select("slot", "source_no", "round", "id", "start", "size", (first - F.col("start")).alias("from_word"), (last - first).alias("n_words"))
    return mixed, placed


def op1_source_mix(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """How many words of each document of ``documents`` the mix takes."""
    mixed, placed = mix(table(spark, sf_dir, "documents") if docs is None else docs)
    sums = mixed.groupBy("source_no", "start").agg(F.sum("n_words").alias("words"))
    # Documents without words share their place with another, and are never taken.
    found = placed.where("size > 0").join(sums, ["source_no", "start"], "left").unionByName(placed.where("size = 0"), allowMissingColumns=True)
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", F.coalesce("words", F.lit(0)).alias("taken"), "source")


#: The same by arithmetic: whole rounds of every document, and the last round up to the word where the target is reached.
ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), '-')) AS k FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM sized GROUP BY source),
filled AS (
  SELECT *, sum(3 * source_size) OVER f AS held, sum(w) OVER f AS weighed,
         sum(source_size) OVER () AS total, sum(w) OVER () AS weights FROM sources
  WINDOW f AS (ORDER BY source_size::DOUBLE / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
scaled AS (
  SELECT max(CASE WHEN full_up THEN held ELSE 0 END) AS held, max(CASE WHEN full_up THEN weighed ELSE 0 END) AS weighed
  FROM (SELECT *, w * (total - (held - 3 * source_size))::DOUBLE / (weights - (weighed - w)) > 3 * source_size AS full_up FROM filled)),
goals AS (
  SELECT f.source, f.source_size,
         CASE WHEN f.held <= s.held AND f.weighed <= s.weighed THEN 3.0 * f.source_size
              ELSE f.w * (f.total - s.held)::DOUBLE / (f.weights - s.weighed) END AS target
  FROM filled f CROSS JOIN scaled s),
placed AS (
  SELECT s.*, g.source_size, g.target, floor(g.target + 1e-6)::BIGINT AS words,
         (sum(size) OVER (PARTITION BY s.source ORDER BY k, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size::BIGINT AS size, source_size, target, source,
       CASE WHEN size = 0 THEN 0 ELSE (words // source_size) * size + greatest(0, least(start + size, words % source_size) - start) END::BIGINT AS taken
FROM placed
"""
