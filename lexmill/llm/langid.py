"""Language identification with error-correcting output codes.

Every language gets a codeword of +1 and -1. For each bit a binary classifier, the
log-ratio of two pooled distributions of hashed letter n-grams (one to three letters),
says on which side a text lies; its margin is set to about +1 and -1 by what the
learned languages themselves would get. Decoding sums over the bits a logistic loss
weighted by how far the bit parts its languages, and takes the codeword of least loss.
Texts whose two best codewords are near each other are flagged.

The n-gram counts come from every labelled row that is not held out, summed per
language on the executors; what reaches the driver is languages x ``BUCKETS`` numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table

BUCKETS = 1 << 13
#: More distinct labels than this are refused: the model is languages x BUCKETS numbers.
MOST_LANGUAGES = 500
SHARPNESS, SMOOTHING, AMBIGUOUS = 4.0, 0.5, 0.2


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """For each code point: itself where it is a letter, else a blank."""
    return np.array([c if chr(c).isalpha() else 32 for c in range(0x110000)], dtype=np.uint32)


def ngrams(text: str) -> np.ndarray:
    """Counts of the hashed one-, two- and three-letter sequences that hold a letter."""
    x = letters()[np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)]
    x = np.concatenate([[np.uint32(32)], x, [np.uint32(32)]]).astype(np.uint32)
    real = (x != 32) | np.append(False, x[:-1] != 32)  # a run of blanks counts as one
    x = x[real]
    one = x[x != 32]
    two = x[:-1] * np.uint32(0x9E3779B1) + x[1:] * np.uint32(0x85EBCA6B)
    three = two[:-1] * np.uint32(0xC2B2AE35) + x[2:] * np.uint32(0x27D4EB2F) + np.uint32(1)
    h = np.concatenate([one * np.uint32(0x165667B1), two, three])
    return np.bincount((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(19), minlength=BUCKETS)


def codewords(n: int) -> np.ndarray:
    """n codewords of +1 and -1: all splits of up to six languages, else the best of some seeded random codes."""
    if n <= 6:
        splits = [(1, *rest) for rest in product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(splits, dtype=np.float64).T.reshape(n, len(splits))
    bits = 10 * int(np.ceil(np.log2(n)))
    best, apart = None, -1
    for seed in range(30):
        code = np.random.default_rng(seed).choice((-1.0, 1.0), size=(n, bits))
        if np.abs(code.sum(axis=0)).max() == n:
            continue
        distance = (bits - code @ code.T) / 2
        if (d := (distance + bits * np.eye(n)).min()) > apart:
            best, apart = code, d
    return best


class Model:
    """Codewords, one linear classifier per bit, and how much each bit counts."""

    def __init__(self, names: list[str], counts: np.ndarray):
        self.names = names
        self.code = codewords(len(names)) if names else np.zeros((0, 0))
        n, bits = self.code.shape
        if not bits:
            return
        share = counts + SMOOTHING
        share = share / share.sum(axis=1, keepdims=True)
        side = lambda s: np.stack([share[self.code[:, b] == s].mean(axis=0) for b in range(bits)])
        self.weights = (np.log(side(1)) - np.log(side(-1))).T
        own = share @ self.weights
        low = np.where(self.code > 0, own, np.inf).min(axis=0)
        high = np.where(self.code < 0, own, -np.inf).max(axis=0)
        self.middle, self.gap = (low + high) / 2, np.maximum((low - high) / 2, 1e-6)
        self.trust = self.gap / self.gap.mean()

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        out: list[tuple[str, float, bool]] = [("und", 0.0, False)] * len(texts)
        live = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if self.names else []
        if not live:
            return out
        if not self.code.shape[1]:
            return [(self.names[0], 1.0, False) if i in {*live} else o for i, o in enumerate(out)]
        grams = np.stack([ngrams(texts[i]).astype(np.float32) for i in live])
        total = grams.sum(axis=1, keepdims=True)
        margin = (grams @ self.weights.astype(np.float32) / total - self.middle) / self.gap
        sure = SHARPNESS * np.minimum(1, np.sqrt(total / 60))
        loss = np.stack([(self.trust * np.logaddexp(0, -sure * margin * word)).sum(axis=1) for word in self.code], axis=1)
        like = np.exp(loss.min(axis=1, keepdims=True) - loss)
        like /= like.sum(axis=1, keepdims=True)
        ranked = np.sort(like, axis=1)
        for i, row, top in zip(live, like, ranked):
            k = int(row.argmax())
            out[i] = (self.names[k], float(row[k]), bool(top[-1] - top[-2] < AMBIGUOUS))
        return out


def held_out(id_col: str) -> Column:
    """Whether crc32 of the id as text leaves 2 on division by 4; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts of every row with a text and a label, summed per language; no rows give a model that says ``und``."""
    small_batches(labelled.sparkSession, rows=500)
    source = labelled.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                got = ngrams(text)
                if lang in sums:
                    sums[lang] += got
                else:
                    sums[lang] = got
        for lang, row in sums.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * at.size, pa.string()), pa.array(at, pa.int32()), pa.array(row[at], pa.int64())], ["lang", "bucket", "n"])

    rows = source.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = rows.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts")).limit(MOST_LANGUAGES + 1).toArrow().sort_by("lang")  # two numbers a bucket, as flat arrays
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.zeros((len(rows), BUCKETS))
    for k, cells in enumerate(x.values for x in rows["counts"]):
        counts[k, cells.field("bucket").to_numpy()] = cells.field("n").to_numpy()
    return Model(rows["lang"].to_pylist(), counts)


def predict_language(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` of every row.

    A null text, or one without a letter, is ``und`` with score 0. Repeated rows stay,
    other columns are ignored. The model travels with the task: languages' bits x BUCKETS numbers.
    """
    small_batches(docs.sparkSession, rows=500)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = shared.value.predict
        for batch in batches:
            found = predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array([x[i] for x in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.bool_())))], ["key", "lang_pred", "score", "ambiguous"])

    return source.mapInArrow(run, f"key {source.schema['key'].dataType.simpleString()}, lang_pred string, score double, ambiguous boolean").withColumnRenamed("key", id_col)


def op4_output_code_language(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """The language of every text of ``documents``, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    model = learn(docs.where(~held_out("doc_id")))
    found = predict_language(docs, model)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "ambiguous")
