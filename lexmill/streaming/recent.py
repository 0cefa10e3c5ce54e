"""The recent window as stream state: each article's newest earlier near copy, while articles come in.

Signatures are dealt by their bands to ``BUCKETS`` keys, so a batch is a few calls with many rows each. A
key's state holds the signatures of its articles that are among the last ``WINDOW`` arrivals it knows
of, in arrays; what falls behind is forgotten with the next rows, and a key that gets no rows for
``HOLD`` of event time forgets all by a timer. So the state is bounded by the window, whatever has gone by.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.window import Window

from ..functions.vector import agreement
from ..operators.similarity import CUT, PERMUTATIONS, hashed_bands, signatures, shingle_sets
from ..shared import shared_folder, written

WINDOW, BANDS, HOLD_MS = 5000, 32, 366 * 24 * 3600 * 1000
#: Keys of the state, and articles of a batch at most, which bound what a call has in hand.
BUCKETS, PER_BATCH = 512, 500_000
FOUND = "id long, seq long, match long, match_seq long"


class RecentBand(StatefulProcessor):
    """The articles of many bands: gives each its newest earlier one of a band of its own that agrees in ``cut`` of the places."""

    def __init__(self, window: int = WINDOW, cut: float = CUT, hold_ms: int = HOLD_MS):
        self.window, self.cut, self.hold_ms = window, cut, hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("recent", "bands binary, seqs binary, ids binary, signatures binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = list(rows)  # what one batch has for these bands
        fresh = b"".join(x for p in parts for x in p["sign"])
        new = pd.concat([p[["band", "seq", "id", "ms"]] for p in parts])
        old = self.state.get() if self.state.exists() else (b"",) * 4
        bands, seqs, ids = (np.append(np.frombuffer(b, dtype=np.int64), new[c].to_numpy(np.int64)) for b, c in zip(old, ("band", "seq", "id")))
        signs = np.frombuffer(bytes(old[3]) + fresh, dtype=np.int32).reshape(seqs.size, -1)
        before = seqs.size - len(new)
        order = np.lexsort((-ids, seqs, bands))  # so that a walk back meets the newest first, the least id of equals
        starts = np.flatnonzero(np.append(True, bands[order][1:] != bands[order][:-1]))
        ends = np.append(starts[1:], seqs.size)
        out = []
        for start, end in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            own = order[start:end]
            if own.max() >= before:
                out += self.walked(own, seqs[own], ids, signs, own >= before)
        live = np.flatnonzero(seqs >= seqs.max() - self.window)
        self.state.update((bands[live].tobytes(), seqs[live].tobytes(), ids[live].tobytes(), signs[live].tobytes()))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer if isinstance(timer, int) else timer[0])
        self.handle.registerTimer(int(new["ms"].max()) + self.hold_ms)
        yield pd.DataFrame(out, columns=["id", "seq", "match", "match_seq"]).astype("int64")

    def walked(self, own: np.ndarray, seqs: np.ndarray, ids: np.ndarray, signs: np.ndarray, is_new: np.ndarray) -> list[tuple]:
        """The matches of one band's new rows; ``own`` are the places of its rows, oldest first."""
        low, high, out = np.searchsorted(seqs, seqs - self.window), np.searchsorted(seqs, seqs), []
        for at in np.flatnonzero(is_new):
            for end in range(high[at], low[at], -64):
                start = max(end - 64, low[at])
                good = np.flatnonzero((signs[own[start:end]] == signs[own[at]]).mean(axis=1) >= self.cut)
                if good.size:
                    out.append((ids[own[at]], seqs[at], ids[own[start + good[-1]]], seqs[start + good[-1]]))
                    break
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        yield pd.DataFrame({c: pd.Series(dtype="int64") for c in ("id", "seq", "match", "match_seq")})

    def close(self) -> None:
        pass


def packed(signatures: Column) -> Column:
    """Signatures as bytes; their hashes are below 2^31."""

    @F.arrow_udf("binary")
    def pack(signs: pa.Array) -> pa.Array:
        ends = signs.offsets.to_numpy()
        flat = signs.values.to_numpy(zero_copy_only=False).astype(np.int32)
        return pa.array([flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])], pa.binary())

    return pack(signatures)


def matches(signed: DataFrame, folder: str, *, window: int = WINDOW, cut: float = CUT, bands: int = BANDS, hold_ms: int = HOLD_MS) -> DataFrame:
    """id, seq, match, match_seq, written below ``folder`` while the stream ``signed`` (id, seq, ts, signature) is read to its end.

    ``seq`` is the order of arrival: a row is compared with rows of the ``window`` numbers before
    its own. Rows without a signature match nothing.
    """
    spark = signed.sparkSession
    timed = signed.withColumns({"ms": F.unix_millis("ts"), "sign": packed(F.col("signature"))}).withWatermark("ts", "0 seconds")
    keyed = hashed_bands(timed, bands).select(F.pmod("band", F.lit(BUCKETS)).cast("int").alias("bucket"), "band", "seq", "id", "ts", "ms", "sign")
    found = keyed.groupBy("bucket").transformWithStateInPandas(RecentBand(window, cut, hold_ms), FOUND, "Append", "EventTime")
    with_rocks = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
    before = {k: spark.conf.get(k, None) for k in with_rocks}
    for k, v in with_rocks.items():
        spark.conf.set(k, v)
    try:
        found.writeStream.format("parquet").option("path", f"{folder}/rows").option("checkpointLocation", f"{folder}/_checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    # An article may match in several bands: the newest counts, the least id of equals.
    rows = spark.read.schema(FOUND).parquet(f"{folder}/rows")
    return rows.groupBy("id", "seq").agg(F.max(F.struct("match_seq", (-F.col("match")).alias("m"))).alias("b")).select("id", "seq", (-F.col("b.m")).alias("match"), F.col("b.match_seq").alias("match_seq"))


def previous_match(signed: DataFrame, *, window: int = WINDOW, cut: float = CUT, bands: int = BANDS) -> DataFrame:
    """The same of a table (id, seq, signature), without a stream."""
    key = hashed_bands(signed, bands)
    # A row meets its band's rows of its own stretch of numbers and of the one before.
    stretch = F.floor(F.col("seq") / window)
    new = key.select("band", stretch.alias("at"), "id", "seq", "signature")
    old = key.select("band", F.explode(F.array(stretch, stretch + 1)).alias("at"), F.col("id").alias("match"), F.col("seq").alias("match_seq"), F.col("signature").alias("other"))
    met = new.join(old, ["band", "at"]).where((F.col("match_seq") < F.col("seq")) & (F.col("match_seq") >= F.col("seq") - window)).where(agreement(F.col("signature"), F.col("other")) >= cut)
    best = F.row_number().over(Window.partitionBy("id", "seq").orderBy(F.desc("match_seq"), "match"))
    return met.withColumn("rank", best).where("rank = 1").select("id", "seq", "match", "match_seq")


def arrivals(rows: DataFrame, folder: str, batches: int) -> DataFrame:
    """A stream of ``rows`` (with ``seq``) that come in so many batches, each a stretch of ``seq``, one after the other."""
    low, high = rows.agg(F.min("seq"), F.max("seq")).first()
    part = F.least(F.floor((F.col("seq") - F.lit(low or 0)) * batches / F.lit((high or 0) - (low or 0) + 1)), F.lit(batches - 1))
    files = -(-rows.rdd.getNumPartitions() // batches)
    for k in range(batches):
        rows.where(part == k).repartition(files).write.parquet(f"{folder}/arrivals/{k:05d}")
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/arrivals/*")


def recent_matches(spark: SparkSession, sf_dir: str, *, window: int = WINDOW, batches: int = 3) -> DataFrame:
    """``documents`` streamed in the order of their ids: each with its newest earlier near copy."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    signed = signatures(shingle_sets(docs, id_col="doc_id")).where(F.size("signature") == PERMUTATIONS)
    folder = shared_folder(spark, "recent")
    timed = signed.select("id", F.col("id").alias("seq"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("ts"), "signature")
    rows = written(timed, "signed")
    return matches(arrivals(rows, folder, max(batches, -(-rows.count() // PER_BATCH))), folder, window=window)
