"""Deterministic shards in the order of a key, written by tasks and committed with a manifest.

Rows are dealt to shards by a histogram: the range of a whole-number key is cut into equal
cells, each cell's weight is summed, and cells are joined to shards of about the same
weight. The same rows give the same shards whatever the cluster looks like. A cell that is
heavier than a shard is cut again, by itself, as often as needed, down to single keys. A
single key that is heavier, null among them, is cut by a hash of its rows, the ``tie``;
rows of one key are in the order of their ties. Only rows equal in key and tie stay together.

A task writes each file under a temporary name of its own and reports (temporary name,
final name, size, digest). Spark keeps one report per shard in a manifest table; only what
it lists is renamed, and renaming again does nothing. Files of lost tasks are never listed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 4096
TIES = 1 << 31
#: The place of null keys, before all others; a key of this value is taken for null.
NULL = -(1 << 63)
MOST_TASKS = 100_000
#: More shards than this are refused; their bounds are what the driver holds.
MOST_SHARDS = 1_000_000


def store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class Shards:
    """Lower bounds (key, tie) of the shards, null keys before all; ``bases`` are the weights before each."""

    def __init__(self, bounds: list[tuple[int, int]], bases: list[int]):
        self.bounds, self.bases = bounds, bases

    def of(self, key: Column, tie: Column) -> Column:
        """The shard of a key and tie, by binary search."""
        return bisected(F.coalesce(key.cast("long"), F.lit(NULL)), tie, self.bounds)

    def dealt(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a column ``shard``, a shard to a task."""
        return rows.repartitionById(max(1, len(self.bounds)), F.col("shard"))


def tie_of(*columns: str) -> Column:
    """A number below ``TIES`` by which the rows of one key are ordered and cut."""
    return F.pmod(F.xxhash64(*columns), F.lit(TIES))


def bisected(key: Column, tie: Column, bounds: list[tuple[int, int]]) -> Column:
    """How many of the sorted bounds after the first are at most (``key``, ``tie``)."""

    @F.arrow_udf("int")
    def find(keys: pa.Array, ties: pa.Array) -> pa.Array:
        low, cuts = np.array(bounds, dtype=np.int64).reshape(-1, 2).T
        k, t = (x.to_numpy(zero_copy_only=False) for x in (keys, ties))
        first, last = np.searchsorted(low, k, side="left"), np.searchsorted(low, k, side="right")
        at = last - 1
        for one in np.unique(k[first < last]):  # keys that are bounds themselves
            rows = k == one
            a, b = first[rows][0], last[rows][0]
            at[rows] = a - 1 + np.searchsorted(cuts[a:b], t[rows], side="right")
        return pa.array(at.clip(0).astype("int32"))

    return find(key, tie)


def part_of(key: Column, tie: Column, heavy: list[tuple[int, int]]) -> Column:
    """Of sorted (key, width of a part) the number of the one with this key times ``TIES``, plus the part of ``tie``; -1 where none has it."""

    @F.arrow_udf("long")
    def find(keys: pa.Array, ties: pa.Array) -> pa.Array:
        own, width = np.array(heavy, dtype=np.int64).T
        k, t = (x.to_numpy(zero_copy_only=False) for x in (keys, ties))
        at = np.searchsorted(own, k).clip(0, own.size - 1)
        return pa.array(np.where(own[at] == k, at * TIES + t // width[at], -1))

    return find(key, tie)


def cell_of(key: Column, ranges: list[tuple[int, int, int]]) -> Column:
    """Of sorted ranges (low, high, width of a cell) the number of the one that holds ``key`` times ``CELLS``, plus that of its cell; -1 where none holds it."""

    @F.arrow_udf("long")
    def find(keys: pa.Array) -> pa.Array:
        low, high, width = (np.array(x, dtype=np.int64) for x in zip(*ranges))
        k = keys.to_numpy(zero_copy_only=False)
        at = (np.searchsorted(low, k, side="right") - 1).clip(0)
        # As unsigned numbers the difference of two keys never overflows.
        cell = (k.view(np.uint64) - low[at].view(np.uint64)) // width[at].view(np.uint64)
        return pa.array(np.where((k >= low[at]) & (k <= high[at]), at * CELLS + cell.astype(np.int64), -1))

    return find(key)


def shards_by_weight(rows: DataFrame, key: str, weight: str, per_shard: int, tie: Column) -> Shards:
    """Shards of about ``per_shard`` of weight in the order of a whole-number key and ``tie_of`` its rows. No rows, one shard.

    All cells that are too heavy are cut again in one job; those jobs are at most 64 / 4, and one for single keys.
    """
    rows = rows.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL)).alias("k"), F.col(weight).alias("w"), tie.alias("tie"))
    real = F.when(F.col("k") > NULL, F.col("k"))
    low, high, nulls = rows.agg(F.min(real), F.max(real), F.sum(F.when(F.col("k") == NULL, F.col("w")))).first()
    cells: list[tuple[int, int, int]] = []  # lower bound, its tie, and weight
    single: list[tuple[int, int]] = []  # key and width of its parts

    def alone(k: int, w: int) -> None:
        if w > 2 * per_shard:
            single.append((k, -(-TIES // min(TIES, 4 * -(-w // per_shard)))))
        else:
            cells.append((k, 0, w))

    alone(NULL, nulls or 0)
    todo = [] if low is None else [(low, high, max(1, -(-(high - low + 1) // CELLS)))]
    while todo:
        heavier = []
        found = rows.where(F.col("k") > NULL).groupBy(cell_of(F.col("k"), todo).alias("cell")).agg(F.sum("w").alias("w")).where("cell >= 0").collect()
        for r in sorted(found):
            low, high, width = todo[r["cell"] // CELLS]
            a = low + r["cell"] % CELLS * width
            if r["w"] > 2 * per_shard and width > 1:
                parts = min(CELLS, 16 * -(-r["w"] // per_shard))  # so cells come to the driver in proportion to shards
                heavier.append((a, min(high, a + width - 1), -(-width // parts)))
            elif width == 1:
                alone(a, r["w"])
            else:
                cells.append((a, 0, r["w"]))
        todo = heavier
    if single:
        single.sort()
        for r in rows.groupBy(part_of(F.col("k"), F.col("tie"), single).alias("part")).agg(F.sum("w").alias("w")).where("part >= 0").collect():
            k, width = single[r["part"] // TIES]
            cells.append((k, r["part"] % TIES * width, r["w"]))
    cells.sort()
    bounds, bases, held, total = [], [], 0, 0
    for low, at, w in cells:
        if not bounds or (held and held + w > per_shard):
            bounds.append((low, at))
            bases.append(total)
            held = 0
        held += w
        total += w
    if len(bounds) > MOST_SHARDS:
        raise ValueError("too many shards; raise per_shard")
    return Shards(bounds, bases)


def files_of(spark, folder: str) -> DataFrame:
    """``file`` of every row of the manifest, a shard's files to a task, several shards' where there are over ``MOST_TASKS``."""
    manifest = spark.read.parquet(f"{folder}/_manifest")
    last = manifest.agg(F.max("shard")).first()[0] or 0
    return manifest.select("shard", "file").repartitionById(min(MOST_TASKS, last + 1), F.col("shard")).select("file")


class TaskFile:
    """A file under a temporary name that becomes ``final`` when the manifest is committed."""

    def __init__(self, folder: str, final: str):
        self.fs, self.path = store(folder)
        self.final, self.temporary = final, f"_temporary/{final}.{uuid.uuid4().hex}"
        self.fs.create_dir(f"{self.path}/_temporary", recursive=True)
        self.out = self.fs.open_output_stream(f"{self.path}/{self.temporary}")
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.out.close()


def commit(spark, folder: str) -> DataFrame:
    """Give the files of the manifest table ``_manifest`` their final names; the manifest."""
    manifest = spark.read.parquet(f"{folder}/_manifest")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = store(folder)
        for batch in batches:
            for temporary, final in zip(batch.column("temporary").to_pylist(), batch.column("file").to_pylist()):
                if fs.get_file_info(f"{path}/{final}").type == pafs.FileType.NotFound:
                    try:
                        fs.move(f"{path}/{temporary}", f"{path}/{final}")
                    except OSError:  # another attempt of this task was first
                        if fs.get_file_info(f"{path}/{final}").type == pafs.FileType.NotFound:
                            raise
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    renamed = manifest.select("temporary", "file").mapInArrow(rename, "n long").agg(F.sum("n")).first()[0] or 0
    fs, path = store(folder)
    with fs.open_output_stream(f"{path}/_COMMITTED.{uuid.uuid4().hex}") as f:
        f.write(f'{{"files": {renamed}}}\n'.encode())
        name = f"{path}/_COMMITTED"
    found = [i.path for i in fs.get_file_info(pafs.FileSelector(path)) if "/_COMMITTED." in i.path]
    fs.move(found[0], name)
    if fs.get_file_info(f"{path}/_temporary").type == pafs.FileType.Directory:
        fs.delete_dir(f"{path}/_temporary")
    return manifest
