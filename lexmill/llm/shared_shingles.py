"""Which documents cannot link because too few of their shingles occur anywhere else.

A link at ``percent`` needs that share of a document's shingles in the other document, so a
document of which fewer occur outside it is out. Every shingle of every document is looked
at once, packed: a task gathers documents to blocks of about ``BLOCK`` shingles, sorts them
by leading bits of their hash, and ships differences, cut into buckets of the hash range. A
shingle that a block holds twice is shared; it leaves the block once, so that a shingle of
millions of documents travels once a block. Buckets count; what they find goes back to the
blocks, which sum up. The leading bits are eight more than it takes to number all shingles:
chance collisions only make a document look as if it could link.

A block is believed only when all its buckets have answered, so a document is never ruled
out on part of the evidence, even where a lost task was run again on rows in another order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import tidy
from .shingles import nodes_of, shingle_sets

#: Shingles and documents of a block at most (a longer document is a block), and shingles of a bucket.
BLOCK, BLOCK_DOCS, BUCKET = 1 << 20, 60_000, 1 << 21
NONE = 0xFFFF
SCHEMA = pa.schema([("bucket", pa.int32()), ("block", pa.string()), ("kind", pa.int32()), ("data", pa.binary())])
SPARK = "bucket int, block string, kind int, data binary"
#: Kinds of rows: a slice of a block, what a bucket found for it, and the block's documents.
SLICE, FOUND, DOCS = 0, 1, 2


def packed(rows: np.ndarray) -> bytes:
    """Numbers as byte planes, compressed."""
    return pa.compress(rows.view(np.uint8).reshape(rows.size, -1).T.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes, kind: str, size: int) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(data, size * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, size).T).view(kind).ravel()


def joined(*parts: bytes) -> bytes:
    """Byte strings behind their sizes."""
    return b"".join([len(p).to_bytes(4, "little") + p for p in parts])


def parted(data: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(data):
        size = int.from_bytes(data[at : at + 4], "little")
        out.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return out


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(SCHEMA)], schema=SCHEMA)


def block_rows(name: str, sets: list[np.ndarray], nodes: np.ndarray, bits: int, buckets: int, percent: int) -> Iterator[tuple]:
    """A block's slices and its documents: node, and how many shared shingles it still lacks to link."""
    sizes = np.array([s.size for s in sets], dtype=np.int64)
    h = np.concatenate(sets) >> np.uint64(64 - bits)
    doc = np.repeat(np.arange(len(sets), dtype=np.uint16), sizes)
    by = np.argsort(h)
    h, doc = h[by], doc[by]
    fresh = np.append(True, h[1:] != h[:-1])
    alone = fresh & np.append(fresh[1:], True)
    lacks = -(-percent * sizes // 100) - np.bincount(doc[~alone], minlength=len(sets))
    h, doc = h[fresh], np.where(alone, doc, np.uint16(NONE))[fresh]
    lows = np.array([(k << bits) // buckets for k in range(buckets)], dtype=np.uint64)
    edges = np.append(np.searchsorted(h, lows), h.size)
    filled = np.flatnonzero(np.diff(edges))
    name = f"{name}:{zlib.crc32(nodes.tobytes()):08x}"
    for k in filled.tolist():
        a, b = edges[k], edges[k + 1]
        steps = np.diff(h[a:b], prepend=lows[k]).astype("<u4")
        yield k, name, SLICE, joined(int(b - a).to_bytes(8, "little"), packed(steps), packed(doc[a:b]))
    yield zlib.crc32(name.encode()) % buckets, name, DOCS, joined(int(filled.size).to_bytes(8, "little"), nodes.astype("<i8").tobytes(), lacks.astype("<i8").tobytes())


def cannot_link(docs: DataFrame, shingles: int, n: int, percent: int) -> DataFrame:
    """``node`` (see ``nodes_of``) of each text of ``docs`` that shares too few of its n-word shingles; ``shingles``: about how many there are in all."""
    bits = min(64, max(24, shingles.bit_length() + 8))
    buckets = max(1, shingles // BUCKET)

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}  # copies within a block are one document
        size, no, part = 0, 0, TaskContext.get().partitionId()

        def block() -> pa.RecordBatch:
            nodes = np.array([*held], dtype=np.int64)
            return batch_of([*block_rows(f"{part}:{no}", [*held.values()], nodes, bits, buckets, percent)])

        for batch in batches:
            sets = shingle_sets(batch.column(0).to_pylist(), n)
            for node, s in zip(nodes_of(sets).tolist(), sets):
                if not s.size or node in held:
                    continue
                if held and (size + s.size > BLOCK or len(held) == BLOCK_DOCS):
                    yield block()
                    held, size, no = {}, 0, no + 1
                held[node] = s
                size += s.size
        if held:
            yield block()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, names, slices = None, [], []

        def found() -> pa.RecordBatch:
            hashes, docs = [], []
            for data in slices:
                size, steps, doc = parted(data)
                size = int.from_bytes(size, "little")
                hashes.append(np.cumsum(unpacked(steps, "<u4", size), dtype=np.uint64))
                docs.append(unpacked(doc, "<u2", size))
            sizes = [x.size for x in docs]
            h, doc, rows = np.concatenate(hashes), np.concatenate(docs), []
            by = np.argsort(h)
            fresh = np.append(True, h[by[1:]] != h[by[:-1]])
            shared = np.empty(h.size, dtype=bool)
            shared[by] = ~(fresh & np.append(fresh[1:], True))
            ends = np.cumsum([0, *sizes])
            for name, a, b in zip(names, ends[:-1], ends[1:]):
                d = doc[a:b][shared[a:b]]
                times = np.bincount(d[d != NONE])
                at = np.flatnonzero(times)
                rows.append((bucket, name, FOUND, joined(at.size.to_bytes(8, "little"), packed(at.astype("<u2")), packed(times[at].astype("<u4"))) if at.size else b""))
            return batch_of(rows)

        for batch in batches:
            through = []
            for k, name, kind, data in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == DOCS:
                    through.append((k, name, kind, data))
                    continue
                if k != bucket and names:
                    yield found()
                    names, slices = [], []
                bucket = k
                names.append(name)
                slices.append(data)
            if through:
                yield batch_of(through)
        if names:
            yield found()

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, answers, docs, sums = None, set(), None, np.zeros(NONE + 1, dtype=np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            if docs is None:
                return
            expected, nodes, lacks = parted(docs)
            if len(answers) == int.from_bytes(expected, "little"):
                nodes, lacks = np.frombuffer(nodes, "<i8"), np.frombuffer(lacks, "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(nodes[sums[: nodes.size] < lacks])], ["node"])

        for batch in batches:
            for k, name, kind, data in zip(*(c.to_pylist() for c in batch.columns)):
                if name != block:
                    yield from out()
                    block, answers, docs = name, set(), None
                    sums[:] = 0
                if kind == DOCS:
                    docs = data
                elif k not in answers:
                    answers.add(k)
                    if data:
                        size, at, times = parted(data)
                        size = int.from_bytes(size, "little")
                        sums[unpacked(at, "<u2", size)] += unpacked(times, "<u4", size)
        yield from out()

    cut = docs.select("text").mapInArrow(tidy(slices), SPARK)
    counted = cut.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(count), SPARK)
    return counted.repartition("block").sortWithinPartitions("block").mapInArrow(tidy(decide), "node long").distinct()
