"""Ranked lexical search by windowed bucket scoring.

``WINDOW`` documents that follow one another in a task make a window, numbered in the order
of their ids: places, not ids, are what postings hold, so ids may be sparse, repeated or
absent. A segment is the inverted file of one window: its terms in order and, for each, the
places in the window that hold it and how often. Only terms that a query may ask for are
kept, told by a bitmap of their hashes, so a segment may hold a few more, never fewer.

Scoring walks the segments. Of a segment the worth of every posting is found once, with one
bitset of places per term. An item then adds the postings of its terms into an array of
``WINDOW`` sums, which stays in the cache; the union of the bitsets says which places were
touched; those that beat the item's heap go into it, and the touched places are cleared.
A task gives the heaps' rows for each item, and a rank over these ends the search.

Segments are written once, so postings are never shuffled, and documents of one id, or of
none, need no common task. Items come to the driver in blocks of at most ``BLOCK`` terms,
each a pass over the segments.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, small_batches, table, tidy

TOP = 50
#: Places of a window: sums of 64 bits for them take 128 KB.
WINDOW = 1 << 14
#: Terms of all items that one pass over the segments serves.
BLOCK = 1 << 16
#: Postings after which a segment ends, full or not.
MOST_POSTINGS = 1 << 21
#: Words that a task remembers, wanted or not.
MOST_WORDS = 1 << 19
BITS = 22
#: Every ASCII character but digits and letters parts terms.
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TO_BLANK = bytes.maketrans(SEPARATORS, b" " * len(SEPARATORS))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order; only A to Z become small."""
    return (text or "").encode("utf-8", "replace").translate(TO_BLANK).lower().split()


def term_hash(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term) >> (64 - BITS)


def query_terms(items: DataFrame, *, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item and the array of its distinct terms; rows of one item are one query, items without a term are left out."""
    source = items.select(F.col(item_col).alias("item"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted({t.decode() for t in terms_of(x)}) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(found, pa.list_(pa.string()))], ["item", "terms"])

    rows = source.mapInArrow(run, f"item {source.schema['item'].dataType.simpleString()}, terms array<string>").select("item", F.explode("terms").alias("term"))
    return rows.groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms"))


def wanted_bits(queries: DataFrame) -> np.ndarray:
    """Which hashes the items' terms have: 2^22 bits, whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << BITS, dtype=bool)
        for batch in batches:
            for terms in batch.column("terms").to_pylist():
                bits[[term_hash(t.encode()) for t in terms]] = True
        pages = np.packbits(bits).reshape(-1, 1 << 12)
        some = np.flatnonzero(pages.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([pages[i].tobytes() for i in some], pa.binary())], ["page", "bits"])

    out = np.zeros((1 << (BITS - 15), 1 << 12), dtype=np.uint8)
    for row in queries.select("terms").mapInArrow(run, "page int, bits binary").toLocalIterator():
        out[row["page"]] |= np.frombuffer(row["bits"], dtype=np.uint8)
    return np.unpackbits(out.reshape(-1)).astype(bool)


class Builder:
    """Gathers documents of a task and gives segments of at most ``window`` of them."""

    def __init__(self, bits: np.ndarray, window: int):
        self.bits, self.window = bits, window
        self.clear()

    def clear(self) -> None:
        self.forget()
        self.terms: dict[bytes, int] = {}  # those wanted, by their number in this segment
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.docs: list[np.ndarray] = []
        self.held = 0

    def forget(self) -> None:
        """Words seen, wanted or not; ``term`` gives their number in the segment, or -1."""
        self.numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.term, self.seen = np.empty(0, dtype=np.int32), 0

    def add(self, doc_id: int | None, text: str | None) -> None:
        """Documents without a term are of no account."""
        if not (words := terms_of(text)):
            return
        if self.seen > MOST_WORDS:
            self.forget()
        got = np.fromiter(map(self.numbers.__getitem__, words), dtype=np.int32, count=len(words))
        if (more := len(self.numbers) - self.seen) > 0:
            fresh = [*islice(reversed(self.numbers), more)][::-1]
            if len(self.numbers) > self.term.size:
                self.term = np.append(self.term, np.empty(len(self.numbers) + self.term.size, dtype=np.int32))
            good = self.bits[[term_hash(w) for w in fresh]].tolist()
            self.term[self.seen : len(self.numbers)] = [self.terms.setdefault(w, len(self.terms)) if g else -1 for w, g in zip(fresh, good)]
            self.seen = len(self.numbers)
        got = self.term[got]
        got = got[got >= 0]
        self.ids.append(doc_id)
        self.sizes.append(len(words))
        self.docs.append(got)
        self.held += got.size

    @property
    def full(self) -> bool:
        return len(self.ids) >= self.window or self.held >= MOST_POSTINGS

    def segment(self) -> dict | None:
        """Ids in order (null last), numbers of terms, and by term (in order) where its postings end, their places and frequencies."""
        if not self.ids:
            return None
        order = sorted(range(len(self.ids)), key=lambda i: (self.ids[i] is None, self.ids[i]))
        names = sorted(self.terms)
        rank = np.empty(len(names), dtype=np.int64)
        rank[[self.terms[w] for w in names]] = np.arange(len(names))
        place = np.repeat(np.arange(len(order)), [self.docs[i].size for i in order])
        flat = np.concatenate([self.docs[i] for i in order])
        both, tf = np.unique(rank[flat] * len(order) + place, return_counts=True)
        ends = np.cumsum(np.bincount(both // len(order), minlength=len(names)))
        out = {"ids": [self.ids[i] for i in order], "sizes": [self.sizes[i] for i in order], "terms": [w.decode() for w in names], "ends": ends.tolist()}
        out |= {"places": (both % len(order)).astype("<u2").tobytes(), "tfs": tf.astype("<u4").tobytes()}
        self.clear()
        return out


SEGMENT = "ids array<long>, sizes array<long>, terms array<string>, ends array<int>, places binary, tfs binary"


def segments(docs: DataFrame, bits: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The inverted files of all windows, one a row."""
    if not 0 < window <= 1 << 16:
        raise ValueError("a window has 1 to 65,536 places")
    small_batches(docs.sparkSession, rows=1000, mb=4)
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits).tobytes())
    kinds = {"ids": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()), "terms": pa.list_(pa.string()), "ends": pa.list_(pa.int32()), "places": pa.binary(), "tfs": pa.binary()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        builder = Builder(np.unpackbits(np.frombuffer(shared.value, dtype=np.uint8)).astype(bool), window)

        def given() -> Iterator[pa.RecordBatch]:
            if (row := builder.segment()) is not None:
                yield pa.RecordBatch.from_arrays([pa.array([row[c]], t) for c, t in kinds.items()], [*kinds])

        for batch in batches:
            for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                builder.add(doc_id, text)
                if builder.full:
                    yield from given()
        yield from given()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(tidy(run), SEGMENT)


def weighted(queries: DataFrame, index: DataFrame) -> tuple[DataFrame, int, int]:
    """item and its (term, weight) pairs, of terms that documents hold; N and L, the number of documents and of their terms."""
    n, total = index.select(F.sum(F.size("ids")), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    n, total = n or 0, total or 0
    held = F.zip_with("terms", F.transform("ends", lambda e, i: e - F.when(i > 0, F.get("ends", i - 1)).otherwise(0)), lambda t, k: F.struct(t.alias("term"), k.cast("long").alias("df")))
    df = index.select(F.explode(held).alias("x")).groupBy("x.term").agg(F.sum("x.df").alias("df"))
    weight = F.floor(1000 * F.ln((2 * n + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    pairs = queries.select("item", F.explode("terms").alias("term")).join(df, "term").groupBy("item").agg(F.sort_array(F.collect_list(F.struct("term", weight.alias("w")))).alias("terms"))
    return pairs, n, total


class Scorer:
    """Heaps of a block of items, filled segment by segment."""

    def __init__(self, items: list[tuple[list[str], list[int]]], n: int, total: int, top: int):
        self.items, self.n, self.total, self.top = items, n, total, top
        self.number = {t: k for k, t in enumerate(sorted({t for terms, _ in items for t in terms}))}
        self.heaps: list[list[tuple]] = [[] for _ in items]

    def add(self, row: dict) -> None:
        sizes = np.array(row["sizes"], dtype=np.int64)
        window = sizes.size
        m = 50 + 50 * sizes * self.n // self.total
        starts = np.append(0, row["ends"]).astype(np.int64)
        places = np.frombuffer(row["places"], dtype="<u2").astype(np.int64)
        tf = np.frombuffer(row["tfs"], dtype="<u4").astype(np.int64)
        worth = 1_000_000_000 * tf // (1000 * tf + 20 * m[places])
        at: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        touched = np.zeros(window, dtype=bool)
        for k, term in enumerate(row["terms"]):
            if (number := self.number.get(term)) is not None:
                own = places[starts[k] : starts[k + 1]]
                touched[own] = True
                at[number] = (own, worth[starts[k] : starts[k + 1]], np.packbits(touched))
                touched[own] = False
        sums = np.zeros(window, dtype=np.int64)
        for heap, (terms, weights) in zip(self.heaps, self.items):
            occupied = None
            for term, w in zip(terms, weights):
                if w and (found := at.get(self.number[term])):
                    own, value, bits = found
                    sums[own] += w * value
                    occupied = bits.copy() if occupied is None else np.bitwise_or(occupied, bits, out=occupied)
            if occupied is None:
                continue
            used = np.flatnonzero(np.unpackbits(occupied, count=window))
            self.harvest(heap, used, sums[used], row["ids"])
            sums[used] = 0

    def harvest(self, heap: list[tuple], used: np.ndarray, score: np.ndarray, ids: list) -> None:
        """Into the heap what beats its least; of equal scores the smaller id, one without id last."""
        least = heap[0][0] if len(heap) == self.top else 1
        good = score >= least
        used, score = used[good], score[good]
        if used.size > self.top:
            floor = np.partition(score, -self.top)[-self.top]
            above = np.flatnonzero(score > floor)
            good = np.append(above, np.flatnonzero(score == floor)[: self.top - above.size])  # places are in the order of ids
            used, score = used[good], score[good]
        for place, value in zip(used.tolist(), score.tolist()):
            own = ids[place]
            entry = (value, own is not None, -(own or 0))
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)


def blocks_of(pairs: DataFrame, most: int) -> Iterator[list]:
    """The items in blocks of at most ``most`` terms, an item of more alone."""
    block, size = [], 0
    for row in pairs.toLocalIterator():
        if block and size + len(row["terms"]) > most:
            yield block
            block, size = [], 0
        block.append((row["item"], [t["term"] for t in row["terms"]], [t["w"] for t in row["terms"]]))
        size += len(row["terms"])
    if block:
        yield block


def scored(index: DataFrame, block: list, n: int, total: int, top: int, kind: str) -> DataFrame:
    """item, id, score: the best rows of each task for each item of the block."""
    shared = index.sparkSession.sparkContext.broadcast(block)
    item_type = pa.string() if kind == "string" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        scorer = Scorer([(terms, weights) for _, terms, weights in items], n, total, top)
        for batch in batches:
            for row in batch.to_pylist():
                scorer.add(row)
        rows = [(item, -low if known else None, score) for (item, _, _), heap in zip(items, scorer.heaps) for score, known, low in heap]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((item_type, pa.int64(), pa.int64()))], ["item", "id", "score"])

    return index.mapInArrow(tidy(run), f"item {kind}, id long, score long")


def best(rows: DataFrame, top: int, *by: Column | str) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id")))
    return rows.withColumn("rank", place).where(F.col("rank") <= top)


def lexical_search(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", top: int = TOP, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``item_col``, rank, ``id_col`` and score: for every item its ``top`` best documents with a score above 0.

    Rows of one item are one query of their terms together; an item of null or empty text, or
    of terms that no document holds, has no row. Every row of ``docs`` is a document, repeated
    ones too; null and empty texts count as none. Equal scores stand by ascending id, null ids
    last. Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    kind = "string" if dict(items.dtypes)[item_col] == "string" else "long"
    queries = query_terms(items, item_col=item_col, text_col=item_text).withColumn("item", F.col("item").cast(kind))
    index = cut(segments(docs, wanted_bits(queries), id_col=id_col, text_col=text_col, window=window), "segments")
    pairs, n, total = weighted(queries, index)
    found = None
    small_batches(spark, rows=4, mb=64)
    for part in blocks_of(cut(pairs, "query-terms"), block):
        rows = cut(scored(index, part, n, total, top, kind), "scores")
        found = rows if found is None else found.union(rows)
    if found is None:
        found = spark.createDataFrame([], f"item {kind}, id long, score long")
    # Tasks' rows for an item meet in shares first, so that its last task gets a bounded number.
    found = best(best(found, top, "item", F.pmod(F.xxhash64("id"), F.lit(16))).drop("rank"), top, "item")
    return found.select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")


def op11_bucket_search(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """The 50 best documents of ``documents`` for every item of ``benchmark``."""
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    return lexical_search(docs, table(spark, sf_dir, "benchmark"))


ORACLE = rf"""
WITH terms AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS t FROM documents),
docs AS (SELECT row_id, doc_id, len(t)::BIGINT AS n, t FROM terms WHERE len(t) > 0),
total AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM docs),
items AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM benchmark),
held AS (SELECT row_id, term, count(*)::BIGINT AS tf FROM (SELECT row_id, unnest(t) AS term FROM docs) GROUP BY row_id, term),
weight AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, total GROUP BY term, n_docs),
scores AS (
  SELECT i.item_id, d.row_id, d.doc_id, sum(w.w * ((1000000000 * h.tf) // (1000 * h.tf + 20 * (50 + (50 * d.n * t.n_docs) // t.n_terms))))::BIGINT AS score
  FROM items i JOIN held h USING (term) JOIN weight w USING (term) JOIN docs d USING (row_id), total t GROUP BY ALL),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= {TOP}
"""
