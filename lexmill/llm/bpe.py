"""Byte-level BPE encoding and decoding over a contiguous rank array.

A word holds two lists side by side: its parts and, for every adjacent pair of
parts, the rank of the merge that would join them. The lowest rank is found by a
scan, its boundary is deleted and the two neighbouring ranks are looked up again.
For words of up to ``SHORT`` bytes a scan of a contiguous list beats any queue;
longer ones, where scans would cost the square of the length, take a heap.
Distinct words are kept in a bounded memo in every Python worker.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table, tidy, tokenizer_file

SHORT = 256
#: Words of a generation of the memo: about 20 MB.
MEMO = 100_000
NONE = 1 << 40

#: The white space of Unicode, and the word pattern of the public byte-level tokenizer.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Codec:
    """A byte-level vocabulary: words to ids and ids to bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        letters = byte_alphabet()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.byte_ids = [vocab[c] for c in letters]
        self.rank: dict[int, int] = {}
        self.joined: list[int] = []
        for a, b in spec["model"]["merges"]:
            self.rank.setdefault(vocab[a] << 32 | vocab[b], len(self.joined))
            self.joined.append(vocab[a + b])
        self.bytes_of = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.words = regex.compile(PATTERN).findall
        self.cuts = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.memo: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def word(self, text: str) -> tuple[int, ...]:
        if (ids := self.older.get(text)) is not None:
            self.keep(text, ids)
            return ids
        data = text.encode("utf-8")
        parts = [self.byte_ids[b] for b in data]
        ids = tuple(self._scan(parts) if len(parts) <= SHORT else self._heap(parts))
        if len(data) <= SHORT:
            self.keep(text, ids)
        return ids

    def keep(self, text: str, ids: tuple[int, ...]) -> None:
        """Two generations of at most MEMO words: what the older still serves moves on, the rest goes with it."""
        if len(self.memo) >= MEMO:
            self.older = self.memo.copy()
            self.memo.clear()
        self.memo[text] = ids

    def _scan(self, parts: list[int]) -> list[int]:
        get = self.rank.get
        ranks = [get(a << 32 | b, NONE) for a, b in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) != NONE:
            i = ranks.index(low)
            parts[i] = self.joined[low]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = get(parts[i] << 32 | parts[i + 1], NONE)
            if i:
                ranks[i - 1] = get(parts[i - 1] << 32 | parts[i], NONE)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        get, n = self.rank.get, len(parts)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        queue = [(r, i) for i in range(n - 1) if (r := get(parts[i] << 32 | parts[i + 1], NONE)) != NONE]
        heapq.heapify(queue)
        while queue:
            r, i = heapq.heappop(queue)
            j = after[i]
            if parts[i] < 0 or j < 0 or get(parts[i] << 32 | parts[j], NONE) != r:
                continue
            parts[i], parts[j] = self.joined[r], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] >= 0 and (r := get(parts[a] << 32 | parts[after[a]], NONE)) != NONE:
                    heapq.heappush(queue, (r, a))
        return [p for p in parts if p >= 0]

    def encode(self, text: str) -> list[int]:
        memo, word = self.memo, self.word
        if self.cuts is not None and any(t in text for t in self.special):
            ids: list[int] = []
            for piece in self.cuts.split(text):
                ids += [self.special[piece]] if piece in self.special else chain.from_iterable([word(w) for w in self.words(piece)])
            return ids
        return list(chain.from_iterable([memo.get(w) or word(w) for w in self.words(text)]))

    def decode(self, ids) -> str:
        """Ids out of the vocabulary are left out; bytes that are no UTF-8 become U+FFFD."""
        of = self.bytes_of
        try:
            data = b"".join([of[i] for i in ids])
        except KeyError:
            data = b"".join([of[i] for i in ids if i in of])
        return data.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def bpe_encode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``ids array<int>`` of every row of ``docs``.

    Null and empty texts give an empty array; repeated rows and null ids stay as
    they are; other columns are ignored; an empty table gives an empty one.
    """
    small_batches(docs.sparkSession, rows=1000, mb=2)
    source = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = codec(path).encode
        for batch in batches:
            rows = [encode(t) if t else [] for t in batch.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, rows)], dtype="int32")
            values = np.fromiter(chain.from_iterable(rows), dtype="int32", count=int(ends[-1]))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))], ["key", "ids"])

    return source.mapInArrow(tidy(run), f"key {source.schema['key'].dataType.simpleString()}, ids array<int>").withColumnRenamed("key", id_col)


def bpe_decode(ids_col, path: str):
    """The text of an ``array<int>`` column; a null array gives null."""

    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        of = codec(path).decode
        ids = ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids
        ends, values, nulls = ids.offsets.to_numpy(), ids.values.to_numpy(zero_copy_only=False), ids.is_null().to_pylist()
        return pa.array([None if gone else of(values[a:b].tolist()) for a, b, gone in zip(ends[:-1], ends[1:], nulls)], pa.string())

    return decode(ids_col)


def op10_bpe_round_trip(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Every text of ``documents`` encoded and decoded: counts and digests."""
    path = tokenizer_file("byte_bpe_50k.json")
    encoded = bpe_encode(table(spark, sf_dir, "documents") if docs is None else docs, path)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(bpe_decode(F.col("ids"), path), 256).alias("decoded_sha256"),
    )
