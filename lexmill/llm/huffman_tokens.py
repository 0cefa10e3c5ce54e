"""Token ids in binary files: canonical, length-limited Huffman codes of global counts.

Documents are tokenized once; their ids wait in a table. The counts of all ids, one number
per entry of the vocabulary, give one code of at most ``LIMIT`` bits (package-merge), which
is written canonically, so that its lengths alone restore it. Each shard of documents in
the order of their id becomes one file of independent blocks. A block starts with the bit
offset of every ``STRIDE``-th id, its checkpoints; a reader decodes all stretches between
checkpoints side by side with one table look-up per id.

File: magic, then the header's size and the header as JSON (first id's position, code
lengths as zlib), then blocks: size of the body, numbers of ids and checkpoints, the
checkpoints as u32, the bits; a block without ids ends them. Then the documents: their
number, and doc_id (s64), whether it is null (u8) and number of ids (s64) as columns.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .common import cut, shared_path, small_batches, table, tidy, tokenizer_file
from .sharded import TaskFile, commit, files_of, shards_by_weight, store, tie_of

MAGIC = b"LMHUF001"
LIMIT, BLOCK, STRIDE = 16, 1 << 16, 64
SHARD_TOKENS = 4_000_000
END = 1
#: Words of a generation of the memo: about 50 MB.
MEMO = 250_000


# The code


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of a best prefix code of at most ``limit`` bits; 0 for symbols without count."""
    used = np.flatnonzero(counts)
    out = np.zeros(counts.size, dtype=np.uint8)
    if used.size == 1:
        out[used] = 1
    if used.size < 2:
        return out
    if used.size > 1 << limit:
        raise ValueError("more symbols than codes of this length")
    leaf = np.sort(counts[used].astype(np.int64))
    order = used[np.argsort(counts[used], kind="stable")]
    # Package-merge by levels: of each level only which entries are leaves is kept.
    weights, kinds = leaf, [np.ones(leaf.size, dtype=bool)]
    for _ in range(limit - 1):
        pairs = weights[: weights.size // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaf, pairs])
        by = np.argsort(both, kind="stable")
        weights = both[by]
        kinds.append(by < leaf.size)
    take = 2 * leaf.size - 2
    lengths = np.zeros(leaf.size, dtype=np.int64)
    for kind in reversed(kinds):
        leaves = int(kind[:take].sum())
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    out[order] = lengths
    return out


def canonical(lengths: np.ndarray) -> np.ndarray:
    """Codes in the order of length, then symbol."""
    codes = np.zeros(lengths.size, dtype=np.uint32)
    order = np.lexsort((np.arange(lengths.size), lengths))
    order = order[lengths[order] > 0]
    n = lengths[order].astype(np.int64)
    if order.size:
        width = int(n.max())
        ends = np.cumsum(1 << (width - n))  # in units of the longest code
        codes[order] = (np.append(0, ends[:-1]) >> (width - n)).astype(np.uint32)
    return codes


class Code:
    """Encoder and decoder tables of given lengths."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical(lengths)
        self.width = max(1, int(lengths.max(initial=1)))
        self.aligned = (self.codes.astype(np.uint32) << (32 - self.lengths).astype(np.uint32)).astype(np.uint32)
        order = np.lexsort((np.arange(lengths.size), lengths))
        order = order[lengths[order] > 0]
        fill = 1 << (self.width - self.lengths[order])
        self.symbol = np.repeat(order, fill).astype(np.int32)
        self.symbol = np.append(self.symbol, np.zeros((1 << self.width) - self.symbol.size, np.int32))
        self.size = self.lengths[self.symbol].astype(np.int64)

    def encode(self, ids: np.ndarray) -> bytes:
        """A block."""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        marks = np.append(0, ends)[:-1][::STRIDE].astype("<u4")
        bits = np.unpackbits(self.aligned[ids].astype(">u4").view(np.uint8).reshape(-1, 4)[:, : -(-self.width // 8)], axis=1)
        body = np.packbits(bits[np.arange(bits.shape[1]) < n[:, None]]).tobytes()
        return struct.pack("<III", len(body), ids.size, marks.size) + marks.tobytes() + body

    def decode(self, body: bytes, count: int, marks: np.ndarray) -> np.ndarray:
        data = np.frombuffer(body + b"\0" * 8, dtype=np.uint8)
        # For every byte the 32 bits that start there.
        d = data.astype(np.uint32)
        window = d[:-3] << 24 | d[1:-2] << 16 | d[2:-1] << 8 | d[3:]
        out = np.zeros((marks.size, STRIDE), dtype=np.int32)
        at = marks.astype(np.int64)
        last = count - (marks.size - 1) * STRIDE
        for k in range(STRIDE):
            if k == last:
                at = at[:-1]  # the last stretch may be shorter
            if not at.size:
                break
            code = window[at >> 3] << (at & 7).astype(np.uint32) >> np.uint32(32 - self.width)
            out[: at.size, k] = self.symbol[code]
            at = at + self.size[code]
        return out.ravel()[:count]


# Tokenizing


class Words:
    """Ids of whole texts through the library, each distinct word once while it is remembered.

    The tokenizer drops white space and looks at nothing across it, so a text's ids are
    those of its words in turn. A special token's string in a text would be cut out first,
    blanks or not; it holds none, so it too lies within a word. Letters and the punctuation
    behind them are tokens of their own in any case, and case is dropped, so such words are
    asked for in these two parts. The apostrophe, which contractions need, is not one.
    Lower-case letters pass the library's normalizer as they are, so its model is asked
    directly. A tokenizer file of which this does not hold is found out at the start.
    Batches of Latin-1 texts without special tokens take lower case, blanks for line ends
    and a blank between letters and punctuation at once, which leaves fewer distinct words.
    """

    #: Beyond Latin-1 a lower-case letter may compose with a mark where its capital does not.
    STRANGE = r"[^\x00-\x{FF}]|<\|"
    BESIDE = r"([a-zß-öø-ÿ])([!-&(-/:-@\[-`{-~])"

    LETTERS = re.compile(r"[a-zß-öø-ÿ]+").fullmatch

    PARTS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)").fullmatch

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.vocabulary = self.library.get_vocab_size(with_added_tokens=True)
        self.kind, self.code = ("<u2", "H") if self.vocabulary <= 1 << 16 else ("<u4", "I")
        self.end = np.array([END], dtype=self.kind).tobytes()
        self.alphabet = byte_alphabet()
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        probe = "Probe, Àéß... straße (it's) ûber; 12 thereafter|x the the."
        if self.batch(pa.array([probe]))[0][: -len(self.end)] != np.array(self.library.encode(probe, add_special_tokens=False).ids, dtype=self.kind).tobytes():
            raise ValueError("a tokenizer that drops white space and case is needed")

    def known(self, new: set[str]) -> None:
        """Bring the words into the memo: from the older generation, or by asking the library."""
        for w in [w for w in new if w in self.older]:
            self.memo[w] = self.older[w]
            new.discard(w)
        plain = [w for w in new if self.LETTERS(w)]
        ask = self.library.model.tokenize
        for w in plain:
            data = w if w.isascii() else "".join([self.alphabet[b] for b in w.encode()])
            self.memo[w] = array(self.code, [x.id for x in ask(data)]).tobytes()
        asked = [*new.difference(plain)]
        for w, e in zip(asked, self.library.encode_batch(asked, add_special_tokens=False)):
            self.memo[w] = array(self.code, e.ids).tobytes()

    def pieces(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian numbers."""
        if len(self.memo) > MEMO:
            self.older, self.memo = self.memo, {}
        memo = self.memo
        new = {w for w in words if w not in memo}
        parted = {w: (m[1].lower(), m[2]) for w in new if (m := self.PARTS(w)) and (m[2] or not w.islower())}
        asked = {p for pair in parted.values() for p in pair if p not in memo}
        self.known(asked.union(w for w in new if w not in parted))
        for w, (core, rest) in parted.items():
            memo[w] = memo[core] + memo[rest]
        return [memo[w] for w in words]

    def batch(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, ``END`` behind them, as little-endian numbers."""
        texts = pc.fill_null(texts, "")
        if not pc.any(pc.match_substring_regex(texts, self.STRANGE)).as_py():
            texts = pc.replace_substring(pc.ascii_lower(texts), "\n", " ")
            texts = pc.replace_substring_regex(texts, self.BESIDE, r"\1 \2")
        lists = pc.split_pattern(texts, " ")
        coded = lists.flatten().dictionary_encode()
        pieces = self.pieces(coded.dictionary.to_pylist())
        ids = np.frombuffer(b"".join(pieces), dtype=self.kind)
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // len(self.end)
        start, at = np.cumsum(size) - size, coded.indices.to_numpy()
        n = size[at]
        ends = np.append(0, np.cumsum(n))
        flat = ids[np.repeat(start[at] - ends[:-1], n) + np.arange(ends[-1])]
        edge = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        return [flat[a:b].tobytes() + self.end for a, b in zip(edge[:-1], edge[1:])]


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    return Words(path)


def tokenized(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, n_tokens and the ids as little-endian 16- or 32-bit numbers, ``END`` after each document's own. Null is the empty text."""
    source = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        for batch in batches:
            rows = words.batch(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array([len(r) // len(words.end) for r in rows], pa.int64()), pa.array(rows, pa.binary())], ["key", "n_tokens", "ids"])

    return source.mapInArrow(tidy(run), f"key {source.schema['key'].dataType.simpleString()}, n_tokens long, ids binary")


def global_counts(rows: DataFrame, vocabulary: int) -> np.ndarray:
    """How often each id occurs in all documents: one number per entry of the vocabulary."""
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            data = b"".join(batch.column("ids").to_pylist())
            counts += np.bincount(np.frombuffer(data, dtype=kind), minlength=vocabulary)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["id", "n"])

    out = np.zeros(vocabulary, dtype=np.int64)
    for r in rows.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        out[r["id"]] = r["n"]
    return out


# Files


def write_tokens(docs: DataFrame, folder: str, path: str, *, id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the ids of every row of ``docs`` below ``folder`` in ascending order of the id; the manifest.

    Null ids come first; rows with equal ids are sorted by a hash of their token ids, then these. No rows, no files.
    """
    spark = docs.sparkSession
    small_batches(spark, rows=3000, mb=6)
    rows = cut(tokenized(docs, path, id_col=id_col, text_col=text_col), "token-ids")
    vocabulary = words_of(path).vocabulary
    lengths = code_lengths(global_counts(rows, vocabulary))
    shards = shards_by_weight(rows, "key", "n_tokens", shard_tokens, tie_of("ids"))
    tables = spark.sparkContext.broadcast((lengths, shards.bases))
    kind = "<u2" if vocabulary <= 1 << 16 else "<u4"
    rows = rows.withColumn("tie", tie_of("ids"))
    dealt = shards.dealt(rows.withColumn("shard", shards.of(F.col("key"), F.col("tie")))).sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "tie", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, bases = tables.value
        code, done, out = Code(lengths), [], None
        shard, held, size, index = None, [], 0, []

        def blocks(least: int) -> None:
            nonlocal held, size
            if size < least or not size:
                return
            ids = np.concatenate(held)
            end = ids.size // BLOCK * BLOCK if least > 1 else ids.size
            for a in range(0, end, BLOCK):
                out.write(code.encode(ids[a : min(end, a + BLOCK)]))
            held, size = [ids[end:]], ids.size - end

        def close() -> None:
            blocks(1)
            out.write(struct.pack("<III", 0, 0, 0) + struct.pack("<Q", len(index)))
            out.write(np.array([k or 0 for k, _ in index], dtype="<i8").tobytes() + np.array([k is None for k, _ in index], dtype=np.uint8).tobytes() + np.array([n for _, n in index], dtype="<i8").tobytes())
            out.close()
            done.append((shard, out.temporary, out.final, len(index), sum(n for _, n in index), out.size))

        for batch in batches:
            for at, key, ids in zip(*(batch.column(c).to_pylist() for c in ("shard", "key", "ids"))):
                if at != shard:
                    if out is not None:
                        close()
                    shard, held, size, index = at, [], 0, []
                    out = TaskFile(folder, f"part-{shard:06d}.huf")
                    head = json.dumps({"start": bases[shard], "lengths": base64.b64encode(zlib.compress(lengths.tobytes())).decode()}).encode()
                    out.write(MAGIC + struct.pack("<I", len(head)) + head)
                got = np.frombuffer(ids, dtype=kind)
                held.append(got)
                size += got.size
                index.append((key, got.size))
                blocks(BLOCK)
        if out is not None:
            close()
        kinds = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], ["shard", "temporary", "file", "documents", "tokens", "bytes"])

    dealt.select("shard", "key", "ids").mapInArrow(run, "shard int, temporary string, file string, documents long, tokens long, bytes long").write.parquet(f"{folder}/_manifest")
    return commit(spark, folder).drop("temporary")


def blocks_of(f, code: Code) -> Iterator[np.ndarray]:
    while True:
        size, count, marks = struct.unpack("<III", f.read(12))
        if not count:
            return
        at = np.frombuffer(f.read(4 * marks), dtype="<u4")
        yield code.decode(f.read(size), count, at)


def read_tokens(spark, folder: str) -> DataFrame:
    """From the files of the manifest: doc_id, start (ids before the document), n_tokens, ids_crc32 of its 32-bit ids.

    Blocks are decoded one at a time; a document may span any number of them.
    """
    files = files_of(spark, folder)

    def rows(name: str) -> pa.RecordBatch:
        fs, root = store(folder)
        with fs.open_input_file(f"{root}/{name}") as f:
            if f.read(8) != MAGIC:
                raise ValueError("not a token file")
            head = json.loads(f.read(struct.unpack("<I", f.read(4))[0]))
            code = Code(np.frombuffer(zlib.decompress(base64.b64decode(head["lengths"])), dtype=np.uint8))
            first = f.tell()
            while True:  # the documents' sizes stand behind the blocks
                size, count, marks = struct.unpack("<III", f.read(12))
                if not count:
                    break
                f.seek(f.tell() + 4 * marks + size)
            (n,) = struct.unpack("<Q", f.read(8))
            keys, gone, sizes = np.frombuffer(f.read(8 * n), "<i8"), np.frombuffer(f.read(n), np.uint8), np.frombuffer(f.read(8 * n), "<i8")
            f.seek(first)
            sums, doc, left, crc = np.zeros(n, dtype=np.int64), 0, int(sizes[0]) if n else 0, 0
            for ids in blocks_of(f, code):
                data, at = ids.astype("<u4").tobytes(), 0
                while at < len(data):
                    took = min(4 * left, len(data) - at)
                    crc = zlib.crc32(data[at : at + took], crc)
                    at, left = at + took, left - took // 4
                    if not left:
                        sums[doc], crc, doc = crc, 0, doc + 1
                        left = int(sizes[doc]) if doc < n else 0
            if doc != n:
                raise ValueError("the ids end before the documents do")
        starts = head["start"] + np.cumsum(sizes) - sizes
        return pa.RecordBatch.from_arrays([pa.array(keys, mask=gone.astype(bool)), *map(pa.array, (starts, sizes, sums))], ["doc_id", "start", "n_tokens", "ids_crc32"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                yield rows(name)

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op3_huffman_tokens(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Every text of ``documents`` as token ids in Huffman-coded files of the shared folder, read back."""
    folder = shared_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents") if docs is None else docs, folder, tokenizer_file("word_bpe_49k.json"))
    return read_tokens(spark, folder)
