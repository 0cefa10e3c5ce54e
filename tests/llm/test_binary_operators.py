"""WARC, token files, TIFF and BPE: exact round trips and the libraries they follow."""

import base64
import hashlib
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import bpe, huffman_tokens, media, warc
from lexmill.llm.common import shared_path, tokenizer_file

TEXTS = [None, "", "hello world", "it's DON'T we'LL  x\n\n\ty ", "<|endoftext|> a <|endoftext|>", "é é \x85 　 ​ 日本 🙂", "x" * 700 + " " + "ab1" * 200, "ΑΣ İ ½²", "a\x1cb\x1f c"]


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "n"), (3, "again"), (3, "again")]
    got = bpe.op10_bpe_round_trip(spark, "", spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_bpe_scan_and_heap_agree():
    codec, rnd = bpe.codec(tokenizer_file("byte_bpe_50k.json")), random.Random(1)
    for _ in range(200):
        parts = [codec.byte_ids[b] for b in "".join(rnd.choice("aeinrst h") for _ in range(rnd.randrange(1, 60))).encode()]
        assert codec._scan([*parts]) == codec._heap([*parts])


@pytest.mark.parametrize("n", [1, 2, 3, 300, 5000])
def test_huffman_codes(n):
    rnd = np.random.default_rng(n)
    counts = rnd.zipf(1.4, n) % 10**6 + 1
    lengths = huffman_tokens.code_lengths(counts)
    assert lengths.max() <= 16 and (n == 1 or abs(sum(2.0 ** -lengths.astype(float)) - 1) < 1e-9)
    code, ids = huffman_tokens.Code(lengths), rnd.integers(0, n, 1000)
    block = code.encode(ids)
    size, count, marks = struct.unpack("<III", block[:12])
    assert (code.decode(block[12 + 4 * marks :], count, np.frombuffer(block[12 : 12 + 4 * marks], "<u4")) == ids).all() and len(block) == 12 + 4 * marks + size


def test_limit_holds_for_steep_counts():
    counts = np.array([2**k for k in range(40)])
    assert huffman_tokens.code_lengths(counts).max() == 16


def test_token_files(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    rows = [(7 - i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (-(10**12), "far away")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = shared_path(spark, "test-tokens")
    huffman_tokens.write_tokens(docs, folder, tokenizer_file("word_bpe_49k.json"), shard_tokens=20)
    got = huffman_tokens.read_tokens(spark, folder).orderBy("start").collect()
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want
    assert huffman_tokens.op3_huffman_tokens(spark, "", docs.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [None, 5])
def test_a_hot_key_fills_several_shards(spark, hot):
    rows = [(hot, f"text {'abcdefghij'[i % 10] * (i // 10 + 1)} of many") for i in range(200)] + [(i, "plain") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    folder = shared_path(spark, "test-tokens")
    manifest = huffman_tokens.write_tokens(docs, folder, tokenizer_file("word_bpe_49k.json"), shard_tokens=200).collect()
    most = max(r["tokens"] for r in manifest)
    assert len(manifest) > 5 and most < 800
    got = huffman_tokens.read_tokens(spark, folder).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    starts = np.cumsum([0, *(r["n_tokens"] for r in got)])
    assert [r["start"] for r in got] == starts[:-1].tolist()
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    sums = [zlib.crc32(np.array(library.encode(t, add_special_tokens=False).ids + [1], "<u4").tobytes()) for _, t in rows]
    assert sorted(r["ids_crc32"] for r in got) == sorted(sums)
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    folder = shared_path(spark, "test-warc")
    manifest = warc.write_warc(pages, folder, shard_bytes=4000).collect()
    assert len(manifest) > 5 and max(r["records"] for r in manifest) < 60
    back = warc.read_warc(spark, folder)
    first = min(i for i, t in rows if t == "plain")
    assert sorted((r["page_id"] for r in back.collect()), key=repr) == sorted((i for i, _ in rows), key=repr)
    assert back.where(f"record_type = 'revisit' and refers_to = {first}").count() == 7 and back.where("record_type = 'revisit'").count() == 7


def test_warc_round_trip(spark):
    rows = [(4, "u", "same"), (2, "v", "same"), (2, "v", "same"), (9, None, None), (8, "w", ""), (None, "x", "only"), (11, "line\r\nbreak", "ü" * 5000), (12, "y", "z\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = shared_path(spark, "test-warc")
    manifest = warc.write_warc(pages, folder, shard_bytes=2000, file_bytes=400)
    assert manifest.count() > 2
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_warc(spark, folder).collect()), key=repr)
    digest = lambda s: base64.b32encode(hashlib.sha1((s or "").encode()).digest()).decode()
    kinds = {4: ("revisit", 2), 9: ("revisit", 8)}
    want = [(i, len((h or "").encode()), digest(h), *kinds.get(i, ("response", None))) for i, _, h in rows]
    want[2] = (*want[2][:3], "revisit", 2)
    assert got == sorted(want, key=repr)
    again = shared_path(spark, "test-warc")
    second = warc.write_warc(pages.repartition(3), again, shard_bytes=2000, file_bytes=400)
    assert sorted(map(tuple, manifest.collect())) == sorted(map(tuple, second.collect()))
    assert warc.op2_warc_shards(spark, "", pages.limit(0)).count() == 0


@pytest.mark.parametrize("scheme", [media.PLAIN, media.LZW, media.DEFLATE, media.PACKBITS])
@pytest.mark.parametrize("order", "<>")
def test_tiff_round_trip(scheme, order):
    rnd = random.Random(scheme)
    for rows in (1, 7, 600, 3000 if scheme == media.LZW else 10):
        payload = bytes(rnd.choice(b"aab\0\0\0\0z") if rows < 600 else rnd.randrange(256) for _ in range(64 * rows))
        for predictor in (1, 2):
            data = media.tiff_of(payload, compression=scheme, predictor=predictor, order=order, rows_per_strip=100)
            ((o, tags),) = media.directories(data)
            assert media.page_of(data, o, tags)["samples"] == payload


def tiled_tiff() -> bytes:
    """Two pages of 20 x 20 in 16 x 16 tiles, 16 bits, with the predictor; the second in two planes."""
    image, out, nxt = np.arange(400, dtype=np.uint16).reshape(20, 20) * 7, bytearray(b"II*\0\0\0\0\0"), 4
    for planes in (1, 2):
        starts, sizes = [], []
        for p in range(planes):
            for y in (0, 16):
                for x in (0, 16):
                    block = np.zeros((16, 16), np.uint16)
                    part = (image + p)[y : y + 16, x : x + 16]
                    block[: part.shape[0], : part.shape[1]] = part
                    block = np.concatenate([block[:, :1], np.diff(block, axis=1).astype(np.uint16)], axis=1)
                    packed = zlib.compress(block.astype("<u2").tobytes())
                    starts.append(len(out))
                    sizes.append(len(packed))
                    out += packed
        at = len(out)
        out += struct.pack(f"<{2 * len(starts)}I", *starts, *sizes)
        out[nxt : nxt + 4] = struct.pack("<I", len(out))
        tags = [(256, 1, 20), (257, 1, 20), (258, 1, 16), (259, 1, 8), (277, 1, planes), (284, 1, planes), (317, 1, 2), (322, 1, 16), (323, 1, 16), (324, len(starts), at), (325, len(starts), at + 4 * len(starts))]
        out += struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, 4, n, v) for t, n, v in tags)
        nxt = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def test_tiff_pages(spark):
    good = tiled_tiff()
    rows = [(1, good, 5), (2, None, 6), (3, b"", 7), (4, good[:300], 8), (5, b"II*\0\x08\0\0\0\0\0\x08\0\0\0", 9)]
    got = media.tiff_pages(spark.createDataFrame(rows, "doc_id long, media binary, width int")).collect()
    image = (np.arange(400, dtype=np.uint16).reshape(20, 20) * 7).astype("<u2")
    pages = {(r["doc_id"], r["page"]): r for r in got}
    assert bytes(pages[1, 0]["samples"]) == image.tobytes() and bytes(pages[1, 1]["samples"]) == np.stack([image, image + np.uint16(1)], axis=2).tobytes()
    assert {r["doc_id"] for r in got if r["error"]} == {3, 4, 5} and pages[1, 0]["width"] == 20


def test_media_query(spark):
    got = {r["doc_id"]: r for r in media.op9_tiff_media(spark, "", spark.createDataFrame([*enumerate(TEXTS)], "doc_id long, text string")).collect()}
    for i, t in enumerate(TEXTS):
        raw = (t or "").encode()
        payload = raw + b"\0" * (64 * max(1, -(-len(raw) // 64)) - len(raw))
        r = got[i]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"], r["error"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), None)
    assert got[0]["media_sha256"] == got[1]["media_sha256"]


def test_page_above_a_quarter_gigabyte():
    payload = bytes(media.MAX_PAGE + 64)
    data = media.tiff_of(payload, predictor=1, rows_per_strip=1 << 16)
    (order, tags), = media.directories(data)
    assert media.page_of(data, order, tags)["samples"] == payload
    with pytest.raises(ValueError, match="too large"):
        media.page_of(data[:4096], order, tags)  # a short file cannot hold it
