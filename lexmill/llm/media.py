"""TIFF images in a binary column: a lossless writer for byte payloads and a page reader.

The reader walks the chain of image directories, decodes PackBits, LZW, deflate or
uncompressed strips and tiles, undoes horizontal differencing, and gives one row per
page. A damaged file gives one row that says why and never fails the job.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table

#: Fixed values of TIFF 6.0: tags, bytes per field type, compression schemes.
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, STRIP_SIZES, PLANAR, PREDICTOR, TILE_W, TILE_H, TILES, TILE_SIZES = 256, 257, 258, 259, 262, 273, 277, 278, 279, 284, 317, 322, 323, 324, 325
FIELD = {1: ("B", 1), 2: ("s", 1), 3: ("H", 2), 4: ("I", 4), 6: ("b", 1), 7: ("B", 1), 8: ("h", 2), 9: ("i", 4)}
PLAIN, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
#: A page may hold so many bytes, or up to what a column can hold if its file is large enough
#: to pack them (no scheme here packs better than 1 to 4096); a header that claims more is called damaged.
MAX_PAGE, MOST, PACKED = 1 << 28, (1 << 31) - 64, 4096


def pack_bits(data: bytes) -> bytes:
    """PackBits: runs of three and more as a count and a byte, the rest verbatim."""
    out, i, n = bytearray(), 0, len(data)
    while i < n:
        j = i + 1
        while j < n and j - i < 128 and data[j] == data[i]:
            j += 1
        if j - i >= 3:
            out += bytes((257 - (j - i), data[i]))
        else:
            while j < n and j - i < 128 and data[j : j + 3] != data[j : j + 1] * 3:
                j += 1
            out.append(j - i - 1)
            out += data[i:j]
        i = j
    return bytes(out)


def unpack_bits(data: bytes, size: int) -> bytes:
    out, i = bytearray(), 0
    while len(out) < size and i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 2 if n > 128 else 1
    return bytes(out)


def lzw_encode(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, high bit first, widths that change one code early."""
    acc = bits = 0
    out = bytearray()

    def put(code: int, width: int) -> None:
        nonlocal acc, bits
        acc, bits = acc << width | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(acc >> bits & 255)
        acc &= (1 << bits) - 1

    fresh = {bytes((i,)): i for i in range(256)}
    known, nxt, width, held = dict(fresh), 258, 9, b""
    put(256, 9)
    for byte in data:
        more = held + bytes((byte,))
        if more in known:
            held = more
            continue
        put(known[held], width)
        known[more] = nxt
        nxt += 1
        width = max(9, nxt.bit_length())
        if nxt >= 4094:
            put(256, width)
            known, nxt, width = dict(fresh), 258, 9
        held = bytes((byte,))
    if held:
        put(known[held], width)
        width = max(9, (nxt + 1).bit_length())
    put(257, min(width, 12))
    if bits:
        out.append(acc << (8 - bits) & 255)
    return bytes(out)


def lzw_decode(data: bytes, size: int) -> bytes:
    out, words, width, held = bytearray(), [], 9, b""
    acc = bits = pos = 0
    while len(out) < size:
        while bits < width:
            if pos >= len(data):
                return bytes(out)
            acc, bits, pos = acc << 8 | data[pos], bits + 8, pos + 1
        bits -= width
        code = acc >> bits
        acc &= (1 << bits) - 1
        if code == 257:
            break
        if code == 256:
            words, width, held = [bytes((i,)) for i in range(256)] + [b"", b""], 9, b""
            continue
        if not words or code > len(words) or (code == len(words) and not held):
            raise ValueError("damaged LZW data")
        word = words[code] if code < len(words) else held + held[:1]
        out += word
        if held:
            words.append(held + word[:1])
        held = word
        width = min(12, max(9, (len(words) + 1).bit_length()))
    return bytes(out)


def tiff_of(payload: bytes, *, width: int = 64, rows_per_strip: int = 512, compression: int = DEFLATE, predictor: int = 2, order: str = "<") -> bytes:
    """A one-page grey 8-bit image whose rows are the payload's; its size must be a positive multiple of ``width``."""
    if not payload or len(payload) % width:
        raise ValueError("the payload must be a positive multiple of the width")
    height = len(payload) // width
    pixels = np.frombuffer(payload, dtype=np.uint8).reshape(height, width)
    if predictor == 2:
        pixels = np.concatenate([pixels[:, :1], pixels[:, 1:] - pixels[:, :-1]], axis=1)
    pack = {PLAIN: bytes, DEFLATE: lambda d: zlib.compress(d, 6), PACKBITS: pack_bits, LZW: lzw_encode}[compression]
    strips = [pack(pixels[y : y + rows_per_strip].tobytes()) for y in range(0, height, rows_per_strip)]
    body, at = b"".join(strips), 8
    starts = np.cumsum([at, *map(len, strips)])[:-1].tolist()
    body += b"\0" * (len(body) % 2)
    entries = [(WIDTH, 4, [width]), (HEIGHT, 4, [height]), (BITS, 3, [8]), (COMPRESSION, 3, [compression]), (PHOTOMETRIC, 3, [1]), (STRIPS, 4, starts), (SAMPLES, 3, [1]), (ROWS, 4, [rows_per_strip]), (STRIP_SIZES, 4, [*map(len, strips)]), (PLANAR, 3, [1]), (PREDICTOR, 3, [predictor])]
    ifd = at + len(body)
    extra_at, table_, extra = ifd + 2 + 12 * len(entries) + 4, b"", b""
    for tag, kind, values in entries:
        raw = struct.pack(f"{order}{len(values)}{FIELD[kind][0]}", *values)
        if len(raw) > 4:
            raw, extra = struct.pack(f"{order}I", extra_at + len(extra)), extra + raw
        table_ += struct.pack(f"{order}HHI", tag, kind, len(values)) + raw.ljust(4, b"\0")
    head = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, ifd)
    return head + body + struct.pack(f"{order}H", len(entries)) + table_ + struct.pack(f"{order}I", 0) + extra


def directories(data: bytes) -> Iterator[tuple[str, dict[int, list[int]]]]:
    """The byte order and the fields of every image directory; a loop in the chain is an error."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or len(data) < 8 or struct.unpack_from(f"{order}H", data, 2)[0] != 42:
        raise ValueError("not a TIFF")
    (at,), seen = struct.unpack_from(f"{order}I", data, 4), set()
    while at:
        if at in seen:
            raise ValueError("the directories form a loop")
        seen.add(at)
        (n,) = struct.unpack_from(f"{order}H", data, at)
        fields = {}
        for i in range(n):
            tag, kind, count = struct.unpack_from(f"{order}HHI", data, at + 2 + 12 * i)
            if kind in FIELD and kind != 2:
                letter, each = FIELD[kind]
                if count * each > len(data):
                    raise ValueError("a field is larger than the file")
                place = at + 10 + 12 * i if count * each <= 4 else struct.unpack_from(f"{order}I", data, at + 10 + 12 * i)[0]
                fields[tag] = list(struct.unpack_from(f"{order}{count}{letter}", data, place))
        yield order, fields
        (at,) = struct.unpack_from(f"{order}I", data, at + 2 + 12 * n)


def page_of(data: bytes, order: str, tags: dict[int, list[int]]) -> dict:
    """One page's shape and samples, row by row, in the machine's byte order."""
    one = lambda tag, default=None: tags[tag][0] if tag in tags else default
    w, h, spp, bits = one(WIDTH), one(HEIGHT), one(SAMPLES, 1), tags.get(BITS, [1])
    scheme, predictor, planar = one(COMPRESSION, PLAIN), one(PREDICTOR, 1), one(PLANAR, 1)
    if not w or not h or len({*bits}) != 1 or bits[0] not in (8, 16) or spp < 1:
        raise ValueError("only 8-bit and 16-bit samples are read")
    if predictor not in (1, 2) or w * h * spp * bits[0] // 8 > max(MAX_PAGE, min(MOST, PACKED * len(data))):
        raise ValueError("unknown predictor or a page too large")
    kind = np.dtype(f"{order}u{bits[0] // 8}")
    tiled = TILES in tags
    bw, bh = (one(TILE_W), one(TILE_H)) if tiled else (w, min(one(ROWS, h), h))
    if not bw or not bh:
        raise ValueError("a block has no size")
    starts, sizes = (tags[TILES], tags[TILE_SIZES]) if tiled else (tags[STRIPS], tags[STRIP_SIZES])
    across, down = -(-w // bw), -(-h // bh)
    planes, depth = (spp, 1) if planar == 2 else (1, spp)
    if min(len(starts), len(sizes)) < across * down * planes:
        raise ValueError("blocks are missing")
    image = np.zeros((h, w, spp), dtype=kind.newbyteorder("="))
    for k in range(across * down * planes):
        plane, place = divmod(k, across * down)
        y, x = place // across * bh, place % across * bw
        rows = bh if tiled else min(bh, h - y)
        need, raw = rows * bw * depth * kind.itemsize, data[starts[k] : starts[k] + sizes[k]]
        if scheme == PLAIN:
            block = raw
        elif scheme in (DEFLATE, OLD_DEFLATE):
            block = zlib.decompressobj().decompress(raw, need)
        elif scheme == LZW:
            block = lzw_decode(raw, need)
        elif scheme == PACKBITS:
            block = unpack_bits(raw, need)
        else:
            raise ValueError(f"unknown compression {scheme}")
        if len(block) < need:
            raise ValueError("a block is too short")
        block = np.frombuffer(block[:need], dtype=kind).reshape(rows, bw, depth).astype(image.dtype)
        if predictor == 2:
            block = np.cumsum(block, axis=1, dtype=image.dtype)
        part = block[: h - y, : w - x]
        image[y : y + rows, x : x + bw, plane : plane + depth] = part
    return {"width": w, "height": h, "bits": bits[0], "channels": spp, "compression": scheme, "predictor": predictor, "samples": image.tobytes()}


def described(samples: bytes) -> str:
    """Mean, spread, entropy in bits and number of distinct values of the samples as bytes."""
    counts = np.bincount(np.frombuffer(samples, dtype=np.uint8), minlength=256)
    share = counts / max(1, counts.sum())
    mean = float(share @ np.arange(256))
    spread = float(np.sqrt(share @ (np.arange(256) - mean) ** 2))
    used = share[share > 0]
    return f"mean={mean:.3f};std={spread:.3f};entropy={abs(float(-(used * np.log2(used)).sum())):.4f};distinct={used.size}"


PAGES = "page int, width int, height int, bits int, channels int, compression int, predictor int, samples binary, feature string, error string"


def tiff_pages(media: DataFrame, *, media_col: str = "media") -> DataFrame:
    """One row per page of every TIFF in ``media_col``, beside the other columns of its row.

    Pages count from 0. A null column gives no row; an empty or damaged file gives, after
    the pages read before the fault, one row with ``error`` set and null samples. Columns
    that clash with the page columns are replaced by these.
    """
    small_batches(media.sparkSession, rows=500)
    names = [x.split()[0] for x in PAGES.split(", ")]
    kept = [c for c in media.columns if c != media_col and c not in names]
    source = media.select(*kept, F.col(media_col).alias("media"))
    types = pa.schema([("page", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("bits", pa.int32()), ("channels", pa.int32()), ("compression", pa.int32()), ("predictor", pa.int32()), ("samples", pa.binary()), ("feature", pa.string()), ("error", pa.string())])

    def pages(data: bytes) -> Iterator[dict]:
        k = 0
        try:
            for k, (order, tags) in enumerate(directories(data)):
                page = page_of(data, order, tags)
                yield page | {"page": k, "feature": described(page["samples"])}
        except (ValueError, KeyError, struct.error, zlib.error, IndexError, TypeError) as e:
            yield {"page": k, "error": str(e) or type(e).__name__}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i, data in enumerate(batch.column(len(kept)).to_pylist()):
                for page in pages(data) if data is not None else ():
                    rows.append(i)
                    found.append(page)
            at = pa.array(rows, pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(at) for i in range(len(kept))), *(pa.array([p.get(f.name) for p in found], f.type) for f in types)], [*kept, *names])

    given = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema if f.name in kept)
    return source.mapInArrow(run, given + PAGES)


def tiff_encode(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes`` and ``media``: every text as UTF-8, filled up with zeros to a positive multiple of 64, as a TIFF.

    A null text is an empty one. Equal texts give equal files; repeated rows stay.
    """
    small_batches(docs.sparkSession, rows=500)
    source = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [(t or "").encode() for t in batch.column("text").to_pylist()]
            media = [tiff_of(r + b"\0" * (64 * max(1, -(-len(r) // 64)) - len(r))) for r in raw]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], ["key", "n_bytes", "media"])

    return source.mapInArrow(run, f"key {source.schema['key'].dataType.simpleString()}, n_bytes long, media binary").withColumnRenamed("key", id_col)


def op9_tiff_media(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """Every text of ``documents`` stored as a TIFF and read back: sizes, digests and a feature."""
    stored = tiff_encode(table(spark, sf_dir, "documents") if docs is None else docs)
    stored = stored.withColumns({"media_bytes": F.length("media").cast("long"), "media_sha256": F.sha2("media", 256)})
    return tiff_pages(stored).select(
        "doc_id",
        "n_bytes",
        F.length("samples").cast("long").alias("payload_bytes"),
        F.sha2("samples", 256).alias("payload_sha256"),
        F.crc32(F.substring("samples", -64, 64)).alias("tail_crc32"),
        "media_bytes",
        "media_sha256",
        "feature",
        "error",
    )
