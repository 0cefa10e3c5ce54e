"""A deterministic, sharded WARC writer and its reader.

Pages are dealt to shards in the order of their id, each shard is sorted and written as
one or more gzip files, a member per record; a file is closed once its compressed size
reaches the limit, so it exceeds it by at most one record. Every header and digest is made
anew from the payload. Of records with equal payloads the one with the least id is a
response and the others are revisits of it. Which pages those are is worked out on ids and
digests alone; the marks of revisits meet the pages in the shuffle that sorts the shards,
so the pages travel once.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, shared_path, small_batches, table
from .sharded import TaskFile, commit, files_of, shards_by_weight, store, tie_of

SHARD_BYTES, FILE_BYTES = 64 << 20, 16 << 20
#: The copies of one payload are dealt to so many tasks where they meet its mark.
SALTS = 16
#: A fixed date, so that equal input gives equal archives.
DATE = "2024-01-01T00:00:00Z"
VERSION = "WARC/1.1"
RESPONSE_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def sha1_32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>"


def one_line(text: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else "%%%02X" % ord(c) for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, number: int, first: tuple | None) -> bytes:
    """A response, or with ``first`` (the page_id, url and number of the response) a revisit of it without the payload."""
    head = RESPONSE_HEAD.format(len(payload)).encode()
    block = head if first else head + payload
    lines = [
        f"WARC-Type: {'revisit' if first else 'response'}",
        f"WARC-Record-ID: {record_id(f'{page_id}/{url}/{number}')}",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {one_line(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{sha1_32(payload)}",
        f"WARC-Block-Digest: sha1:{sha1_32(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        *([f"Page-ID: {page_id}"] if page_id is not None else []),
        f"Payload-Length: {len(payload)}",
    ]
    if first:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(f'{first[0]}/{first[1]}/{first[2]}')}", *([f"Refers-To-Page-ID: {first[0]}"] if first[0] is not None else [])]
    text = f"{VERSION}\r\n" + "\r\n".join(lines) + "\r\n\r\n"
    return text.encode() + block + b"\r\n\r\n"


def gzip_member(data: bytes, level: int = 6) -> bytes:
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    return pack.compress(data) + pack.flush()


def write_warc(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Archive every row of ``pages`` below ``folder``; the manifest: shard, file, records, bytes, sha256.

    The payload is the html in UTF-8, empty for null. Payloads under ``least_bytes`` are all
    responses. Null ids come first in the files, have no id header and are a response only where no other id has the payload; rows with equal ids are sorted by
    a hash of url and digest, then these; of wholly equal rows the first is the response. No rows, no files.
    """
    spark = pages.sparkSession
    small_batches(spark, rows=1000)
    html = F.coalesce(F.col(html_col), F.lit(""))
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), html.alias("html"), F.sha2(html.cast("binary"), 256).alias("sha"), F.octet_length(html).cast("long").alias("size"))
    slim = cut(source.drop("html"), "warc-keys")
    order = F.struct(F.col("page_id").isNull(), "page_id", F.col("url").isNull(), "url")
    groups = slim.where(F.col("size") >= least_bytes).groupBy("sha").agg(F.min(order).alias("least"), F.count("*").alias("n")).where("n > 1")
    firsts = groups.select("sha", F.col("least.page_id").alias("first_id"), F.col("least.url").alias("first_url"))
    salted = firsts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    copies = slim.where(F.col("size") >= least_bytes).select("page_id", "url", "sha", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int").alias("salt"))
    marks = copies.join(salted, ["sha", "salt"])
    shards = shards_by_weight(slim.withColumn("weight", F.col("size") + 512), "page_id", "weight", shard_bytes, tie_of("url", "sha"))
    none = F.lit(None)
    rows = source.select("page_id", "url", "sha", F.lit(1).alias("role"), "html", none.cast("long").alias("first_id"), none.cast("string").alias("first_url"))
    rows = rows.unionByName(marks.select("page_id", "url", "sha", F.lit(0).alias("role"), none.cast("string").alias("html"), F.col("first_id").cast("long"), "first_url"))
    rows = rows.withColumn("tie", tie_of("url", "sha"))
    rows = rows.withColumn("shard", shards.of(F.col("page_id"), F.col("tie")))
    rows = shards.dealt(rows).sortWithinPartitions("shard", F.col("page_id").asc_nulls_first(), "tie", F.col("url").asc_nulls_first(), "sha", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, shard, number, done = None, None, 0, []
        key, mark, copies = None, None, 0

        def close() -> None:
            out.close()
            done.append((shard, out.temporary, out.final, records, out.size, digest.hexdigest()))

        for batch in batches:
            for page_id, url, sha, role, text, first_id, first_url, at in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "sha", "role", "html", "first_id", "first_url", "shard"))):
                if role == 0:
                    key, mark, copies = (page_id, url, sha), (first_id, first_url), 0 if key != (page_id, url, sha) else copies
                    continue
                if at != shard:
                    if out is not None:
                        close()
                    out, shard, number = None, at, 0
                if key != (page_id, url, sha):
                    key, mark, copies = (page_id, url, sha), None, 0
                first = (*mark, 0) if mark and (mark != (page_id, url) or copies) else None
                data = gzip_member(record(page_id, url, text.encode(), copies, first))
                copies += 1
                if out is not None and out.size >= file_bytes:
                    close()
                    out, number = None, number + 1
                if out is None:
                    out, records, digest = TaskFile(folder, f"part-{shard:06d}-{number:05d}.warc.gz"), 0, hashlib.sha256()
                out.write(data)
                digest.update(data)
                records += 1
        if out is not None:
            close()
        kinds = (pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], ["shard", "temporary", "file", "records", "bytes", "sha256"])

    rows.mapInArrow(run, "shard int, temporary string, file string, records long, bytes long, sha256 string").write.parquet(f"{folder}/_manifest")
    return commit(spark, folder).drop("temporary")


def members(stream, size: int = 1 << 20) -> Iterator[bytes]:
    """The contents of the gzip members of a stream, one at a time."""
    held, parts, unpack = b"", [], zlib.decompressobj(31)
    while data := held or stream.read(size):
        held = b""
        parts.append(unpack.decompress(data))
        if unpack.eof:
            yield b"".join(parts)
            held, parts, unpack = unpack.unused_data, [], zlib.decompressobj(31)
    if any(parts):
        raise ValueError("the archive ends within a record")


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    block = rest[: int(headers["content-length"])]
    if "sha1:" + sha1_32(block) != headers["warc-block-digest"]:
        raise ValueError("the block's digest is not the header's")
    return headers, block


def read_warc(spark, folder: str) -> DataFrame:
    """A row per record of the files that the manifest of ``folder`` lists, checked against their digests.

    page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload (null for revisits).
    """
    files = files_of(spark, folder)
    names = ["page_id", "url", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload"]
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())

    def rows(path: str) -> Iterator[tuple]:
        fs, root = store(folder)
        with fs.open_input_stream(f"{root}/{path}", compression=None) as f:
            for data in members(f):
                h, block = parsed(data)
                payload, digest = None, h["warc-payload-digest"].removeprefix("sha1:")
                if h["warc-type"] == "response":
                    payload = block.partition(b"\r\n\r\n")[2]
                    if sha1_32(payload) != digest or len(payload) != int(h["payload-length"]):
                        raise ValueError("the payload's digest is not the header's")
                number = lambda k: int(h[k]) if k in h else None
                yield number("page-id"), h.get("warc-target-uri"), h["warc-type"], number("payload-length"), digest, number("refers-to-page-id"), payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        pack = lambda held: pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], k) for i, k in enumerate(kinds)], names)
        for batch in batches:
            for path in batch.column("file").to_pylist():
                for row in rows(path):
                    held.append(row)
                    size += len(row[6] or b"")
                    if size > 4 << 20 or len(held) >= 1000:
                        yield pack(held)
                        held, size = [], 0
        yield pack(held)

    return files.mapInArrow(run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def op2_warc_shards(spark, sf_dir: str, pages: DataFrame | None = None) -> DataFrame:
    """``pages`` written as WARC files in the shared folder and read back."""
    folder = shared_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages") if pages is None else pages, folder)
    return read_warc(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Base32 takes five bits at a time: five hexadecimal digits are four letters.
ORACLE = """
WITH payloads AS (
  SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
ranked AS (
  SELECT *, row_number() OVER w AS place, first_value(page_id) OVER w AS first_id FROM payloads
  WINDOW w AS (PARTITION BY html ORDER BY page_id NULLS LAST, url NULLS LAST))
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + ((CAST('0x' || substr(h, CAST(1 + 5 * (i // 4) AS INT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS INT), 1) for i in range(32)], '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN first_id END AS refers_to
FROM ranked"""
