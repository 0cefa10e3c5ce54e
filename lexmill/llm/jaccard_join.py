"""All pairs of documents whose n-gram sets reach a Jaccard similarity, as components.

Equal sets are one node from the start. Under one order of all shingles, rare ones first,
two sets that are similar enough share one of their first |S| - ceil(t |S|) + 1 shingles,
so these prefixes, brought together by shingle, meet for every link; shingles of a single
node go at once. What meets is cut down by bounds before any set is compared:

* tiles: where many nodes share a shingle, they are dealt into bands of sizes that differ
  by at most the factor t, and only equal and adjacent bands form tiles; bands are cut into
  blocks so that a tile stays small;
* bitmaps: every set has a bitmap that holds the parity of its members per bit. The XOR of
  two has at most as many bits as the sets differ in members, which bounds the overlap from
  above. Bitmaps grow with their set and fold to the smaller of two widths;
* exact: what is left is decided on the sorted arrays of 64-bit shingle hashes.

Rounds keep large groups of near copies linear. First every node is compared with the
least node of each of its shingles; what links forms components. Twice every node is then
compared with the nearest node of another component in each of its tiles, by bitmaps,
narrow ones first, and components join; nodes without such a neighbour are done. At last
all pairs of the other nodes that are still in different components are looked at. So no link between components is lost, and pairs within a component, which
could not change the result, are seldom made.

The order comes from a count sketch of all shingles of a fixed width; it only decides how
rare the prefixes are, never the result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small_batches, table, tidy
from .components import components
from .shared_shingles import cannot_link
from .shingles import mixed, nodes_of, shingle_sets

N, PERCENT = 4, 85
SKETCH_BITS, SKETCH_PARTS = 20, 32
#: Members of one shingle up to which they form a single tile, and of a block beyond it.
TILE = 1024
#: Members that one leader is compared with in one task.
SHARE = 256


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def bitmap_of(hashes: np.ndarray) -> bytes:
    """The parity of the members per bit; two to four bits a member, a power of two of at least 256.

    So wide, the bits of two sets that differ by a tenth seldom fall together, and the bound is near the truth.
    """
    width = 1 << max(8, math.ceil(math.log2(max(1, 2 * hashes.size))))
    bits = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").tobytes()


def narrowed(bitmap: bytes, size: int) -> bytes:
    """The bitmap at about 0.4 bits a member, enough to tell sets that have little in common."""
    width = 1 << max(5, math.ceil(math.log2(max(1, 0.05 * size))))
    return folded(np.frombuffer(bitmap, dtype=np.uint8), width).tobytes()


def folded(bitmap: np.ndarray, size: int) -> np.ndarray:
    """Rows of bytes at a smaller power-of-two width: bits that fall together add up modulo 2."""
    while bitmap.shape[-1] > size:
        half = bitmap.shape[-1] // 2
        bitmap = bitmap[..., :half] ^ bitmap[..., half:]
    return bitmap


def may_link(n_a, n_b, apart, percent: int):
    """Whether sets of these sizes that differ in at least ``apart`` members can reach the similarity."""
    total = n_a + n_b
    low, high = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    most = np.minimum(low, (total - apart) // 2)
    return (100 * low >= percent * high) & (100 * most >= percent * (total - most))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if min(a.size, b.size) * 100 < percent * max(a.size, b.size):
        return False
    at = np.minimum(np.searchsorted(a, b), a.size - 1)
    both = int((a[at] == b).sum())
    return 100 * both >= percent * (a.size + b.size - both)


def sizes_of(docs: DataFrame, n: int) -> DataFrame:
    """A row per document: id, place, node, n_shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), n)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("place"), pa.array(nodes_of(sets)), pa.array([s.size for s in sets], pa.int64())], ["id", "place", "node", "n_shingles"])

    return docs.mapInArrow(tidy(run), f"id {docs.schema['id'].dataType.simpleString()}, place string, node long, n_shingles long")


def features(texts: DataFrame, n: int) -> DataFrame:
    """A row per text (node, n_shingles, bitmap, narrow), and per task the counts of its part of the sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["node", "n_shingles", "bitmap", "narrow", "part", "counts"]
        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), n)
            every = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            counts += np.bincount((every >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=counts.size).astype(np.uint32)
            wide = [bitmap_of(s) for s in sets]
            none = pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([s.size for s in sets], pa.int64()), pa.array(wide, pa.binary()), pa.array([narrowed(b, s.size) for b, s in zip(wide, sets)], pa.binary()), *none], names)
        parts = [zlib.compress(p.tobytes(), 1) for p in np.split(counts, SKETCH_PARTS)]
        none = [pa.nulls(SKETCH_PARTS, t) for t in (pa.int64(), pa.int64(), pa.binary(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*none, pa.array(range(SKETCH_PARTS), pa.int32()), pa.array(parts, pa.binary())], names)

    return texts.mapInArrow(tidy(run), "node long, n_shingles long, bitmap binary, narrow binary, part int, counts binary")


def levels_of(found: DataFrame) -> np.ndarray:
    """The sketch as one byte per counter, eight levels to each doubling of its count: a fixed number of bytes."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
                got = np.frombuffer(zlib.decompress(counts), dtype=np.uint32).astype(np.uint64)
                sums[part] = sums[part] + got if part in sums else got
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["part", "counts"])

    parts = found.where("part is not null").select("part", "counts")
    merged = parts.repartition(SKETCH_PARTS, "part").mapInArrow(tidy(add), "part int, counts binary").collect()
    out = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), dtype=np.uint64)
    for r in merged:
        out[r["part"]] = np.frombuffer(r["counts"], dtype=np.uint64)
    return np.minimum(8 * np.log2(out.ravel() + 1.0), 255).astype(np.uint8)


def prefixes(texts: DataFrame, levels: np.ndarray, n: int, percent: int) -> DataFrame:
    """A row (token, node, n_shingles) for every shingle in a text's prefix. The token is level and 56 bits of hash: the order itself."""
    shared = texts.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        for batch in batches:
            sets = shingle_sets(batch.column("text").to_pylist(), n)
            tokens = []
            for s in sets:
                key = levels[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(56) | mixed(s) >> np.uint64(8)
                p = prefix_size(s.size, percent)
                tokens.append(np.partition(key, p - 1)[:p] if p < s.size else key)
            if tokens:
                each = [t.size for t in tokens]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(batch.column("node").to_numpy(), each)), pa.array(np.repeat(np.array([s.size for s in sets], np.int32), each))], ["token", "node", "n_shingles"])

    return texts.select("text", "node").mapInArrow(tidy(run), "token long, node long, n_shingles int")


def shared_tokens(rows: DataFrame) -> DataFrame:
    """Of rows sorted by (token, node): those whose token has two nodes or more, once each, with the token's least node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # the last row so far, its leader, and whether it has gone out
        for batch in batches:
            token, node, size = (batch.column(i).to_numpy() for i in range(3))
            if not token.size:
                continue
            lead_in, out = None, True
            if held is not None:
                token, node, size = (np.concatenate([h[:1], x]) for h, x in zip(held, (token, node, size)))
                lead_in, out = held[3], held[4]
            fresh = np.append(True, token[1:] != token[:-1])
            new = fresh | np.append(True, node[1:] != node[:-1])
            first = np.flatnonzero(fresh)
            run_no = np.cumsum(fresh) - 1
            leader = node[first][run_no]
            if lead_in is not None:
                leader[run_no == 0] = lead_in
            many = np.bincount(run_no, weights=new) > 1
            if lead_in is not None and lead_in != node[0]:
                many[0] = True
            keep = new & many[run_no]
            if held is not None and out:
                keep[0] = False
            gone = bool(many[-1])
            last = token.size - 1
            held = [token[-1:], node[-1:], size[-1:], leader[last], gone]
            at = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (token, leader, node, size)], ["token", "leader", "node", "n_shingles"])

    return rows.mapInArrow(tidy(run), "token long, leader long, node long, n_shingles int")


def bounded(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps allow."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("bitmap").alias(f"bits_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = np.zeros(batch.num_rows, dtype=np.int64)
            for i, (x, y) in enumerate(zip(batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist())):
                u, v = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
                m = min(u.size, v.size)
                apart[i] = int.from_bytes((folded(u, m) ^ folded(v, m)).tobytes()).bit_count()
            ok = may_link(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), apart, percent)
            at = pa.array(np.flatnonzero(ok))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], ["a", "b"])

    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(tidy(run), "a long, b long")


def tiled(rows: DataFrame, bitmaps: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs of nodes of different components that share a token, by sizes and bitmaps, tile by tile.

    With ``best`` only each node's pair with the fewest differing bits of a tile: a row a node at most.

    ``rows``: token, node, n_shingles, label; the bitmaps join what is dealt to tiles last.
    """
    step = math.log(100 / percent)
    members = rows.groupBy("token").agg(F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("token", "members")
    rows = rows.join(members, "token").withColumn("blocks", F.ceil(F.col("members") / TILE))
    one = rows.where("blocks = 1").select("token", F.lit("").alias("tile"), F.lit(0).alias("side"), "node", "n_shingles", "label")
    # Sizes of a linking pair lie in equal or adjacent bands.
    many = rows.where("blocks > 1").withColumns({"band": F.floor(F.log("n_shingles") / step + 1e-9), "block": F.pmod(F.xxhash64("node"), F.col("blocks"))})
    others = F.expr("transform(sequence(0L, blocks - 1), x -> x)")
    many = many.withColumn("other", F.explode(others))
    name = lambda band, low, high: F.concat_ws(":", band, low, high)
    tiles = F.array(
        F.struct(name(F.concat(F.col("band"), F.lit("=")), F.least("block", "other"), F.greatest("block", "other")).alias("tile"), F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side")),
        F.struct(name(F.concat(F.col("band"), F.lit("+")), "block", "other").alias("tile"), F.lit(1).alias("side")),
        F.struct(name(F.concat(F.col("band") - 1, F.lit("+")), "other", "block").alias("tile"), F.lit(2).alias("side")),
    )
    many = many.withColumn("at", F.explode(tiles)).select("token", "at.tile", "at.side", "node", "n_shingles", "label")
    dealt = one.unionByName(many).join(bitmaps, "node").select("token", "tile", "side", "node", "n_shingles", "label", "bitmap").repartition("token", "tile").sortWithinPartitions("token", "tile", "side", "node")

    def pairs_of(group: list[tuple]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        side = np.array([g[0] for g in group])
        node, size, label = (np.array([g[k] for g in group], dtype=np.int64) for k in (1, 2, 3))
        if (label == label[0]).all():
            return
        least = min(len(g[4]) for g in group)
        if len(group) == 2:
            x, y = (int.from_bytes(folded(np.frombuffer(g[4], dtype=np.uint8), least).tobytes()) for g in group)
            if node[0] != node[1] and side[0] + side[1] in (0, 3) and may_link(size[0], size[1], (x ^ y).bit_count(), percent):
                yield node.min(keepdims=True), node.max(keepdims=True)
            return
        bits = np.stack([folded(np.frombuffer(g[4], dtype=np.uint8), least) for g in group])
        for i in range(len(group) - (not best)):
            j = np.arange(0 if best else i + 1, len(group))
            j = j[(label[j] != label[i]) & (node[j] != node[i]) & ((side[j] != side[i]) if side[i] else True)]  # side 0: a tile of one block
            j = j[may_link(size[i], size[j], 0, percent)]
            if j.size:
                apart = np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
                good = may_link(size[i], size[j], apart, percent)
                j, apart = j[good], apart[good]
                if j.size:
                    j = j[[apart.argmin()]] if best else j
                    yield np.minimum(node[i], node[j]), np.maximum(node[i], node[j])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if len(group) > 1:
                found = [*pairs_of(group)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([f[k] for f in found])) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            token, tile = batch.column("token").to_pylist(), batch.column("tile").to_pylist()
            rest = [*zip(*(batch.column(c).to_pylist() for c in ("side", "node", "n_shingles", "label", "bitmap")))]
            for t, name, row in zip(token, tile, rest):
                if (t, name) != key:
                    yield from done()
                    key, group = (t, name), []
                group.append(row)
        yield from done()

    return dealt.mapInArrow(tidy(run), "a long, b long").distinct()


def linked(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose sorted shingle arrays reach the similarity.

    Each a's text travels once for every ``SHARE`` of its pairs, each b's once for each pair.
    """
    shares = pairs.groupBy("a").agg(F.ceil(F.count("*") / SHARE).alias("shares"))
    others = pairs.join(shares, "a").select("a", F.pmod(F.xxhash64("b"), F.col("shares")).alias("share"), F.lit(1).alias("role"), F.col("b").alias("node"))
    firsts = shares.select("a", F.explode(F.expr("sequence(0L, shares - 1)")).alias("share"), F.lit(0).alias("role"), F.col("a").alias("node"))
    rows = others.unionByName(firsts).join(texts, "node").select("a", "share", "role", "node", "text")
    rows = rows.repartition("a", "share").sortWithinPartitions("a", "share", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first = None, None
        for batch in batches:
            a, role, node = (batch.column(c).to_pylist() for c in ("a", "role", "node"))
            share, found = batch.column("share").to_pylist(), []
            sets = shingle_sets(batch.column("text").to_pylist(), n)
            for k, (x, s, own) in enumerate(zip(zip(a, share), sets, nodes_of(sets).tolist())):
                if own != node[k]:
                    continue
                if role[k] == 0:
                    key, first = x, s
                elif x == key and similar(first, s, percent):
                    found.append((a[k], node[k]))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return rows.mapInArrow(tidy(run), "a long, b long")


def jaccard_components(docs: DataFrame, *, n: int = N, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` (the least id that links reach) of every row.

    Words are runs of characters other than ASCII blanks, with A-Z in lower case. A text
    with fewer than ``n`` words is one shingle; null texts and texts without words have an
    empty set, link with nothing and are their own component. Repeated rows stay and share a
    component; rows with a null id link like others but name no component unless all do.
    """
    spark = docs.sparkSession
    small_batches(spark, rows=1000, mb=2)
    place = F.concat_ws(":", F.xxhash64(text_col).cast("string"), F.col(id_col).cast("string"))  # rows of one id are spread by their texts
    source = docs.select(F.col(id_col).alias("id"), place.alias("place"), F.col(text_col).alias("text"))
    members = cut(sizes_of(source, n), "jaccard-members")
    every = cut(members.where("n_shingles > 0").groupBy("node").agg(F.min("id").alias("least_id"), F.min("place").alias("place"), F.first("n_shingles").alias("n_shingles")), "jaccard-nodes")
    total = every.agg(F.sum("n_shingles")).first()[0] or 0
    able = every.join(cannot_link(source, total, n, percent), "node", "left_anti")
    texts = cut(texts_of(cut(able.select("node", "place"), "jaccard-able"), source, n), "jaccard-texts")
    found = cut(features(texts, n), "jaccard-features")
    nodes = cut(found.where("part is null").groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), F.first("bitmap").alias("bitmap"), F.first("narrow").alias("narrow")), "jaccard-bitmaps")

    rows = prefixes(texts, levels_of(found), n, percent)
    rows = rows.repartition("token").sortWithinPartitions("token", "node")
    shared = cut(shared_tokens(rows), "jaccard-tokens")

    star = shared.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    star = cut(bounded(star, nodes, percent), "jaccard-pairs")
    near = components(linked(star, texts, n, percent))
    label = cut(nodes.join(near, "node", "left").select("node", F.coalesce("label", "node").alias("label")), "jaccard-labels")

    def joined(label: DataFrame, pairs: DataFrame) -> DataFrame:
        links = cut(linked(pairs, texts, n, percent), "jaccard-links")
        bridges = links.join(label.select(F.col("node").alias("a"), F.col("label").alias("la")), "a").join(label.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b")
        tops = components(bridges.select("la", "lb"), "la", "lb").select(F.col("node").alias("label"), F.col("label").alias("top"))
        return cut(label.join(tops, "label", "left").select("node", F.coalesce("top", "label").alias("label")), "jaccard-labels")

    ends = shared.select("token", "node", "n_shingles")
    pairs = cut(tiled(ends.join(label, "node"), nodes.select("node", F.col("narrow").alias("bitmap")), percent, True), "jaccard-pairs")
    # A node without a pair here has none later: components only grow, and wide bitmaps pass fewer pairs than narrow ones.
    active = cut(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "jaccard-active")
    label = joined(label, cut(bounded(pairs, nodes, percent), "jaccard-pairs"))
    ends, bitmaps = cut(ends.join(active, "node"), "jaccard-ends"), nodes.join(active, "node").select("node", "bitmap")
    for best in (True, False):
        label = joined(label, cut(tiled(ends.join(label, "node"), bitmaps, percent, best), "jaccard-pairs"))
    final = every.select("node", "least_id").join(label, "node", "left").select("node", "least_id", F.coalesce("label", "node").alias("final"))
    least = final.groupBy("final").agg(F.min("least_id").alias("component_id"))
    final = final.join(least, "final").select("node", "component_id")
    out = members.select("id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node")).join(final, "node", "left")
    return out.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component_id", "id").alias("component_id"))


def texts_of(wanted: DataFrame, source: DataFrame, n: int) -> DataFrame:
    """(node, text) of each wanted (node, place), from the row at its place that has the node's shingles.

    A bitmap of the places' hashes, of at most 8 MB whatever the number of places, holds most
    other texts back before they are moved.
    """
    buckets = 1 << min(11, max(0, (wanted.count() >> 12).bit_length()))
    spot = F.pmod(F.xxhash64("place"), F.lit(buckets << 15))
    bits = wanted.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("bits"))
    at = F.bitmap_bit_position(spot)
    byte = F.conv(F.hex(F.expr("substring(bits, cast(at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    near = source.select("place", "text", F.bitmap_bucket_number(spot).alias("bucket"), at.alias("at")).join(F.broadcast(bits), "bucket")
    near = near.where(F.floor(byte / F.pow(F.lit(2), F.col("at") % 8)) % 2 == 1).select("place", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # equal rows come one behind the other
        for batch in batches:
            own, keep = nodes_of(shingle_sets(batch.column("text").to_pylist(), n)), []
            for i, (a, b) in enumerate(zip(own.tolist(), batch.column("node").to_pylist())):
                if a == b != last:
                    keep.append(i)
                    last = b
            yield batch.take(pa.array(keep, pa.int64()))

    return near.hint("merge").join(wanted, "place").select("node", "text").mapInArrow(tidy(run), "node long, text string")


def op7_tile_jaccard(spark, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    """The component of every document of ``documents`` under links of 4-word shingles at 85 percent."""
    return jaccard_components(table(spark, sf_dir, "documents") if docs is None else docs)


ORACLE = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, CASE WHEN len(w) > 0 THEN 1 ELSE 0 END) + 1)) AS i FROM docs)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.doc_id = d.doc_id GROUP BY d.doc_id, s.n
"""
