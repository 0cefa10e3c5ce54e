"""The prefix trie of conversations by Patricia construction.

A turn is known by the digest of its role and text, a conversation by the digests of its
turns side by side, its key; texts never travel. Equal keys are folded. The keys are sorted
by range, and every part of the range builds its own compressed tree from the common
prefixes of neighbours: only branch, end and leaf points are made, and counts, least ids,
leaves and saved bytes are summed from point to point. When a point closes, the unary nodes
of the edge above it are given out; what they save are suffix sums along the edge.

Parts share nodes only along the prefix that the last key of one has in common with the
first key of the next. All figures of such open nodes are sums (a node shared with the part
before counts as that part's), so that their pieces are added up at the end; all others are
final at once. A part's memory is the path to its present key and the children of open points.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, small_batches, table, tidy

DIGEST = 16
#: Conversations whose ids leave the same remainder below FAMILY are rebuilt on the first of them, by fewer than HEADS turns.
FAMILY, HEADS = 5, 9
#: Characters of a run of ids that is hashed at once.
RUN = 1 << 16
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turn_digest(role: Column, text: Column) -> Column:
    """Hexadecimal digest of a turn; the role's length keeps role and text apart."""
    return F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))


def sequences(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """id and ``turns``, the digests and text bytes of each conversation in order, null turns first, equal ones by digest."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    rows = turns.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.struct(F.col(turn_col).cast("long").alias("turn"), turn_digest(role, text).alias("digest"), F.octet_length(text).cast("long").alias("bytes")).alias("t"))
    ordered = F.sort_array(F.collect_list("t"))  # a conversation's own turns
    return rows.groupBy("id").agg(F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))


def rebuilt(own: DataFrame) -> DataFrame:
    """Every conversation with its first turns taken from the first of its family."""
    base = F.col("id") - F.col("id") % FAMILY
    heads = own.where(F.col("id") % FAMILY == 0).select(F.col("id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("id").cast("string").cast("binary")) % HEADS).cast("int")
    both = own.withColumn("base", base).join(heads, "base", "left").withColumn("h", h)
    head = F.slice(F.coalesce("head", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    return both.select("id", F.concat(head, F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def folded(convs: DataFrame) -> DataFrame:
    """A row per distinct sequence: key, sizes, n, conv (the least id) and ends (the digest of all ids)."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    keyed = convs.select("id", key.alias("key"), F.transform("turns", lambda t: t["bytes"]).alias("sizes"))
    keyed = cut(keyed.withColumn("name", F.md5("key")), "conversations")
    once = keyed.groupBy("name").agg(F.first("key").alias("key"), F.first("sizes").alias("sizes"), F.count("*").alias("n"), F.min("id").alias("conv"))
    return once.join(ids_digest(keyed.select("name", "id")), "name").drop("name")


def ids_digest(members: DataFrame) -> DataFrame:
    """name and ends, the SHA-256 of its ids in order. The ids of a name of any size are sorted and written out in many tasks; one then hashes the runs."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = []
            for name, own in zip(batch.column("name").to_pylist(), batch.column("id").to_pylist()):
                if out and out[-1][0] == name and out[-1][3] < RUN:
                    out[-1][2].append(text := str(own))
                    out[-1][3] += len(text) + 1
                else:
                    out.append([name, own, [str(own)], 0])
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()), pa.array([",".join(o[2]) for o in out], pa.string())], ["name", "first", "run"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, hashlib.sha256()
        for batch in batches:
            out = []
            for name, run in zip(batch.column("name").to_pylist(), batch.column("run").to_pylist()):
                if name == at:
                    digest.update(b",")
                else:
                    if at is not None:
                        out.append((at, digest.hexdigest()))
                    at, digest = name, hashlib.sha256()
                digest.update(run.encode())
            yield rows(out)
        yield rows([(at, digest.hexdigest())] if at is not None else [])

    def rows(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in range(2)], ["name", "ends"])

    written = members.repartitionByRange("name", "id").sortWithinPartitions("name", "id").mapInArrow(runs, "name string, first long, run string")
    return written.repartition("name").sortWithinPartitions("name", "first").mapInArrow(hashed, "name string, ends string")


def common(a: bytes, b: bytes) -> int:
    """How many turns two keys share at their start."""
    n = min(len(a), len(b))
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    differ = x != y
    return int(differ.argmax() if differ.any() else n) // DIGEST


class Point:
    """A branch, end or leaf of a part's compressed tree, with the sums of its subtree."""

    __slots__ = ("depth", "first", "n", "conv", "leaves", "children", "parted", "saved", "ends", "waiting")

    def __init__(self, depth: int, first: bool):
        self.depth, self.first = depth, first
        self.n = self.leaves = self.children = self.saved = 0
        self.conv: int | None = None
        self.parted, self.ends = False, None
        self.waiting: list[list] = []  # rows of children that want this point's least id


class Part:
    """Builds the tree of one part from its keys in order and gives its nodes out.

    A row: node and up (names of an open node, of an open parent), conv, depth, parent's conv,
    n, children, leaves, saved, ends.
    """

    def __init__(self, before: bytes | None, after: bytes | None):
        self.before, self.after = before, after
        self.shared = -1  # depth up to which the part before has the nodes of the first key
        self.path: list[Point] = [Point(0, True)]
        self.key: bytes | None = None
        self.sizes: np.ndarray = np.empty(0, np.int64)
        self.rows: list[list] = []

    def add(self, key: bytes, sizes: list[int], n: int, conv: int, ends: str) -> None:
        if self.key is None:
            self.shared = -1 if self.before is None else common(self.before, key)
        else:
            self.close(common(self.key, key), -1)
        top, depth = self.path[-1], len(key) // DIGEST
        if top.depth < depth:
            self.path.append(top := Point(depth, self.key is None))
        top.n += n
        top.conv = conv if top.conv is None else min(top.conv, conv)
        top.ends = ends
        self.key, self.sizes = key, np.array(sizes, dtype=np.int64)

    def close(self, depth: int, ahead: int) -> None:
        """Close all points below ``depth``. The nodes down to ``ahead`` go on in the next part."""
        while self.path[-1].depth > depth:
            q = self.path.pop()
            if self.path[-1].depth < depth:
                self.path.append(Point(depth, q.first))
            self.edge(q, self.path[-1], ahead)

    def edge(self, q: Point, p: Point, ahead: int) -> None:
        low = max(self.shared if q.first else -1, ahead)  # nodes are open down to here
        owned = np.arange(p.depth + 1, q.depth + 1) > (self.shared if q.first else -1)
        if not q.parted and q.depth > low:
            q.leaves += 1
        saved = q.saved + np.cumsum((self.sizes[p.depth : q.depth] * (q.n - owned))[::-1])[::-1]
        names = self.names(min(low, q.depth), p.depth)
        for row in q.waiting:
            if q.depth <= low:
                row[1] = names[q.depth]
            else:
                row[4] = q.conv
            self.rows.append(row)
        for d in range(q.depth, p.depth, -1):
            last = d == q.depth
            row = [names.get(d) if d <= low else None, None, q.conv, d, None, q.n, q.children if last else int(owned[d - p.depth]), q.leaves, int(saved[d - p.depth - 1]), q.ends if last else None]
            if d - 1 <= low:
                row[1] = names[d - 1]
                self.rows.append(row)
            elif d - 1 > p.depth:
                row[4] = q.conv
                self.rows.append(row)
            else:
                p.waiting.append(row)
        p.n += q.n
        p.conv = q.conv if p.conv is None else min(p.conv, q.conv)
        p.leaves += q.leaves
        p.saved += int(saved[0])
        p.children += int(owned[0])
        p.parted = True

    def names(self, low: int, above: int) -> dict[int, bytes]:
        """The names of the present key's nodes from depth ``above`` down to ``low``."""
        digest, out = xxhash.xxh3_128(), {}
        for d in range(low + 1):
            if d:
                digest.update(self.key[DIGEST * (d - 1) : DIGEST * d])
            if d >= above:
                out[d] = digest.digest()
        return out

    def end(self) -> list[list]:
        """The last rows, the root's among them."""
        if self.key is None:
            return self.taken()
        self.close(0, -1 if self.after is None else common(self.key, self.after))
        root = self.path[0]
        alone = self.before is None and self.after is None
        name = None if alone else xxhash.xxh3_128().digest()
        for row in root.waiting:
            row[1 if name else 4] = name or root.conv
            self.rows.append(row)
        leaf = int(not root.parted and self.after is None)
        self.rows.append([name, None, root.conv, 0, None, root.n, root.children, root.leaves + leaf, root.saved, root.ends])
        return self.taken()

    def taken(self) -> list[list]:
        out, self.rows = self.rows, []
        return out


KINDS = {"node": pa.binary(), "up": pa.binary(), "conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64(), "ends": pa.string()}


def pieces(sorted_keys: DataFrame) -> DataFrame:
    """The nodes of every part; those with a ``node`` are open and have pieces in several parts."""
    bounds = sorted_keys.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    beside = Window.orderBy("part")  # a row per part
    heads = bounds.select("part", F.lag("high").over(beside).alias("before"), F.lead("low").over(beside).alias("after"), F.lit(True).alias("head"))
    rows = heads.unionByName(sorted_keys.withColumn("head", F.lit(False)), allowMissingColumns=True)
    rows = rows.repartition("part").sortWithinPartitions("part", F.desc("head"), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["head"]:
                    out += part.end() if part else []
                    part = Part(row["before"], row["after"])
                else:
                    part.add(row["key"], row["sizes"], row["n"], row["conv"], row["ends"])
            yield given(out + part.taken())
        yield given(part.end() if part else [])

    def given(out: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(KINDS.values())], [*KINDS])

    kinds = {"binary": "binary", "int64": "long", "string": "string"}
    return rows.mapInArrow(tidy(run), ", ".join(f"{c} {kinds[str(t)]}" for c, t in KINDS.items()))


def prefix_trie(convs: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of every node.

    ``convs``: id and ``turns`` (digest, bytes). A conversation without turns ends at the root;
    without conversations there is no node. A conversation's key is one value: 16 bytes a turn.
    """
    small_batches(convs.sparkSession, rows=2000, mb=8)
    distinct = cut(folded(convs), "distinct-conversations")
    ordered = distinct.repartitionByRange("key").sortWithinPartitions("key").withColumn("part", F.spark_partition_id())
    found = cut(pieces(cut(ordered, "sorted-conversations")), "trie")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    shared = cut(found.where("node is not null").groupBy("node", "depth").agg(F.first("up").alias("up"), F.min("conv_id").alias("conv_id"), F.max("ends").alias("ends"), *sums), "open-nodes")
    # The parents that are open stand in few parts' paths; a parent of very many children is dealt out by the join's skew handling.
    tops = shared.select(F.col("node").alias("up"), F.col("conv_id").alias("top"))
    rest = ["up", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    below = found.where("node is null and up is not null").select(rest).union(shared.where("up is not null").select(rest))
    joined = below.join(tops, "up").withColumnRenamed("top", "parent_conv_id").drop("up")
    final = found.where("node is null and up is null").drop("node", "up").unionByName(joined)
    final = final.unionByName(shared.where("up is null").drop("node", "up").withColumn("parent_conv_id", F.lit(None).cast("long")))
    return final.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))


def conversation_trie(turns: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", rebuild: bool = True) -> DataFrame:
    """The trie of a table of turns, of rebuilt conversations unless ``rebuild`` is false.

    Null roles and texts are empty ones; rows without ``id_col`` belong to no conversation;
    null turns come first, turns of one number in the order of their digests; repeated rows are
    turns of their own; other columns are ignored; an empty table gives an empty trie.
    """
    own = sequences(turns, id_col=id_col, turn_col=turn_col, role_col=role_col, text_col=text_col)
    if rebuild:
        own = rebuilt(cut(own, "turns"))
    return prefix_trie(own)


def op12_conversation_trie(spark, sf_dir: str, turns: DataFrame | None = None) -> DataFrame:
    """Every node of the trie of ``conversations``."""
    return conversation_trie(table(spark, sf_dir, "conversations") if turns is None else turns)


#: CRC-32 comes from its table, which the first step builds bit by bit.
ORACLE = f"""
WITH crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
turns AS (
  SELECT conv_id, list({{'d': d, 'b': strlen(text)::BIGINT}} ORDER BY turn NULLS FIRST, d) AS own
  FROM (SELECT conv_id, turn, text, md5(length(role)::VARCHAR || ':' || role || text) AS d
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL))
  GROUP BY conv_id),
heads AS (
  SELECT conv_id, own, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {HEADS} AS h FROM turns, crc),
seqs AS (
  SELECT a.conv_id, list_concat(CASE WHEN a.h = 0 THEN [] ELSE coalesce(b.own[1:a.h], []) END, a.own[a.h + 1:]) AS s FROM heads a LEFT JOIN turns b ON b.conv_id = a.conv_id - a.conv_id % {FAMILY}),
members AS (
  SELECT conv_id, d AS depth, md5(array_to_string([x.d for x in s[1:d]], '')) AS node, md5(array_to_string([x.d for x in s[1:d - 1]], '')) AS up,
         CASE WHEN d = 0 THEN 0 ELSE s[d].b END AS bytes, d = len(s) AS ends
  FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT node, depth, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM members GROUP BY node, depth),
kids AS (SELECT up, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
tree AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.up = n.node AND k.depth = n.depth),
sums AS (
  SELECT m.node, m.depth, sum(CASE WHEN t.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((t.n_convs - 1) * t.bytes)::BIGINT AS saved_tokens
  FROM tree t JOIN members m ON m.conv_id = t.conv_id AND m.depth <= t.depth GROUP BY ALL)
SELECT t.conv_id, t.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, t.n_convs::BIGINT AS n_convs, t.n_children::BIGINT AS n_children, s.n_leaves, s.saved_tokens, t.ends_sha256
FROM tree t JOIN sums s ON s.node = t.node AND s.depth = t.depth LEFT JOIN tree p ON t.depth > 0 AND p.node = t.up AND p.depth = t.depth - 1
"""
