"""Inverted lists of vectors: spherical k-means on a sample, every row in the list of its nearest centroid.

``fit`` learns centroids from at most ``SAMPLE`` rows (those of least hash), puts near ones side
by side and finds by that sample how many lists a query must probe. ``build`` puts every row into
its list and writes the lists, with the widest angle of each. ``search`` compares a query with the
rows of the lists that it probes. With ``exact`` it then goes to every other list that may hold a
nearer row: by the triangle inequality none is nearer than the angle to the centroid less the list's width.

Lists that follow one another share a slab of bounded size, a list beyond that is dealt into slabs of
its own; a query travels once to a slab, however many of its lists matter. A slab's queries go
in blocks, and a task multiplies one of each: so where no list can be left out, as among random
vectors, rows and queries travel as often as in the full product. Products in single precision
tell which pairs may count, and these are multiplied again in double precision.
Vectors of another size than the fitted one wait in a list of their own, where queries of their size meet them.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType
from pyspark.sql.window import Window

from ..shared import written
from .knn import TOP_K, leaders

SAMPLE, MOST_LISTS, ROUNDS = 16_384, 2048, 12
#: Rows of a slab: a share of all, between the least and what numbers of a slab's rows in double precision fit in the bytes.
SHARE, LEAST, SLAB = 8, 1024, 32 << 20
#: Queries and rows of a tile that are multiplied at once.
SLICE, CHUNK = 256, 2048
RECALL = 0.95
ODD = -1


@dataclass(frozen=True)
class VectorIndex:
    """``rows`` (list, id, kind, vector) once built; ``width`` by list: the cosine of its widest angle."""

    centroids: np.ndarray
    probes: int
    rows: DataFrame | None = None
    sizes: dict[int, int] | None = None
    width: np.ndarray | None = None


def unit(m: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision."""
    m = m.astype(np.float64)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def shaped(df: DataFrame, id_col: str, vector_col: str, type_col: str | None) -> DataFrame:
    """id, kind, vector; null vectors and those without length are left out. Vectors in single precision travel as they are."""
    kind = F.col(type_col).cast("string") if type_col else F.lit("")
    given = df.schema[vector_col].dataType
    number = "array<float>" if isinstance(given, ArrayType) and given.elementType == FloatType() else "array<double>"
    rows = df.where(F.col(vector_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), kind.alias("kind"), F.col(vector_col).cast(number).alias("vector"))
    return rows.where(F.exists("vector", lambda x: (x != 0) & ~F.isnan(x)))


def matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors have ``dim`` numbers, and these as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    ends = column.offsets.to_numpy()
    fits = np.flatnonzero(np.diff(ends) == dim)
    flat = column.values.to_numpy(zero_copy_only=False)
    return fits, flat[ends[fits][:, None] + np.arange(dim)] if dim else np.empty((fits.size, 0))


def centred(x: np.ndarray, lists: int, seed: int) -> np.ndarray:
    """Spherical k-means of unit rows; a centroid that loses all rows takes the row that fits worst."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), lists, replace=False)]
    for _ in range(ROUNDS):
        near = np.concatenate([(x[at : at + 4096] @ c.T).argmax(axis=1) for at in range(0, len(x), 4096)])
        fit = (x * c[near]).sum(axis=1)
        order = np.argsort(near, kind="stable")
        held, starts = np.unique(near[order], return_index=True)
        new = np.zeros_like(c)
        new[held] = np.add.reduceat(x[order], starts)
        lost = np.setdiff1d(np.arange(lists), held)
        new[lost] = x[np.argsort(fit)[: lost.size]]
        c = unit(new)
    return c


def chained(c: np.ndarray) -> np.ndarray:
    """The centroids, behind each the nearest of those left."""
    near, left, order, at = c @ c.T, np.ones(len(c), dtype=bool), [], 0
    for _ in range(len(c)):
        order.append(at)
        left[at] = False
        at = int(np.where(left, near[at], -np.inf).argmax())
    return c[order]


def fit(rows: DataFrame, *, lists: int | None = None, recall: float = RECALL, k: int = TOP_K, sample: int = SAMPLE, seed: int = 5, id_col: str = "id", vector_col: str = "vector") -> VectorIndex:
    """Centroids of the sample's most common vector size, and the probes that reach ``recall`` among the sample."""
    source = shaped(rows, id_col, vector_col, None)
    found = source.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(sample).select("vector").toArrow()["vector"]
    sizes = np.array([len(v) for v in found], dtype=np.int64)
    if not sizes.size:
        return VectorIndex(np.empty((0, 0)), 1)
    dim = int(np.bincount(sizes).argmax())
    x = unit(matrix(found, dim)[1])
    n = source.count()
    lists = max(1, min(lists or round(n**0.5), MOST_LISTS, len(x) // 8 or 1))
    c = chained(centred(x, lists, seed))
    # A few of the sample as queries: at which place among a query's lists do its nearest rows stand?
    near = (x @ c.T).argmax(axis=1)
    asked = x[:: max(1, len(x) // 256)]
    best = np.argpartition(-(asked @ x.T), min(k, len(x) - 1), axis=1)[:, :k]
    place = np.argsort(np.argsort(-(asked @ c.T), axis=1), axis=1)
    hits = np.sort(np.take_along_axis(place, near[best], axis=1).ravel())
    return VectorIndex(c, int(hits[min(hits.size - 1, int(np.ceil(recall * hits.size)))]) + 1)


def listed(df: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``df`` with ``near``: the list of each vector's nearest centroid, and the cosine."""
    shared = df.sparkSession.sparkContext.broadcast(centroids)  # MOST_LISTS rows at most

    @F.arrow_udf("struct<list:int,cos:double>")
    def near(vectors: pa.Array) -> pa.Array:
        c = shared.value
        fits, x = matrix(vectors, c.shape[1])
        lists, cos = np.full(len(vectors), ODD, dtype=np.int32), np.full(len(vectors), -1.0)
        score = unit(x) @ c.T
        lists[fits], cos[fits] = score.argmax(axis=1), score.max(axis=1)
        return pa.StructArray.from_arrays([pa.array(lists), pa.array(cos)], names=["list", "cos"])

    return df.withColumn("near", near(F.col("vector")))


def build(rows: DataFrame, index: VectorIndex, *, id_col: str = "id", vector_col: str = "vector", type_col: str | None = None) -> VectorIndex:
    """The index over every row, written to the shared folder in the order of its lists."""
    source = shaped(rows, id_col, vector_col, type_col)
    if not len(index.centroids):
        source = source.withColumns({"list": F.lit(ODD), "cos": F.lit(-1.0)})
    else:
        source = listed(source, index.centroids).withColumns({"list": F.col("near.list"), "cos": F.col("near.cos")}).drop("near")
    found = written(source.repartitionByRange("list", "id").sortWithinPartitions("list", "id"), "vector-lists")
    width = np.full(len(index.centroids), 1.0)
    sizes = {}
    for row in found.groupBy("list").agg(F.count("*").alias("n"), F.min("cos").alias("cos")).collect():  # a row per list
        sizes[row["list"]] = row["n"]
        if row["list"] != ODD:
            width[row["list"]] = row["cos"]
    return replace(index, rows=found.drop("cos"), sizes=sizes, width=width)


def packed(sizes: dict[int, int], block: int) -> dict[int, tuple[int, int]]:
    """By list: its first slab and the number of its slabs. A slab has about ``block`` rows at most."""
    out, at, room = {}, -1, 0
    for one, n in sorted(sizes.items()):
        if one == ODD or n > block:
            out[one], at, room = (at + 1, -(-n // block)), at - (-n // block), 0
        else:
            if n > room:
                at, room = at + 1, block
            out[one], room = (at, 1), room - n
    return out


class Slabs:
    """Which slabs hold the lists of an index."""

    def __init__(self, index: VectorIndex, block: int):
        self.centroids, self.angles = index.centroids, np.arccos(np.clip(index.width, -1, 1))
        self.at = packed(index.sizes, block)
        self.holds = np.zeros((len(index.centroids) + 1, sum(n for _, n in self.at.values())), dtype=np.float32)  # the last row: ODD
        for one, (first, n) in self.at.items():
            self.holds[one, first : first + n] = 1

    def of(self, lists: np.ndarray, fits: np.ndarray, done: pa.Array | None, n: int) -> pa.Array:
        """The slabs, but those in ``done``, of ``n`` queries: of ``lists`` for those that ``fits``, else where vectors of odd sizes are."""
        hit = np.repeat(self.holds[ODD:] > 0, n, axis=0)
        hit[fits] = lists.astype(np.float32) @ self.holds[:ODD] > 0
        if done is not None:
            hit[np.repeat(np.arange(n), done.value_lengths().to_numpy()), done.flatten().to_numpy()] = False
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(hit.sum(axis=1))), pa.int32()), pa.array(np.nonzero(hit)[1], pa.int32()))


def probed(vector: Column, shared, probes: int) -> Column:
    """The slabs of each vector's ``probes`` nearest lists."""

    @F.arrow_udf("array<int>")
    def slabs(vectors: pa.Array) -> pa.Array:
        plan = shared.value
        fits, x = matrix(vectors, plan.centroids.shape[1])
        score = unit(x) @ plan.centroids.T
        lists = np.zeros(score.shape, dtype=bool)
        best = score.argmax(axis=1)[:, None] if probes == 1 and score.size else np.argsort(-score, axis=1, kind="stable")[:, :probes]
        np.put_along_axis(lists, best, True, axis=1)
        return plan.of(lists, fits, None, len(vectors))

    return slabs(vector)


def unprobed(done: Column, vector: Column, least: Column, shared, digits: int) -> Column:
    """The slabs of lists that may hold a row of cosine ``least`` or more, but those in ``done``; all others where ``least`` is null."""

    @F.arrow_udf("array<int>")
    def slabs(done: pa.Array, vectors: pa.Array, scores: pa.Array) -> pa.Array:
        plan = shared.value
        fits, x = matrix(vectors, plan.centroids.shape[1])
        nearest = np.arccos(np.clip(unit(x) @ plan.centroids.T, -1, 1)) - plan.angles  # no row of the list is at a smaller angle
        least = scores.fill_null(-1.0).to_numpy(zero_copy_only=False)[fits] - 10.0**-digits  # what rounding moves
        return plan.of(nearest <= (np.arccos(np.clip(least, -1, 1)) + 1e-5)[:, None], fits, done, len(vectors))

    return slabs(done, vector, least)


def best_pairs(x: np.ndarray, y: np.ndarray, least: np.ndarray, k: int, digits: int, tighten: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each unit row of ``x`` the ``k`` best rows of ``y`` whose rounded product is ``least`` or more, of equals the first: places and product.

    Single precision is off by less than ``slack``. With ``tighten`` the first rows give a better bound than ``least``.
    """
    slack, most = (x.shape[1] + 8) * 2.0**-23 + 10.0**-digits, max(1, (4 << 20) // x.shape[1])
    small_x, small_y, out = x.astype(np.float32), y.astype(np.float32), []
    scores, flags = np.empty(SLICE * CHUNK, dtype=np.float32), np.empty(SLICE * CHUNK + 8, dtype=bool)  # written anew for each product
    for start in range(0, len(x), SLICE):
        own, floor, found = x[start : start + SLICE], least[start : start + SLICE], []
        low = (floor - slack).astype(np.float32)
        for at in range(0, len(y), CHUNK):
            n = min(CHUNK, len(y) - at)
            size = len(own) * n
            score = np.matmul(small_x[start : start + SLICE], small_y[at : at + CHUNK].T, out=scores[:size].reshape(-1, n))
            if tighten and not at and n > k:
                low = np.maximum(low, np.partition(score, n - k, axis=1)[:, n - k] - np.float32(2 * slack))
            np.greater_equal(score, low[:, None], out=flags[:size].reshape(-1, n))
            flags[size : size + 8] = False
            hit = (8 * np.flatnonzero(flags[: size // 8 * 8 + 8].view(np.uint64))[:, None] + np.arange(8)).ravel()  # eight at a time, as few are set
            hit = hit[flags[hit]]
            if hit.size > score.size // 16:  # as where there are many copies
                score = np.round(own @ y[at : at + CHUNK].T, digits)
                top = leaders(score, k)
                value = np.take_along_axis(score, top, axis=1)
                if n >= k:
                    low = np.maximum(low, (value[:, -1] - slack).astype(np.float32))
                i, j, value = np.repeat(np.arange(len(own)), top.shape[1]), top.ravel(), value.ravel()
            else:
                i, j = np.divmod(hit, n)
                value = np.concatenate([np.empty(0), *(np.einsum("ij,ij->i", own[i[p : p + most]], y[at + j[p : p + most]]) for p in range(0, hit.size, most))])
                value = np.round(value, digits)
            keep = value >= floor[i]
            found.append((i[keep], at + j[keep], value[keep]))
        i, j, value = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((j, -value, i))
        order = order[np.arange(order.size) - np.searchsorted(i[order], i[order]) < k]
        out.append((start + i[order], j[order], value[order]))
    return tuple(np.concatenate(c) for c in zip(*out))


def tiles(asked: DataFrame, index: VectorIndex, plan: Slabs, k: int, digits: int, block: int, tighten: bool) -> DataFrame:
    """query_id, id, score: of each query (id, kind, vector, slabs, least) and each of its slabs the ``k`` best rows of score ``least`` or more."""
    spark = asked.sparkSession
    asked = asked.withColumn("slab", F.explode("slabs"))
    known = {r["slab"]: -(-r["n"] // block) for r in asked.groupBy("slab").agg(F.count("*").alias("n")).collect()}  # a row per slab
    blocks = F.broadcast(spark.createDataFrame([*known.items()], "slab int, blocks int"))
    lists = F.broadcast(spark.createDataFrame([(one, *place) for one, place in plan.at.items()], "list int, first int, n int"))  # MOST_LISTS + 1 rows at most
    share = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    rows = index.rows.join(lists, "list").withColumn("slab", F.col("first") + share(F.col("n"))).join(blocks, "slab")
    rows = rows.withColumns({"block": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "role": F.lit(1), "least": F.lit(None).cast("double")})
    asked = asked.join(blocks, "slab").withColumns({"block": share(F.col("blocks")), "role": F.lit(0)})
    columns = ["slab", "block", "role", "id", "kind", "vector", "least"]

    def best(table: pa.Table) -> pa.Table:
        role, ids = table["role"].to_numpy(), table["id"].to_numpy()
        least = table["least"].combine_chunks().fill_null(-np.inf).to_numpy(zero_copy_only=False)
        sizes = np.diff(table["vector"].combine_chunks().offsets.to_numpy())
        kinds = table["kind"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        out: list[tuple] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for dim in np.unique(sizes):
            fits, x = matrix(table["vector"], int(dim))
            order = np.lexsort((ids[fits], role[fits], kinds[fits]))  # kind by kind, rows by id
            for part in np.split(order, np.flatnonzero(np.diff(kinds[fits][order])) + 1):
                q, r = part[role[fits[part]] == 0], part[role[fits[part]] == 1]
                if q.size and r.size:
                    i, j, value = best_pairs(unit(x[q]), unit(x[r]), least[fits[q]], k, digits, tighten)
                    out.append((ids[fits[q]][i], ids[fits[r]][j], value))
        columns = [np.concatenate(c) for c in zip(*out)]
        return pa.table({"query_id": pa.array(columns[0]), "id": pa.array(columns[1]), "score": pa.array(columns[2])})

    return rows.select(columns).unionByName(asked.select(columns)).groupBy("slab", "block").applyInArrow(best, "query_id long, id long, score double")


def ranked(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def search(queries: DataFrame, index: VectorIndex, *, k: int = TOP_K, exact: bool = False, probes: int | None = None, least: float | None = None, id_col: str = "id", vector_col: str = "vector", type_col: str | None = None, digits: int = 6, block: int | None = None) -> DataFrame:
    """query_id, id, score, rank as ``knn.nearest`` gives them: from the slabs of the probed lists only, or with ``exact`` from all that matter.

    ``type_col`` as at ``build``: rows of another type than the query's do not count. Null
    vectors and those without length have no row; repeated ids stand side by side. With ``least``
    only rows of that score or more are looked for; their ranks are the same.
    """
    spark = queries.sparkSession
    block = block or max(LEAST, min(SLAB // (8 * max(1, index.centroids.shape[1])), -(-sum(index.sizes.values()) // SHARE)))
    plan = Slabs(index, block)
    shared = spark.sparkContext.broadcast(plan)
    # An exact search asks the nearest list's slab first: what it finds there rules others out.
    probes = min(probes or (1 if exact else index.probes), max(1, len(index.centroids)))
    asked = shaped(queries, id_col, vector_col, type_col).withColumns({"slabs": probed(F.col("vector"), shared, probes), "least": F.lit(least).cast("double")})
    asked = written(asked, "queries")
    found = ranked(tiles(asked, index, plan, k, digits, block, True), k)
    if not exact:
        return found
    found = written(found.drop("rank"), "probed")
    bound = found.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound")).withColumnRenamed("query_id", "id")
    rest = asked.join(bound, "id", "left").withColumn("least", F.greatest("least", "bound"))
    rest = rest.withColumn("slabs", unprobed(F.col("slabs"), F.col("vector"), F.col("least"), shared, digits)).drop("bound")
    return ranked(found.union(tiles(written(rest, "unprobed"), index, plan, k, digits, block, False)), k)
