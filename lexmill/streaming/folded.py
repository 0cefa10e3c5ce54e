"""An index of articles in runs that fold by size: ingestion that stays cheap, and few files to read.

Every batch is merged within itself and written as a run of level 0. When a level has ``FAN``
runs they are merged into one of the next level, so an article is written anew once a level and
the live runs are bounded by ``FAN`` times the logarithm of the number of batches. What is
live, and the last batch, stand in a manifest; a new one is written under the next number and
readers take the highest. A run counts from the manifest on that names it: a batch that fails
or comes twice, or a fold that fails, leaves at most files that no manifest names.

Runs carry key, ord, sources, urls, date, signature and vector. A batch's articles are
looked up in the index's recent window before they are written: a near copy takes the key
of the article that it copies, and a link between two of one batch joins both.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..operators.merge import merge_articles, merge_turns
from ..operators.similarity import CUT, banded_pairs, first_recent
from ..shared import shared_folder, written
from ..sources.tables import newest
from .recent import WINDOW

FAN = 4
RUN = "key string, ord long, sources array<string>, urls array<string>, date date, signature array<long>, vector array<float>, turn long"


class FoldedIndex:
    """The index below ``folder``. One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, folder: str, *, fan: int = FAN, window: int = WINDOW, cut: float | None = CUT):
        self.spark, self.folder, self.fan, self.window, self.cut = spark, folder, fan, window, cut

    # The manifest

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/manifest")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def manifest(self) -> dict:
        """number, batch (the last one written) and runs (name, level, turn) of the newest manifest."""
        fs, path = self._files()
        top = path(f"{self.folder}/manifest")
        names = [s.getPath().getName() for s in fs.listStatus(top)] if fs.exists(top) else []
        numbers = [int(n[:-5]) for n in names if n.endswith(".json")]
        if not numbers:
            return {"number": 0, "batch": -1, "runs": []}
        rows = self.spark.read.text(f"{self.folder}/manifest/{max(numbers):010d}.json").collect()
        return json.loads(rows[0]["value"])

    def commit(self, batch: int, runs: list[dict], after: int) -> None:
        """A new manifest under the number behind ``after``; it appears whole or, where that number is taken, not at all."""
        fs, path = self._files()
        own, final = path(f"{self.folder}/manifest/.{uuid.uuid4().hex}"), path(f"{self.folder}/manifest/{after + 1:010d}.json")
        out = fs.create(own, False)
        out.write(bytearray(json.dumps({"number": after + 1, "batch": batch, "runs": runs}).encode()))
        out.close()
        if fs.exists(final) or not fs.rename(own, final):
            fs.delete(own, False)
            raise RuntimeError(f"manifest {after + 1} was written by another")

    # Runs

    def rows(self, runs: list[dict] | None = None) -> DataFrame:
        """The rows of the live runs, not merged."""
        runs = self.manifest()["runs"] if runs is None else runs
        if not runs:
            return self.spark.createDataFrame([], RUN)
        return self.spark.read.schema(RUN).parquet(*(f"{self.folder}/runs/{r['name']}" for r in runs))

    def latest(self) -> DataFrame:
        """The index: a row a key."""
        return merged(self.rows()).drop("turn")

    def write(self, rows: DataFrame, level: int, turn: int) -> dict:
        name = f"{level}-{turn:010d}-{uuid.uuid4().hex[:12]}"
        rows.select(*(c.split()[0] for c in RUN.split(", "))).write.parquet(f"{self.folder}/runs/{name}")
        return {"name": name, "level": level, "turn": turn}

    def append(self, articles: DataFrame, batch: int) -> None:
        """Articles (key, ord, source, url, date, signature, vector) as the run of ``batch``; a batch that is in changes nothing."""
        now = self.manifest()
        if batch <= now["batch"]:
            return
        rows = written(articles, "batch")
        if self.cut is not None:
            rows = self.renamed(rows)
        signs = rows.groupBy("key").agg(F.min_by(F.struct("signature", "vector"), F.col("ord")).alias("own"))
        new = merge_articles(rows, "key").join(signs, "key").select("key", "ord", "sources", "urls", "date", "own.*", F.lit(batch).cast("long").alias("turn"))
        self.commit(batch, [*now["runs"], self.write(new, 0, batch)], now["number"])
        self.fold()

    def fold(self) -> None:
        """Merge the runs of every level that has ``fan`` of them; each fold is a manifest of its own."""
        while True:
            now = self.manifest()
            levels: dict[int, list[dict]] = {}
            for run in now["runs"]:
                levels.setdefault(run["level"], []).append(run)
            full = [level for level, runs in levels.items() if len(runs) >= self.fan]
            if not full:
                return
            old = levels[min(full)]
            turn = min(r["turn"] for r in old)
            run = self.write(merged(self.rows(old)).withColumn("turn", F.lit(turn).cast("long")), min(full) + 1, turn)
            self.commit(now["batch"], [*(r for r in now["runs"] if r not in old), run], now["number"])

    def renamed(self, rows: DataFrame) -> DataFrame:
        """A batch's rows under the key of what they copy: the newest near copy of the recent window, else the first of the batch's own."""
        recent = merged(self.rows()).where(F.size("signature") > 0).select(F.col("ord").alias("id"), "signature", "date", F.col("key").alias("of"))
        recent = written(newest(recent, self.window), "window")
        heads = written(rows.groupBy("key").agg(F.min("ord").alias("id"), F.min_by("signature", "ord").alias("signature")).where(F.size("signature") > 0), "heads")
        met = first_recent(heads.select("id", "signature"), recent, cut=self.cut).where("match is not null").join(recent.select(F.col("id").alias("match"), "of"), "match").select("id", "of")
        own = connected_components(heads.select("id"), banded_pairs(heads.select("id", "signature"), cut=self.cut))
        label = own.join(met, "id", "left").join(heads.select("id", "key"), "id")
        # One that copies an indexed article brings its whole component there, the first such one if there are several.
        top = label.groupBy("cluster_id").agg(F.coalesce(F.min_by("of", F.when(F.col("of").isNotNull(), F.col("id"))), F.min_by("key", "id")).alias("to"))
        names = label.join(top, "cluster_id").select("key", "to")
        return rows.join(names, "key", "left").withColumn("key", F.coalesce("to", "key")).drop("to")


def merged(rows: DataFrame) -> DataFrame:
    """One row a key: what an earlier turn has comes first, signature and vector are the first article's."""
    first = rows.groupBy("key").agg(F.min_by(F.struct("signature", "vector"), F.struct("turn", "ord")).alias("own"), F.min("turn").alias("turn"))
    return merge_turns(rows, "key").join(first, "key").select("key", "ord", "sources", "urls", "date", "own.*", "turn")


def ingest(stream: DataFrame, index: FoldedIndex, prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> None:
    """A stream of articles into the index, a run a micro-batch."""
    query = stream.writeStream.foreachBatch(lambda batch, number: index.append(prepare(batch), number)).option("checkpointLocation", f"{index.folder}/_checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def folded_articles(spark: SparkSession, sf_dir: str, *, batches: int = 20, near: bool = False) -> FoldedIndex:
    """``documents`` streamed in so many batches, in the order of their ids, into a new index; with ``near`` near copies are one article."""
    from ..operators.similarity import signatures, shingle_sets
    from ..plans.catalogue import articles_of
    from .recent import arrivals

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = articles_of(docs).withColumnRenamed("text_key", "key").where("key is not null")
    none = F.lit(None).cast("array<float>").alias("vector")
    if near:
        signed = signatures(shingle_sets(docs.where("text is not null"))).withColumnRenamed("id", "ord")
        rows = rows.join(signed, "ord").select("key", "ord", "source", "url", "date", "signature", none)
    else:
        rows = rows.select("key", "ord", "source", "url", "date", F.lit(None).cast("array<long>").alias("signature"), none)
    folder = shared_folder(spark, "folded")
    index = FoldedIndex(spark, folder, cut=CUT if near else None)
    ingest(arrivals(written(rows.withColumn("seq", F.col("ord")), "articles"), folder, batches), index)
    return index
