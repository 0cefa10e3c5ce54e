"""Where models plug in: functions over batches of rows, with retries, that never fail a job for one row.

A model is any callable from a list of inputs to a list of outputs, made once per task by
``build``. None is supplied; tests pass their own, and tables of scores do as well.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What to ask about two texts, by kind.
QUESTIONS = {
    "article": "¿Estos dos textos se refieren a lo mismo?",
    "entity": "¿Estas dos descripciones se refieren a la misma entidad real?",
    "relation": "¿Estas dos descripciones se refieren a la misma relación?",
}
OTHER_QUESTION = "¿Estos dos elementos son el mismo?"


def question(kind: str) -> str:
    return QUESTIONS.get(kind, OTHER_QUESTION)


def applied(rows: DataFrame, inputs: str, build: Callable[[], Callable[[list], list]], *, out: str = "answer", tries: int = 3, pause: float = 1.0) -> DataFrame:
    """Adds ``out`` (JSON text of the answer, null on failure) and ``error``. A batch is tried again with longer pauses, then row by row; behind a row that failed without pauses."""
    names = rows.columns

    def attempt(model, batch: list, tries: int = tries) -> list[tuple[str | None, str | None]]:
        for k in range(tries):
            try:
                return [(json.dumps(x, ensure_ascii=False), None) for x in model(batch)]
            except Exception as e:  # a model may raise anything
                last = f"{type(e).__name__}: {e}"
                if k + 1 < tries:
                    time.sleep(pause * 2**k)
        if len(batch) == 1:
            return [(None, last)]
        out: list[tuple[str | None, str | None]] = []
        for x in batch:
            # After a row has failed too, the next are asked once: in an outage none waits again.
            out += attempt(model, [x], tries if not out or out[-1][1] is None else 1)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = build()
        for batch in batches:
            found = attempt(model, batch.column(names.index(inputs)).to_pylist()) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([f[i] for f in found], pa.string()) for i in (0, 1))], [*names, out, "error"])

    given = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{given}, `{out}` string, error string")


def scores(rows: DataFrame, labels: list[str], build, *, text_col: str = "text", doc: str = "doc_id", template: str = "{}") -> DataFrame:
    """(doc, pos, hypothesis, score): a row per text and label; ``build()`` gives a model of (text, hypothesis) pairs to numbers."""
    asked = rows.select(doc, text_col, F.posexplode(F.array(*map(F.lit, labels))).alias("pos", "hypothesis"))
    asked = asked.withColumn("pair", F.struct(F.col(text_col).alias("text"), F.replace(F.lit(template), F.lit("{}"), F.col("hypothesis")).alias("hypothesis")))
    return applied(asked, "pair", build).select(doc, "pos", "hypothesis", F.col("answer").cast("double").alias("score"), "error")


def verdicts(pairs: DataFrame, build, kind: str = "entity") -> DataFrame:
    """(id_a, id_b, verdict) for pairs with text_a and text_b; whatever goes wrong is ``unsure``."""
    asked = pairs.withColumn("pair", F.struct(F.lit(question(kind)).alias("question"), "text_a", "text_b"))
    said = F.get_json_object(F.concat(F.lit('{"v":'), F.coalesce("answer", F.lit("null")), F.lit("}")), "$.v")
    return applied(asked, "pair", build).select("id_a", "id_b", F.when(said.isin("yes", "no", "unsure"), said).otherwise("unsure").alias("verdict"))


def rewritten(docs: DataFrame, build, *, text_col: str = "text") -> DataFrame:
    """Texts as the model rewrites them; blank ones and failures stay as they are."""
    said = F.get_json_object(F.concat(F.lit('{"v":'), F.coalesce("answer", F.lit("null")), F.lit("}")), "$.v")
    blank = F.trim(F.coalesce(text_col, F.lit(""))) == ""
    out = applied(docs, text_col, build)
    return out.withColumn(text_col, F.when(blank, F.col(text_col)).otherwise(F.coalesce(said, text_col))).drop("answer", "error")
