"""Extraction in one call: texts in chunks, a model's answers, and what of them a schema allows.

Positions in an answer count from the first entity of its chunk. They are carried over to the
document: a chunk's positions follow those of the chunks before it. A relation must point into its own chunk.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shared import written
from .adapters import applied
from .schema import ExtractionSchema, catalogue, grammar, parsed, rules
from .summarize import CHUNK, chunks


def assembled(answers: DataFrame, spec: ExtractionSchema, *, doc: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Entities (doc, pos, chunk_no and what the answer says) and relations whose ends the rules allow (doc, ord, head, tail, ...).

    ``answers``: doc, chunk_no, answer. Malformed answers have no entities and shift nothing.
    """
    read = parsed(answers.select(doc, "chunk_no", "answer"), spec).where("status = 'ok'")
    size = lambda c: F.coalesce(F.size(f"parsed.{c}"), F.lit(0))
    before = Window.partitionBy(doc).orderBy("chunk_no").rowsBetween(Window.unboundedPreceding, -1)
    sizes = read.select(doc, "chunk_no", "parsed", size("entities").alias("n"), size("relations").alias("m"))
    placed = sizes.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(before), F.lit(0)) for c in ("n", "m")})
    entities = placed.select(doc, "chunk_no", "n_before", F.posexplode("parsed.entities").alias("at", "e")).select(doc, (F.col("at") + F.col("n_before")).alias("pos"), "chunk_no", "e.*")
    own = placed_relations(placed, rules(answers.sparkSession, spec), doc, "n_before", "m_before")
    return entities, own.withColumns({c: F.col(c) + F.col("n_before") for c in ("head", "tail")}).withColumn("ord", F.col("ord") + F.col("m_before")).drop("n_before", "m_before")


def placed_relations(read: DataFrame, allowed: DataFrame, *keep: str) -> DataFrame:
    """``keep``, ord and each relation of the parsed answers whose ends are positions of its own answer's entities with types that the rules allow.

    The ends are looked up within the answer's row: what ``valid_relations`` joins for tables of their own.
    """
    each = read.select(*keep, F.col("parsed.entities").alias("_e"), F.posexplode("parsed.relations").alias("ord", "r")).select(*keep, "_e", F.col("ord").cast("long").alias("ord"), "r.*")
    end = lambda c: F.get("_e", F.when(F.col(c).between(0, F.size("_e") - 1), F.col(c)).cast("int"))
    named = each.withColumns({f"_{c}": end(c) for c in ("head", "tail")}).where("_head IS NOT NULL AND _tail IS NOT NULL")
    named = named.withColumns({f"{c}_{x}": F.col(f"_{c}.{x}") for c in ("head", "tail") for x in ("type", "name")}).drop("_e", "_head", "_tail")
    ruled = named.join(F.broadcast(allowed), "type")  # a row a declared relation
    ruled = ruled.where(F.array_contains("head_types", F.col("head_type")) & F.array_contains("tail_types", F.col("tail_type")))
    return ruled.drop("head_types", "tail_types")


def asked(docs: DataFrame, spec: ExtractionSchema, build, *, tries: int = 2, size: int = CHUNK, id_col: str = "doc_id", text_col: str = "text", pause: float = 1.0) -> DataFrame:
    """doc, chunk_no, answer, error, status: a model's answer to every chunk; malformed ones are asked again, ``tries`` times in all.

    ``build()`` gives a model of structs (system, user, grammar) to answers, objects or JSON text.
    """
    prompt = F.struct(F.lit(catalogue(spec)).alias("system"), F.col(text_col).alias("user"), F.lit(json.dumps(grammar(spec))).alias("grammar"))
    left = chunks(docs, id_col=id_col, text_col=text_col, size=size).withColumnRenamed("text", text_col)
    done = None
    for k in range(tries):
        got = applied(left.withColumn("prompt", prompt), "prompt", build, pause=pause).drop("prompt")
        # A model that answers with text answers with JSON text.
        text = F.when(F.col("answer").startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), "answer", F.lit("}")), "$.v")).otherwise(F.col("answer"))
        got = written(parsed(got.withColumn("answer", text), spec).drop("parsed"), "asked")
        final = got if k + 1 == tries else got.where("status = 'ok'")
        done = final if done is None else done.unionByName(final)
        left = got.where("status <> 'ok'").select(id_col, "chunk_no", text_col)
    return done.select(id_col, "chunk_no", "answer", "error", F.when(F.col("error").isNotNull(), "error").otherwise(F.col("status")).alias("status"))


def extract(docs: DataFrame, spec: ExtractionSchema, build, *, tries: int = 2, size: int = CHUNK, id_col: str = "doc_id", text_col: str = "text", pause: float = 1.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities and relations of the documents, as ``assembled`` gives them, and the status of every chunk."""
    answers = written(asked(docs, spec, build, tries=tries, size=size, id_col=id_col, text_col=text_col, pause=pause), "extracted")
    return *assembled(answers, spec, doc=id_col), answers.select(id_col, "chunk_no", "status", "error")
