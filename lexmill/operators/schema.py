"""Extraction schemas: what entities and relations a caller wants, as Spark types, a JSON grammar and rule tables."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPARK_TYPES = {"string": T.StringType(), "number": T.DoubleType(), "boolean": T.BooleanType()}


@dataclass(frozen=True)
class Attribute:
    name: str
    datatype: str = "string"
    description: str = ""


@dataclass(frozen=True)
class Subtype:
    name: str
    description: str = ""


@dataclass(frozen=True)
class EntityType:
    name: str
    description: str = ""
    subtypes: tuple[Subtype, ...] = ()
    attributes: tuple[Attribute, ...] = ()


@dataclass(frozen=True)
class RelationType:
    name: str
    description: str = ""
    head_types: tuple[str, ...] = ()
    tail_types: tuple[str, ...] = ()
    subtypes: tuple[Subtype, ...] = ()
    attributes: tuple[Attribute, ...] = ()


@dataclass(frozen=True)
class ExtractionSchema:
    entity_types: tuple[EntityType, ...] = field(default=())
    relation_types: tuple[RelationType, ...] = field(default=())

    def key(self) -> str:
        """A digest of the canonical JSON; equal schemas have equal keys."""
        return hashlib.sha1(json.dumps(asdict(self), sort_keys=True, default=str).encode()).hexdigest()

    def faults(self) -> list[str]:
        """Undeclared end types and unknown datatypes."""
        known = {e.name for e in self.entity_types}
        ends = [f"{r.name}: {e} is no entity type" for r in self.relation_types for e in (*r.head_types, *r.tail_types) if e not in known]
        kinds = [f"{x.name}.{a.name}: {a.datatype}" for x in (*self.entity_types, *self.relation_types) for a in x.attributes if a.datatype not in SPARK_TYPES]
        return ends + kinds


#: The words of these answers and texts are fixed values: callers receive them.
def _closed(required: dict) -> dict:
    return {"type": "object", "additionalProperties": False, "required": [*required], "properties": required}


def _alternatives(kinds, ends: dict) -> dict:
    """An array of one closed object per type; of no type, an array that must be empty."""
    if not kinds:
        return {"type": "array", "maxItems": 0}
    branches = []
    for k in kinds:
        subtype = {"anyOf": [{"type": "string", "enum": [s.name for s in k.subtypes]}, {"type": "null"}]} if k.subtypes else {"type": "null"}
        attributes = {"type": "object", "additionalProperties": False, "properties": {a.name: {"type": a.datatype} for a in k.attributes}}
        branches.append(_closed(ends | {"type": {"const": k.name}, "subtype": subtype, "evidence_text": {"type": "string"}, "attributes": attributes, "confidence": {"type": "number"}}))
    return {"type": "array", "items": {"oneOf": branches}}


def grammar(schema: ExtractionSchema) -> dict:
    """The JSON schema of an answer: reasoning first, then entities and relations by position of their ends."""
    text, number = {"type": "string"}, {"type": "integer"}
    return _closed({"reasoning": text, "entities": _alternatives(schema.entity_types, {"name": text, "mention_text": text}), "relations": _alternatives(schema.relation_types, {"head": number, "tail": number})})


def catalogue(schema: ExtractionSchema) -> str:
    """The types as indented text; subtypes of relations are not listed."""

    def entry(head: str, x, subtypes: bool) -> list[str]:
        lines = [f"- {head}"]
        lines += [f"    subtipo {s.name}: {s.description}" for s in x.subtypes] if subtypes else []
        return lines + [f"    atributo {a.name} ({a.datatype}): {a.description}" for a in x.attributes]

    lines = ["ENTIDADES"]
    for e in schema.entity_types:
        lines += entry(f"{e.name}: {e.description}", e, True)
    lines.append("RELACIONES")
    for r in schema.relation_types:
        lines += entry(f"{r.name}: {r.description} [sujeto: {', '.join(r.head_types)}; objeto: {', '.join(r.tail_types)}]", r, False)
    return "\n".join(line.rstrip() for line in lines)


def answer_type(schema: ExtractionSchema) -> T.StructType:
    """What ``from_json`` reads an answer with; attributes of all types side by side, first declaration wins."""

    def attributes(kinds) -> T.StructType:
        found: dict[str, T.DataType] = {}
        for k in kinds:
            for a in k.attributes:
                found.setdefault(a.name, SPARK_TYPES[a.datatype])
        return T.StructType([T.StructField(n, t) for n, t in found.items()])

    text = lambda *names: [T.StructField(n, T.StringType()) for n in names]
    tail = lambda kinds: [*text("type", "subtype", "evidence_text"), T.StructField("attributes", attributes(kinds)), T.StructField("confidence", T.DoubleType())]
    ends = [T.StructField(n, T.LongType()) for n in ("head", "tail")]
    return T.StructType([*text("reasoning"), T.StructField("entities", T.ArrayType(T.StructType(text("name", "mention_text") + tail(schema.entity_types)))), T.StructField("relations", T.ArrayType(T.StructType(ends + tail(schema.relation_types))))])


def parsed(answers: DataFrame, schema: ExtractionSchema, *, json_col: str = "answer") -> DataFrame:
    """Adds ``parsed`` and ``status``: ok, or malformed where the text is no such JSON."""
    out = answers.withColumn("parsed", F.from_json(F.col(json_col), answer_type(schema), {"mode": "PERMISSIVE"}))
    bad = F.col("parsed").isNull() | (F.col("parsed.entities").isNull() & F.col("parsed.relations").isNull())
    return out.withColumn("status", F.when(bad, "malformed").otherwise("ok"))


def rules(spark: SparkSession, schema: ExtractionSchema) -> DataFrame:
    """type, head_types, tail_types of the declared relations, the last declaration of a name."""
    by = {r.name: (r.name, list(r.head_types), list(r.tail_types)) for r in schema.relation_types}
    return spark.createDataFrame([*by.values()], "type string, head_types array<string>, tail_types array<string>")


def flat_entities(answers: DataFrame, doc: str = "doc_id") -> DataFrame:
    return answers.select(doc, F.posexplode("parsed.entities").alias("pos", "e")).select(doc, F.col("pos").cast("long").alias("pos"), "e.*")


def flat_relations(answers: DataFrame, doc: str = "doc_id") -> DataFrame:
    return answers.select(doc, F.posexplode("parsed.relations").alias("ord", "r")).select(doc, F.col("ord").cast("long").alias("ord"), "r.*")


def storage_type(schema: ExtractionSchema) -> T.StructType:
    """A table for all entity types: fixed columns, then one per declared attribute name."""
    base = [T.StructField(n, T.StringType()) for n in ("id", "doc_id", "name", "type", "subtype", "description")]
    seen = {f.name for f in base}
    for k in (*schema.entity_types, *schema.relation_types):
        for a in k.attributes:
            if a.name not in seen:
                seen.add(a.name)
                base.append(T.StructField(a.name, SPARK_TYPES[a.datatype]))
    return T.StructType(base)


def append_version(rows: DataFrame, spec: ExtractionSchema, path: str, version: int) -> None:
    """Write rows of the storage schema as a version of the table at ``path``; columns that rows lack are null, a version that is written again is replaced."""
    kind = storage_type(spec)
    have = {f.name for f in rows.schema}
    full = rows.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in kind))
    full.write.mode("overwrite").parquet(f"{path}/version={version}")


def read_versions(spark: SparkSession, path: str, spec: ExtractionSchema | None = None) -> DataFrame:
    """All versions as one table: attributes that a later schema has are null in rows of an earlier one; ``version`` tells them apart.

    With ``spec`` the table has its columns first, with their types, also those that no file has yet.
    """
    rows = spark.read.option("mergeSchema", True).parquet(path)
    if spec is None:
        return rows
    kind = storage_type(spec)
    known = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kind]
    return rows.select(*known, *(c for c in rows.columns if c not in kind.fieldNames()))


def attribute(col: Column, name: str) -> Column:
    return F.coalesce(F.element_at(col, name), F.lit(""))
