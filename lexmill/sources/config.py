"""Taxonomies and ontologies: small YAML or JSON files that the driver reads once."""

from __future__ import annotations

import json
import re
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..operators.schema import Attribute, EntityType, ExtractionSchema, RelationType, Subtype

#: Default thresholds.
DEFAULTS = {"score_threshold": 0.5, "top_k": 3, "relevance_threshold": 0.4, "blacklist_threshold": 0.7, "scope_threshold": 0.35}


def load(path: str) -> dict:
    """A mapping from JSON, or from YAML where a YAML reader is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading YAML needs a YAML reader; JSON works without") from e
    return yaml.safe_load(text)


def hypotheses(spark: SparkSession, taxonomy: dict) -> DataFrame:
    """(kind, pos, hypothesis, threshold): topics, relevance as white, blacklist as black, scopes."""
    t = DEFAULTS | taxonomy
    rows = [("topic", i, h, t["score_threshold"]) for i, h in enumerate(t.get("labels", []))]
    if t.get("relevance_hypothesis"):
        rows.append(("white", 0, t["relevance_hypothesis"].strip(), t["relevance_threshold"]))
    rows += [("black", i, h, t["blacklist_threshold"]) for i, h in enumerate(t.get("blacklist_labels", []))]
    rows += [("scope", i, f"{k}: {h.strip()}", t["scope_threshold"]) for i, (k, h) in enumerate(t.get("scope_hypotheses", {}).items())]
    return spark.createDataFrame(rows, "kind string, pos int, hypothesis string, threshold double")


@lru_cache(maxsize=16)
def ontology(path: str) -> ExtractionSchema:
    """The extraction schema of an ontology file; raises on names that are not upper snake case, unknown end types or datatypes."""
    raw = load(path)
    parts = lambda x: {"subtypes": tuple(Subtype(**s) for s in x.get("subtypes", [])), "attributes": tuple(Attribute(**a) for a in x.get("attributes", []))}
    entities = tuple(EntityType(e["name"], e.get("description", ""), **parts(e)) for e in raw.get("entity_types", []))
    relations = tuple(RelationType(r["name"], r.get("description", ""), tuple(r.get("head_types", [])), tuple(r.get("tail_types", [])), **parts(r)) for r in raw.get("relation_types", []))
    found = ExtractionSchema(entities, relations)
    faults = [f"{x.name}: not upper snake case" for x in (*entities, *relations) if not re.fullmatch(r"[A-Z][A-Z0-9]*(_[A-Z0-9]+)*", x.name)] + found.faults()
    if faults:
        raise ValueError("; ".join(faults))
    return found
