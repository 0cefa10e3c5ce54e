"""From spans to places: union of spans, types, entries, cities, streets, and the order they come out in.

Each step is a join or a grouping over all documents. Score tables stand for the models that
are asked where the gazetteer leaves a choice; where a score is missing, the first choice stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..shared import written
from .fuzzy import LEAST
from .places import CANDIDATES, edge_list, homonyms, key_classes, leading, looked_up, matched_city, most_populous, nearest_city, output_order, span_types, streets_in_cities, uncovered

#: The types that a score table's positions stand for.
ASKED = ("region", "city", "location")
COLUMNS = ("doc_id", "ord", "text", "type", "name", "geonames_id", "admin1_code", "city_id", "city_name", "edge_ids", "lat", "lon", "confidence")


def span_union(tagged: DataFrame, streets: DataFrame, label: str = "LOC") -> DataFrame:
    """The tagger's spans of one label, then the street names that begin and end in none of them; ``ord`` from 0.

    ``tagged``: doc_id, text, label, start_char, end_char; ``streets``: as ``street_spans`` gives them.
    Equal spans stay; a null label is another label.
    """
    kept = tagged.where(F.col("label") == label)
    both = kept.select("doc_id", "text", "start_char", "end_char", F.lit("").alias("hint"), F.lit(0).alias("source"))
    both = both.unionByName(uncovered(streets, kept).select("doc_id", "text", "start_char", "end_char", "hint", F.lit(1).alias("source")))
    order = Window.partitionBy("doc_id").orderBy("source", "start_char", "end_char", "text")
    return both.select("doc_id", (F.row_number().over(order) - 1).alias("ord"), "text", "start_char", "end_char", "hint")


def decided(types: DataFrame, scores: DataFrame | None) -> DataFrame:
    """Types without ``ask``: the best scored of ``ASKED`` (doc_id, ord, pos, score; ties by position), else region."""
    if scores is None:
        said = types.select("doc_id", "ord").limit(0).withColumn("said", F.lit(0))
    else:
        said = scores.groupBy("doc_id", "ord").agg(F.max_by("pos", F.struct("score", -F.col("pos"))).alias("said"))
    asked = F.element_at(F.array(*map(F.lit, ASKED)), F.coalesce(F.col("said"), F.lit(0)).cast("int") + 1)
    return types.join(said, ["doc_id", "ord"], "left").withColumn("type", F.when(F.col("type") == "ask", asked).otherwise(F.col("type"))).drop("said")


def chosen_city(candidates: DataFrame, scores: DataFrame | None) -> DataFrame:
    """Of each span's candidates the one with the best score (doc_id, ord, name, score), ties by rank; ``confidence`` is 1 for a single candidate, 0 where none is scored."""
    rows = candidates.withColumn("n", F.count("*").over(Window.partitionBy("doc_id", "ord")))
    rows = rows.withColumn("score", F.lit(None).cast("double")) if scores is None else rows.join(scores.select("doc_id", "ord", "name", "score"), ["doc_id", "ord", "name"], "left")
    top = F.max_by(F.struct("entry_id", "name", "lat", "lon", "score", "n"), F.struct(F.coalesce("score", F.lit(float("-inf"))), -F.col("rank")))
    found = rows.groupBy("doc_id", "ord").agg(top.alias("t")).select("doc_id", "ord", "t.*")
    return found.withColumn("confidence", F.when(F.col("n") == 1, 1.0).otherwise(F.coalesce("score", F.lit(0.0)))).drop("score", "n")


def geotag(spans: DataFrame, index: DataFrame, cities: DataFrame, edges: DataFrame, *, type_scores: DataFrame | None = None, city_scores: DataFrame | None = None, gathered=edge_list) -> tuple[DataFrame, DataFrame]:
    """The places of each document, ``place_no`` from 0, and the trace of all spans.

    ``index``: a ``gazetteer_index``; ``cities``: id, name; ``edges``: edge_id, city_id, name.
    Regions are the most populous entry of class A. Cities without an id of ``cities`` are no
    places, but streets and locations still look at them. Streets that no detected city has
    and names without an entry are left out. ``gathered``: as at ``streets_in_cities``. The trace has type, detected city and its id of each span.
    """
    # What several steps read is written once: the joins behind it are not worked out anew for each.
    index = written(index, "index")
    types = written(decided(span_types(looked_up(spans, key_classes(index))), type_scores).select("doc_id", "ord", "type"), "types")
    # Each kind looks up those entries only that it may choose.
    of = lambda kind, feature_class, k=1: looked_up(spans.join(types.where(F.col("type") == kind).select("doc_id", "ord"), ["doc_id", "ord"], "left_semi"), leading(index, feature_class, k))
    text = spans.select("doc_id", "ord", "text")
    nothing = {"admin1_code": "string", "city_id": "long", "city_name": "string", "edge_ids": "array<long>", "lat": "double", "lon": "double", "name": "string", "geonames_id": "long"}

    def placed(rows: DataFrame, kind: str, confidence: Column = F.lit(1.0)) -> DataFrame:
        have = rows.withColumn("type", F.lit(kind)).withColumn("confidence", confidence)
        have = have.withColumns({c: F.lit(None).cast(k) for c, k in nothing.items() if c not in have.columns})
        return have.select(*(F.col(c).cast(nothing[c]).alias(c) if c in nothing else F.col(c) for c in COLUMNS))

    regions = most_populous(of("region", "A"), "A").withColumnRenamed("entry_id", "geonames_id").drop("population")
    cand = homonyms(of("city", "P", CANDIDATES).where("feature_class = 'P'"))
    city = written(chosen_city(cand, city_scores), "chosen")
    match = matched_city(city.select("name"), cities, contained=True)
    city = written(city.join(match, "name", "left").withColumn("city_name", F.coalesce("city_name", "name")), "cities")
    detected = city.where("lat is not null").select("doc_id", "ord", "city_id", "city_name", "lat", "lon")
    asked = text.join(types.where("type = 'street'").select("doc_id", "ord"), ["doc_id", "ord"])
    streets = streets_in_cities(asked, detected, edges, least=LEAST, gathered=gathered)
    nothing["edge_ids"] = streets.schema["edge_ids"].dataType
    points = most_populous(of("location", "P"), "P")
    near = nearest_city(points.select("doc_id", "ord", "lat", "lon"), detected)
    location = points.drop("admin1_code", "population").withColumnRenamed("entry_id", "geonames_id").join(near.drop("km"), ["doc_id", "ord"], "left")

    every = placed(regions.join(text, ["doc_id", "ord"]), "region")
    every = every.unionByName(placed(city.where("city_id is not null").withColumnRenamed("entry_id", "geonames_id").join(text, ["doc_id", "ord"]), "city", F.col("confidence")))
    every = every.unionByName(placed(streets, "street")).unionByName(placed(location.join(text, ["doc_id", "ord"]), "location"))
    order = Window.partitionBy("doc_id").orderBy(output_order(F.col("type")), "ord")
    trace = spans.join(types, ["doc_id", "ord"]).join(detected.select("doc_id", "ord", F.col("city_name").alias("detected_city"), F.col("city_id").alias("detected_id")), ["doc_id", "ord"], "left")
    return every.withColumn("place_no", F.row_number().over(order) - 1), trace


def geo_context(cities: DataFrame, most: int = 5) -> DataFrame:
    """doc_id and ``geo_context``: the names of the first ``most`` different city places, by ``ord``, joined by a comma."""
    first = cities.groupBy("doc_id", "city_name").agg(F.min("ord").alias("ord"))
    named = F.array_sort(F.collect_list(F.struct("ord", "city_name")))
    return first.groupBy("doc_id").agg(F.array_join(F.transform(F.slice(named, 1, most), lambda x: x["city_name"]), ", ").alias("geo_context"))
