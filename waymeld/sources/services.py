"""Services that answer page by page, and the records that they send: stations, measures and readings, features of map services."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeld.functions import geo, text
from waymeld.operators import orders

#: Pages after which a service that never sends an empty one is taken to be broken.
MOST_PAGES = 200


def paged(spark: SparkSession, sources: list[str], fetch: Callable[[str, int], str], items: str = "items", limit: int = 10_000, most: int = MOST_PAGES) -> DataFrame:
    """source, at, body: every item that `fetch(source, offset)` sends, as JSON text; a task per source, a page in memory.

    A short page is not the last one: asking ends at an empty page. A source that does not end within `most` pages is an
    error rather than cut short, as is a page that is no JSON object.
    """
    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for source in batch["source"]:
                for page in range(most):
                    answer = json.loads(fetch(source, page * limit))
                    if not isinstance(answer, dict):
                        raise ValueError(f"{source}: page {page} is no object")
                    found = answer.get(items) or []
                    if not found:
                        break
                    yield pd.DataFrame({"source": source, "at": range(page * limit, page * limit + len(found)), "body": [json.dumps(i) for i in found]})
                else:
                    raise ValueError(f"{source} does not end within {most} pages of {limit}")

    given = spark.createDataFrame([(s,) for s in sources], "source string").repartition(max(1, len(sources)))
    return given.mapInPandas(ask, "source string, at bigint, body string")


def _first(body: Column, path: str) -> Column:
    """A text, or the first of an array of them."""
    return F.get(orders.strings(orders.at(body, path)), 0)


def stations(records: DataFrame, body: str = "body") -> DataFrame:
    """id, label, lat, lon, river, catchment, low, high, measures of stations that can be placed, one row per id.

    A range that the service does not send stays null. Of rows with one id the least by its text stands.
    """
    b = F.col(body)
    number = lambda c: F.trim(c).try_cast("double")
    scale = F.coalesce(F.get(orders.items(orders.at(b, "stageScale")), 0), F.lit("{}"))
    each = F.coalesce(F.from_json(orders.at(b, "measures"), "array<string>"), F.when(orders.at(b, "measures").isNotNull(), F.array(orders.at(b, "measures"))), F.array().cast("array<string>"))
    name = lambda m: F.when(F.startswith(F.trim(m), F.lit("{")), F.coalesce(F.get_json_object(m, "$['@id']"), F.get_json_object(m, "$.notation"))).otherwise(m)
    rows = records.select(
        F.coalesce(F.nullif(orders.at(b, "notation"), F.lit("")), F.nullif(orders.at(b, "stationReference"), F.lit(""))).alias("id"), text.clean_text(_first(b, "label")).alias("label"),
        number(orders.at(b, "lat")).alias("lat"), F.coalesce(number(orders.at(b, "long")), number(orders.at(b, "lon"))).alias("lon"),
        text.clean_text(_first(b, "riverName")).alias("river"), text.clean_text(_first(b, "catchmentName")).alias("catchment"),
        number(orders.at(scale, "typicalRangeLow")).alias("low"), number(orders.at(scale, "typicalRangeHigh")).alias("high"),
        F.filter(F.transform(each, name), lambda m: m.isNotNull() & (m != "")).alias("measures"), b.alias("_b"))
    placed = rows.filter("id IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL")
    names = [c for c in placed.columns if c != "_b"]
    return placed.groupBy("id").agg(F.min_by(F.struct(*names), "_b").alias("s")).select("s.*")


def measure_index(found: DataFrame) -> DataFrame:
    """measure, id: which station each measure belongs to. Taken from the stations' own lists, since ids may hold hyphens; of several stations the greatest id."""
    return found.select("id", F.explode("measures").alias("measure")).groupBy("measure").agg(F.max("id").alias("id"))


def readings(records: DataFrame, index: DataFrame, body: str = "body") -> DataFrame:
    """id, at, value of readings of known measures; one whose time or value cannot be read is left out."""
    b = F.col(body)
    measure = orders.at(b, "measure")
    name = F.when(F.startswith(F.trim(measure), F.lit("{")), F.coalesce(F.get_json_object(measure, "$['@id']"), F.get_json_object(measure, "$.notation"))).otherwise(measure)
    rows = records.select(name.alias("measure"), orders.at(b, "dateTime").try_cast("timestamp").alias("at"), orders.at(b, "value").try_cast("double").alias("value"))
    return rows.filter("at IS NOT NULL AND value IS NOT NULL").join(index, "measure").select("id", "at", "value")


def map_features(records: DataFrame, body: str = "body") -> DataFrame:
    """attributes (JSON text) and parts of a map service's features, whose lines are called paths, polygons rings; features without either are left out."""
    b = F.col(body)
    xy = lambda name: F.from_json(F.get_json_object(b, f"$.geometry.{name}"), "array<array<array<double>>>")
    parts = F.transform(F.coalesce(xy("paths"), xy("rings")), lambda line: F.transform(F.filter(line, lambda c: F.size(c) >= 2), lambda c: F.struct(F.get(c, 0).alias("x"), F.get(c, 1).alias("y"))))
    return records.select(F.get_json_object(b, "$.attributes").alias("attributes"), F.filter(parts, lambda line: F.size(line) > 1).cast(f"array<{geo.LINE}>").alias("parts")).filter(F.size("parts") > 0)
