"""Feature files and record extracts as tables. Parsing runs in the executors; the driver only lists paths."""

from __future__ import annotations

import sqlite3
import struct
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymeld.functions import geo

#: A feature: its attributes as JSON text, its kind of geometry and its parts.
FEATURE = f"path string, properties string, kind string, parts array<{geo.LINE}>"


def _parts(kind: str, coordinates: str):
    """GeoJSON coordinates as lines, whatever their depth."""
    read = lambda t, kinds: F.from_json(coordinates, kinds)
    point = lambda c: F.struct(F.get(c, 0).alias("x"), F.get(c, 1).alias("y"))
    line = lambda cs: F.transform(F.filter(cs, lambda c: F.size(c) >= 2), point)
    k = F.col(kind)
    return F.when(k == "Point", F.array(F.array(point(read(k, "array<double>"))))).when(k.isin("LineString", "MultiPoint"), F.array(line(read(k, "array<array<double>>")))).when(
        k.isin("Polygon", "MultiLineString"), F.transform(read(k, "array<array<array<double>>>"), line)).when(
        k == "MultiPolygon", F.transform(F.flatten(read(k, "array<array<array<array<double>>>>")), line))


def geojson(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per feature of GeoJSON collections: FEATURE. Files that are no collection, and features without geometry, give no rows.

    A collection is one JSON value, so each file is read whole by one task; features are taken apart as text, so one
    with an odd property spoils no other.
    """
    files = spark.read.text(list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.from_json("value", "features array<string>").alias("c"))
    one = files.select("path", F.explode("c.features").alias("f")).select("path", F.get_json_object("f", "$.properties").alias("properties"), F.get_json_object("f", "$.geometry.type").alias("kind"), F.get_json_object("f", "$.geometry.coordinates").alias("xy"))
    return one.select("path", "properties", "kind", _parts("kind", F.col("xy")).alias("parts")).filter("parts IS NOT NULL")


def csv_records(spark: SparkSession, *paths: str, body: str = "Data") -> DataFrame:
    """Rows of CSV extracts whose column `body` holds JSON, with `corrupt`: whether it is missing or no JSON object."""
    rows = spark.read.csv(list(paths), header=True, multiLine=True, quote='"', escape='"')
    return rows.withColumn("corrupt", F.try_parse_json(F.col(body)).isNull() | ~F.coalesce(F.startswith(F.trim(F.col(body)), F.lit("{")), F.lit(False)))


def kml(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per placemark of KML files with lines or points: FEATURE; properties holds the name and description."""
    files = spark.read.text(list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.explode(F.regexp_extract_all("value", F.lit(r"(?s)<Placemark\b.*?</Placemark>"), F.lit(0))).alias("p"))
    field = lambda name: F.nullif(F.trim(F.regexp_replace(F.regexp_extract("p", rf"(?s)<{name}\b[^>]*>(.*?)</{name}>", 1), r"^\s*<!\[CDATA\[|\]\]>\s*$", "")), F.lit(""))
    runs = F.regexp_extract_all("p", F.lit(r"(?s)<coordinates>(.*?)</coordinates>"), F.lit(1))
    pair = lambda c: F.split(c, ",")
    line = lambda run: F.filter(F.transform(F.split(F.trim(run), r"\s+"), lambda c: F.struct(F.get(pair(c), 0).try_cast("double").alias("x"), F.get(pair(c), 1).try_cast("double").alias("y"))), lambda q: q["x"].isNotNull() & q["y"].isNotNull())
    kind = F.when(F.contains("p", F.lit("<Polygon")), "Polygon").when(F.size(runs) > 1, "MultiLineString").when(F.contains("p", F.lit("<LineString")), "LineString").otherwise("Point")
    return files.select("path", F.to_json(F.struct(field("name").alias("name"), field("description").alias("description"))).alias("properties"), kind.alias("kind"), F.filter(F.transform(runs, line), lambda r: F.size(r) > 0).alias("parts")).filter(F.size("parts") > 0)


def gml(spark: SparkSession, *paths: str, member: str = "featureMember") -> DataFrame:
    """One row per member of GML files with lines: FEATURE; properties holds the member's own simple elements."""
    name = rf"(?:\w+:)?{member}"
    files = spark.read.text(list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.explode(F.regexp_extract_all("value", F.lit(rf"(?s)<{name}\b.*?</{name}>"), F.lit(0))).alias("m"))
    simple = F.lit(r"<(?:\w+:)?(\w+)(?:\s[^>]*)?>([^<>]*\S[^<>]*)</")
    keys, values = F.regexp_extract_all("m", simple, F.lit(1)), F.regexp_extract_all("m", simple, F.lit(2))
    fields = F.filter(F.arrays_zip(keys.alias("k"), values.alias("v")), lambda e: ~e["k"].isin("posList", "pos", "coordinates"))
    numbers = lambda run: F.transform(F.split(F.trim(run), r"[\s,]+"), lambda x: x.try_cast("double"))
    points = lambda n: F.transform(F.sequence(F.lit(0), F.greatest((F.size(n) / 2).cast("int") - 1, F.lit(0))), lambda i: F.struct(F.get(n, 2 * i).alias("x"), F.get(n, 2 * i + 1).alias("y")))
    runs = F.regexp_extract_all("m", F.lit(r"(?s)<(?:\w+:)?(?:posList|coordinates)\b[^>]*>(.*?)</"), F.lit(1))
    out = files.select("path", F.to_json(F.map_from_entries(F.transform(F.array_distinct(F.transform(fields, lambda e: e["k"])), lambda k: F.struct(k, F.get(F.filter(fields, lambda e: e["k"] == k), 0)["v"])))).alias("properties"), runs.alias("runs"))
    return out.select("path", "properties", F.when(F.size("runs") > 1, "MultiLineString").otherwise("LineString").alias("kind"), F.transform(F.transform("runs", numbers), points).alias("parts")).filter(F.size("parts") > 0)


def shape_records(body: bytes) -> list[tuple[str, list]]:
    """Kind and parts of every record of a .shp file's bytes; null shapes have no parts. Points, lines and areas, with or without heights."""
    out, at = [], 100
    while at + 12 <= len(body):
        size = struct.unpack(">i", body[at + 4 : at + 8])[0] * 2
        rec = body[at + 8 : at + 8 + size]
        kind = struct.unpack("<i", rec[:4])[0] % 10
        if kind == 1:
            out.append(("Point", [[struct.unpack("<2d", rec[4:20])]]))
        elif kind in (3, 5):
            parts, points = struct.unpack("<2i", rec[36:44])
            starts = [*struct.unpack(f"<{parts}i", rec[44 : 44 + 4 * parts]), points]
            xy = struct.unpack(f"<{2 * points}d", rec[44 + 4 * parts : 44 + 4 * parts + 16 * points])
            lines = [[(xy[2 * i], xy[2 * i + 1]) for i in range(a, b)] for a, b in zip(starts, starts[1:])]
            out.append(("Polygon" if kind == 5 else "MultiLineString" if parts > 1 else "LineString", lines))
        else:
            out.append(("", []))
        at += 8 + size
    return out


def table_records(body: bytes, encoding: str = "latin-1") -> list[dict]:
    """The rows of a .dbf file's bytes as texts, deleted ones as empty."""
    rows, head, size = struct.unpack("<iHH", body[4:12])
    fields, at, off = [], 32, 1
    while body[at] != 0x0D:
        fields.append((body[at : at + 11].split(b"\0")[0].decode(encoding), off, body[at + 16]))
        off, at = off + body[at + 16], at + 32
    out = []
    for i in range(rows):
        rec = body[head + i * size : head + (i + 1) * size]
        out.append({n: rec[o : o + w].decode(encoding).strip() for n, o, w in fields} if rec[:1] != b"*" else {})
    return out


def shapefiles(spark: SparkSession, folder: str) -> DataFrame:
    """One row per shape of the .shp files in a folder, joined by name with their .dbf: FEATURE. A file is one task's work."""
    files = spark.read.format("binaryFile").load(folder).withColumn("name", F.regexp_replace("path", r"(?i)\.\w+$", "")).withColumn("ext", F.lower(F.regexp_extract("path", r"\.(\w+)$", 1)))
    pairs = files.groupBy("name").agg(F.max(F.when(F.col("ext") == "shp", F.col("content"))).alias("shp"), F.max(F.when(F.col("ext") == "dbf", F.col("content"))).alias("dbf")).filter("shp IS NOT NULL")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for frame in frames:
            for name, shp, dbf in zip(frame["name"], frame["shp"], frame["dbf"]):
                rows = table_records(bytes(dbf)) if dbf is not None else []
                found = [(f"{name}.shp", json.dumps(rows[i]) if i < len(rows) else None, kind, [[{"x": x, "y": y} for x, y in line] for line in parts]) for i, (kind, parts) in enumerate(shape_records(bytes(shp))) if parts]
                yield pd.DataFrame(found, columns=["path", "properties", "kind", "parts"])

    return pairs.mapInPandas(read, FEATURE)


def wkb_parts(body: bytes) -> tuple[str, list]:
    """Kind and parts of a well-known binary geometry; heights and measures are left out."""
    def read(at: int) -> tuple[str, list, int]:
        order = "<" if body[at] else ">"
        code = struct.unpack(f"{order}I", body[at + 1 : at + 5])[0]
        wide = 2 + (code & 0x80000000 != 0 or code % 10000 // 1000 in (1, 3)) + (code & 0x40000000 != 0 or code % 10000 // 1000 in (2, 3))
        kind, at = (code & 0x0FFFFFFF) % 1000, at + 5

        def run(at: int, n: int) -> tuple[list, int]:
            v = struct.unpack(f"{order}{n * wide}d", body[at : at + 8 * n * wide])
            return [(v[i * wide], v[i * wide + 1]) for i in range(n)], at + 8 * n * wide

        count = lambda at: struct.unpack(f"{order}I", body[at : at + 4])[0]
        if kind == 1:
            p, at = run(at, 1)
            return "Point", [p], at
        if kind == 2:
            p, at = run(at + 4, count(at))
            return "LineString", [p], at
        if kind == 3:
            rings, parts, at = count(at), [], at + 4
            for _ in range(rings):
                p, at = run(at + 4, count(at))
                parts.append(p)
            return "Polygon", parts, at
        many, parts, at = count(at), [], at + 4
        for _ in range(many):
            _, p, at = read(at)
            parts += p
        return {4: "MultiPoint", 5: "MultiLineString", 6: "MultiPolygon"}.get(kind, "GeometryCollection"), parts, at

    kind, parts, _ = read(0)
    return kind, parts


def geopackages(spark: SparkSession, *paths: str) -> DataFrame:
    """One row per feature of every feature table of GeoPackage files: FEATURE. A file is one task's work, through a temporary copy that only that task reads."""
    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import json

        for frame in frames:
            for path, content in zip(frame["path"], frame["content"]):
                found = []
                with tempfile.NamedTemporaryFile(suffix=".gpkg") as f:
                    f.write(bytes(content))
                    f.flush()
                    con = sqlite3.connect(f"file:{f.name}?mode=ro", uri=True)
                    for table, column in con.execute("SELECT table_name, column_name FROM gpkg_geometry_columns").fetchall():
                        cur = con.execute('SELECT * FROM "' + table.replace('"', '""') + '"')
                        names = [c[0] for c in cur.description]
                        for row in cur:
                            rec = dict(zip(names, row))
                            blob = rec.pop(column)
                            if blob:
                                skip = 8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7]
                                kind, parts = wkb_parts(blob[skip:])
                                found.append((path, json.dumps({k: v for k, v in rec.items() if not isinstance(v, bytes)}), kind, [[{"x": x, "y": y} for x, y in p] for p in parts]))
                    con.close()
                yield pd.DataFrame(found, columns=["path", "properties", "kind", "parts"])

    return spark.read.format("binaryFile").load(list(paths)).select("path", "content").mapInPandas(read, FEATURE)
