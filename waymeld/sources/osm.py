"""Map extracts in the PBF format: nodes and ways as tables, and the roads of a box with their points.

A first pass reads only the headers of the blobs, one task a file; the blobs are then dealt out and decoded side by
side, so an extract of any size needs one blob in memory per task. Paths must be reachable from the executors.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TAGS = pa.map_(pa.string(), pa.string())
#: Kinds of road that a recorded way can be carried as.
ROADS = ("track", "unclassified", "residential", "service", "tertiary", "secondary", "primary", "road", "living_street", "path", "bridleway", "footway", "cycleway", "byway", "pedestrian", "busway")


def _number(body: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        n |= (body[at] & 127) << shift
        at, shift = at + 1, shift + 7
        if body[at - 1] < 128:
            return n, at


def message(body: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Fields of a message: number, and a whole number or bytes."""
    at = 0
    while at < len(body):
        head, at = _number(body, at)
        kind = head & 7
        if kind == 0:
            value, at = _number(body, at)
        else:
            if kind not in (1, 2, 5):
                raise ValueError(f"field of unknown kind {kind}")
            size, at = _number(body, at) if kind == 2 else ({1: 8, 5: 4}[kind], at)
            if at + size > len(body):
                raise ValueError("field is cut off")
            value, at = body[at : at + size], at + size
        yield head >> 3, value


def numbers(body: bytes) -> np.ndarray:
    """Whole numbers written seven bits a byte, one after another."""
    b = np.frombuffer(body, dtype=np.uint8)
    if not len(b):
        return np.zeros(0, dtype=np.int64)
    last = np.flatnonzero(b < 128)
    first = np.concatenate(([0], last[:-1] + 1))
    place = np.arange(last[-1] + 1) - np.repeat(first, last - first + 1)
    bits = (b[: last[-1] + 1] & 127).astype(np.uint64) << (7 * place).astype(np.uint64)
    return np.add.reduceat(bits, first).astype(np.int64)


def signed(n: np.ndarray) -> np.ndarray:
    """Numbers whose sign is their lowest bit."""
    return ((n.astype(np.uint64) >> np.uint64(1)).astype(np.int64)) ^ -(n & 1)


def blobs(spark: SparkSession, *paths: str) -> DataFrame:
    """path, at, size of the data blobs of extracts."""
    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                files, inner = pafs.FileSystem.from_uri(path)
                with files.open_input_file(inner) as f:
                    found, at, end = [], 0, f.size()
                    while at < end:
                        f.seek(at)
                        size = f.read(4)
                        if len(size) < 4:
                            raise ValueError(f"{path} is cut off at byte {at}")
                        (head,) = struct.unpack(">I", size)
                        fields = dict(message(f.read(head)))
                        if at + 4 + head + fields[3] > end:
                            raise ValueError(f"{path} is cut off at byte {at}")
                        if fields[1] == b"OSMData":
                            found.append((path, at + 4 + head, fields[3]))
                        at += 4 + head + fields[3]
                    yield pd.DataFrame(found, columns=["path", "at", "size"])

    one = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return one.mapInPandas(walk, "path string, at bigint, size bigint")


def _block(path: str, at: int, size: int) -> dict:
    files, inner = pafs.FileSystem.from_uri(path)
    with files.open_input_file(inner) as f:
        f.seek(at)
        blob = dict(message(f.read(size)))
    if 1 not in blob and 3 not in blob:
        raise ValueError(f"{path}: blob at byte {at} is packed in a way that is not known")
    out = {"strings": [], "groups": [], 17: 100, 19: 0, 20: 0}
    for k, v in message(blob[1] if 1 in blob else zlib.decompress(blob[3])):
        if k == 1:
            out["strings"] = [s.decode("utf-8", "replace") for n, s in message(v) if n == 1]
        elif k == 2:
            out["groups"].append(v)
        elif k in (19, 20):
            out[k] = v - (1 << 64) if v >> 63 else v
        else:
            out[k] = v
    return out


def _tags(strings: list[str], keys: np.ndarray, values: np.ndarray) -> list[tuple[str, str]]:
    return list({strings[k]: strings[v] for k, v in zip(keys, values) if k < len(strings) and v < len(strings)}.items())


def _nodes(block: dict) -> Iterator[pa.RecordBatch]:
    strings, scale = block["strings"], block[17] * 1e-9
    for group in block["groups"]:
        plain = []
        for k, body in message(group):
            if k == 1:
                f = dict(message(body))
                ids = signed(np.array([f[1], f[8], f[9]], dtype=np.uint64).astype(np.int64))
                plain.append((ids, _tags(strings, numbers(f.get(2, b"")), numbers(f.get(3, b"")))))
            elif k == 2:
                f = dict(message(body))
                ids, lat, lon = (np.cumsum(signed(numbers(f.get(n, b"")))) for n in (1, 8, 9))
                tags: list = [[]] * len(ids)
                said = numbers(f.get(10, b""))
                ends = np.flatnonzero(said == 0)
                # Pairs of one node end in a nought; a nought that stands as a value belongs to its pair.
                at = 0
                if len(ends) != len(said):
                    for i in range(len(ids)):
                        here = at
                        while at < len(said) and said[at] != 0:
                            at += 2
                        if at > here:
                            tags[i] = _tags(strings, said[here:at:2], said[here + 1 : at : 2])
                        at += 1
                yield _node_batch(ids, lat, lon, tags, block, scale)
        if plain:
            yield _node_batch(*(np.array([p[0][j] for p in plain]) for j in range(3)), [p[1] for p in plain], block, scale)


def _node_batch(ids, lat, lon, tags, block: dict, scale: float) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(block[19] * 1e-9 + scale * lat), pa.array(block[20] * 1e-9 + scale * lon), pa.array(tags, TAGS)], names=["id", "lat", "lon", "tags"])


def _ways(block: dict) -> Iterator[pa.RecordBatch]:
    ids, tags, refs = [], [], []
    for group in block["groups"]:
        for k, body in message(group):
            if k == 3:
                f = dict(message(body))
                ids.append(f.get(1, 0))
                tags.append(_tags(block["strings"], numbers(f.get(2, b"")), numbers(f.get(3, b""))))
                refs.append(np.cumsum(signed(numbers(f.get(8, b"")))))
    if ids:
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(tags, TAGS), pa.array(refs, pa.list_(pa.int64()))], names=["id", "tags", "refs"])


def _decoded(found: DataFrame, read, schema: str, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from read(_block(row["path"], row["at"], row["size"]))

    return found.repartition(parts, "path", "at").mapInArrow(run, schema)


def nodes(spark: SparkSession, *paths: str, parts: int = 64) -> DataFrame:
    """id, lat, lon, tags of every node; a node without tags has an empty map."""
    return _decoded(blobs(spark, *paths), _nodes, "id bigint, lat double, lon double, tags map<string,string>", parts)


def ways(spark: SparkSession, *paths: str, parts: int = 64) -> DataFrame:
    """id, tags, refs (ids of its nodes in order) of every way."""
    return _decoded(blobs(spark, *paths), _ways, "id bigint, tags map<string,string>, refs array<bigint>", parts)


def in_box(box: tuple) -> Column:
    """Whether a node lies in a box (west, south, east, north), edges included."""
    return F.col("lat").between(box[1], box[3]) & F.col("lon").between(box[0], box[2])


def roads(found_nodes: DataFrame, found_ways: DataFrame, box: tuple, kinds: tuple = ROADS) -> DataFrame:
    """id, tags, line: roads of which any node lies in the box, with all their points; points that the extract lacks are left out.

    Ways shed to their ids before they meet the nodes; tags join last.
    """
    kept = found_ways.filter(F.col("tags")["highway"].isin(*kinds))
    refs = kept.select("id", F.posexplode("refs").alias("pos", "ref"))
    inside = found_nodes.filter(in_box(box)).select(F.col("id").alias("ref"))
    met = refs.join(inside, "ref", "left_semi").select("id").distinct()
    places = found_nodes.select(F.col("id").alias("ref"), "lat", "lon")
    lines = refs.join(met, "id", "left_semi").join(places, "ref").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", F.col("lon").alias("x"), F.col("lat").alias("y")))).alias("p"))
    return kept.select("id", "tags").join(lines.select("id", F.transform("p", lambda p: F.struct(p["x"], p["y"])).alias("line")), "id")


def barriers(found_nodes: DataFrame, box: tuple) -> DataFrame:
    """id, kind, lat, lon, tags of the nodes in the box that are tagged as barriers."""
    return found_nodes.filter(in_box(box) & F.col("tags")["barrier"].isNotNull()).select("id", F.col("tags")["barrier"].alias("kind"), "lat", "lon", "tags")


def designated(found_ways: DataFrame) -> DataFrame:
    """Tags of the ways whose designation speaks of a byway, wherever they lie."""
    return found_ways.filter(F.col("tags")["designation"].rlike("(?i)byway")).select("id", "tags")
