"""Tile archives (PMTiles, version 3): written from rows of tiles, read as rows, checked, and given new directories.

Equal tiles are stored once and runs of them share an entry. Offsets, runs and leaf directories are worked out in the
executors; the driver holds the root directory and one batch of tiles while it copies them to the file in order.
"""

from __future__ import annotations

import gzip
import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waymeld.functions import geo
from waymeld.sources.osm import numbers
from waymeld.sources.sinks import _number

#: Fixed values of the format: bytes of the header, and how far header and root directory may reach.
HEADER, ROOT_END = 127, 16384
#: Tile numbers per block that runs and offsets are worked out in, entries of the least leaf, and bytes copied at once.
BLOCK, LEAF, COPY = 65536, 512, 1 << 24


def directory(entries: list[tuple[int, int, int, int]]) -> bytes:
    """Packed directory of (tile number, offset, length, run), in order of number; a run of 0 points to a leaf."""
    ids = [e[0] for e in entries]
    follows = [False] + [b[1] == a[1] + a[2] for a, b in zip(entries, entries[1:])]
    columns = [[len(entries)], [b - a for a, b in zip([0] + ids, ids)], [e[3] for e in entries], [e[2] for e in entries], [0 if f else e[1] + 1 for f, e in zip(follows, entries)]]
    return gzip.compress(b"".join(_number(n) for column in columns for n in column), mtime=0)


def entries_of(packed: bytes) -> list[tuple[int, int, int, int]]:
    """The entries of a packed directory."""
    n = numbers(gzip.decompress(packed))
    k = int(n[0])
    if len(n) != 1 + 4 * k:
        raise ValueError("directory is cut off")
    ids, runs, sizes, said = np.cumsum(n[1 : 1 + k]), n[1 + k : 1 + 2 * k], n[1 + 2 * k : 1 + 3 * k], n[1 + 3 * k :]
    out, end = [], 0
    for i, run, size, at in zip(ids.tolist(), runs.tolist(), sizes.tolist(), said.tolist()):
        start = end if at == 0 and out else at - 1
        out.append((i, start, size, run))
        end = start + size
    return out


def tile_of(number: int) -> tuple[int, int, int]:
    """Zoom, column and row of a tile number."""
    z = 0
    while number >= 4**z:
        number -= 4**z
        z += 1
    x = y = 0
    for k in range(z):
        s = 1 << k
        quarter = number >> 2 * k & 3
        rx, ry = int(quarter in (2, 3)), int(quarter in (1, 2))
        if ry == 0:
            if rx:
                x, y = s - 1 - x, s - 1 - y
            x, y = y, x
        x, y = x + s * rx, y + s * ry
    return z, x, y


def _before(df: DataFrame, block: str, total) -> DataFrame:
    """block, _base: totals of the blocks before each. One row per block of BLOCK numbers meets in one task."""
    sums = df.groupBy(block).agg(total.alias("_t"))
    return sums.select(block, F.coalesce(F.sum("_t").over(W.orderBy(block).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_base"))


def laid_out(tiles: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Contents (digest, first, length, offset) and entries (ordinal, id, offset, length, run) of rows z, x, y, tile.

    A number that comes twice keeps the lesser of its tiles by digest; null tiles are no tiles. Runs end with their block.
    """
    ids = tiles.filter("tile IS NOT NULL").select(geo.hilbert_id(F.col("z"), F.col("x"), F.col("y")).alias("id"), F.sha2("tile", 256).alias("digest"), F.length("tile").cast("bigint").alias("length"))
    once = ids.groupBy("id").agg(F.min(F.struct("digest", "length")).alias("c")).select("id", "c.*")
    block = lambda c: F.floor(F.col(c) / BLOCK)
    contents = once.groupBy("digest").agg(F.min("id").alias("first"), F.max("length").alias("length")).withColumn("_b", block("first"))
    inside = W.partitionBy("_b").orderBy("first")
    placed = contents.withColumn("_in", F.sum("length").over(inside) - F.col("length")).join(_before(contents, "_b", F.sum("length")), "_b").select("digest", "first", "length", (F.col("_base") + F.col("_in")).alias("offset"))
    rows = once.join(placed.select("digest", "offset"), "digest").withColumn("_b", block("id"))
    order = W.partitionBy("_b").orderBy("id")
    follows = (F.lag("id").over(order) + 1 == F.col("id")) & (F.lag("offset").over(order) == F.col("offset"))
    runs = rows.withColumn("_starts", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1)).withColumn("_run", F.sum("_starts").over(order))
    entries = runs.groupBy("_b", "_run").agg(F.min("id").alias("id"), F.min("offset").alias("offset"), F.min("length").alias("length"), F.count("*").alias("run"))
    return placed, entries.join(_before(entries, "_b", F.count("*")), "_b").select((F.col("_base") + F.col("_run") - 1).alias("ordinal"), "id", "offset", "length", "run")


def _directories(entries: DataFrame, count: int) -> tuple[bytes, DataFrame | None, int]:
    """Root directory, leaves (leaf, body) where there are any, and their bytes in all."""
    if count <= 4 * LEAF:
        root = directory([tuple(r) for r in entries.orderBy("id").select("id", "offset", "length", "run").collect()])
        if HEADER + len(root) <= ROOT_END:
            return root, None, 0
    size = LEAF
    # Some three bytes a pointer fit: smaller leaves need not be tried.
    while count / size > ROOT_END:
        size *= 2

    while True:
        def packed(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("id")
            body = directory(list(rows[["id", "offset", "length", "run"]].itertuples(index=False, name=None)))
            return pd.DataFrame([(int(rows["leaf"].iloc[0]), int(rows["id"].iloc[0]), len(body), body)], columns=["leaf", "id", "size", "body"])

        leaves = entries.withColumn("leaf", F.floor(F.col("ordinal") / size)).groupBy("leaf").applyInPandas(packed, "leaf bigint, id bigint, size bigint, body binary")
        at, pointers = 0, []
        for first, length in leaves.orderBy("leaf").select("id", "size").collect():
            pointers.append((first, at, length, 0))
            at += length
        root = directory(pointers)
        if HEADER + len(root) <= ROOT_END:
            return root, leaves, at
        size *= 2


def _head(numbers_: list[int], clustered: bool, packing: int, kind: int, zooms: tuple[int, int], box: tuple) -> bytes:
    e7 = lambda d: int(round(d * 1e7))
    west, south, east, north = box
    return b"PMTiles" + struct.pack("<B11Q6B4iB2i", 3, *numbers_, clustered, 2, packing, kind, *zooms, e7(west), e7(south), e7(east), e7(north), min(zooms[1], 12), e7((west + east) / 2), e7((south + north) / 2))


def write_archive(tiles: DataFrame, path: str, box: tuple, metadata: dict, kind: int = 1, packing: int = 1) -> tuple[int, int]:
    """Writes rows z, x, y, tile as one archive and returns its counts of entries and of stored tiles.

    tiles should be a stored table, since it is read for the layout and again for the copy. kind: 1 vector, 2 PNG,
    3 JPEG tiles; packing: 1 none, 2 gzip. An archive needs at least one tile.
    """
    contents, entries = (df.persist() for df in laid_out(tiles))
    try:
        stored, size = contents.agg(F.count("*"), F.sum("length")).first()
        if not stored:
            raise ValueError("no tiles to write")
        count, addressed = entries.agg(F.count("*"), F.sum("run")).first()
        zooms = tiles.filter("tile IS NOT NULL").agg(F.min("z"), F.max("z")).first()
        root, leaves, leaf_bytes = _directories(entries, count)
        said = gzip.compress(json.dumps(metadata, separators=(",", ":")).encode(), mtime=0)
        data_at = HEADER + len(root) + len(said) + leaf_bytes
        head = _head([HEADER, len(root), HEADER + len(root), len(said), HEADER + len(root) + len(said), leaf_bytes, data_at, size, addressed, count, stored], True, packing, kind, tuple(zooms), box)
        bodies = tiles.filter("tile IS NOT NULL").select(F.sha2("tile", 256).alias("digest"), "tile", geo.hilbert_id(F.col("z"), F.col("x"), F.col("y")).alias("first"))
        files, inner = pafs.FileSystem.from_uri(path)
        with files.open_output_stream(inner) as out:
            out.write(head + root + said)
            if leaves is not None:
                for row in leaves.orderBy("leaf").select("body").toLocalIterator():
                    out.write(row[0])
            for row in bodies.join(contents.select("digest", "first"), ["digest", "first"]).dropDuplicates(["digest", "first"]).orderBy("first").select("tile").toLocalIterator():
                out.write(row[0])
        return count, stored
    finally:
        contents.unpersist()
        entries.unpersist()


def _opened(path: str):
    files, inner = pafs.FileSystem.from_uri(path)
    return files.open_input_file(inner)


def _cut(f, at: int, size: int) -> bytes:
    f.seek(at)
    return f.read(size)


def _sections(head: bytes) -> dict[str, tuple[int, int]]:
    n = struct.unpack_from("<8Q", head, 8)
    return {"root": n[0:2], "metadata": n[2:4], "leaf": n[4:6], "data": n[6:8]}


def read_archives(spark: SparkSession, *paths: str, parts: int = 64) -> DataFrame:
    """path, z, x, y, tile of every tile that archives address. One task reads a root; leaves are dealt out."""
    def roots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                with _opened(path) as f:
                    s = _sections(_cut(f, 0, HEADER))
                    found = entries_of(_cut(f, *s["root"]))
                at = [(s["leaf"][0] + o, n) for _, o, n, run in found if run == 0]
                yield pd.DataFrame([(path, *a, s["data"][0], s["leaf"][0]) for a in at + [s["root"]]], columns=["path", "at", "size", "data", "leaf"])

    def addressed(path: str, at: int, size: int, data: int, leaf: int) -> Iterator[tuple]:
        # A root's own tiles; its pointers are rows of their own. A leaf may point further.
        with _opened(path) as f:
            todo, top = [(at, size)], at == HEADER
            while todo:
                for i, offset, length, run in entries_of(_cut(f, *todo.pop())):
                    if run:
                        body = _cut(f, data + offset, length)
                        yield from ((path, *tile_of(k), body) for k in range(i, i + run))
                    elif not top:
                        todo.append((leaf + offset, length))

    def tiles(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frame = lambda rows: pd.DataFrame(rows, columns=["path", "z", "x", "y", "tile"])
        rows, held = [], 0
        for batch in batches:
            for given in batch.itertuples(index=False, name=None):
                for row in addressed(*given):
                    rows.append(row)
                    held += len(row[-1]) + 64
                    if held > COPY:
                        yield frame(rows)
                        rows, held = [], 0
        yield frame(rows)

    given = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    leaves = given.mapInPandas(roots, "path string, at bigint, size bigint, data bigint, leaf bigint")
    return leaves.repartition(parts, "path", "at").mapInPandas(tiles, "path string, z int, x bigint, y bigint, tile binary")


def problems(path: str) -> list[str]:
    """What would keep a reader from opening an archive; none if all is well."""
    with _opened(path) as f:
        size, head = f.size(), _cut(f, 0, HEADER)
    if len(head) < HEADER:
        return ["shorter than a header"]
    if not head.startswith(b"PMTiles"):
        return ["no tile archive"]
    if head[7] != 3:
        return [f"version {head[7]} instead of 3"]
    s = _sections(head)
    out = [f"{name} runs past the end of the file" for name in ("root", "leaf", "data") if sum(s[name]) > size]
    if sum(s["root"]) > ROOT_END:
        out.append(f"root directory ends past byte {ROOT_END}")
    return out + [f"{name} is empty" for name in ("root", "data") if s[name][1] == 0]


def repack(spark: SparkSession, source: str, target: str) -> int:
    """Copies an archive with new directories, whose root is short enough; tiles are copied as they are. Returns the number of leaves' bytes."""
    with _opened(source) as f:
        head = _cut(f, 0, HEADER)
        s = _sections(head)

        def walk(at: int, size: int) -> Iterator[tuple]:
            for e in entries_of(_cut(f, at, size)):
                yield from walk(s["leaf"][0] + e[1], e[2]) if e[3] == 0 else (e,)

        found = list(walk(*s["root"]))
        rows = spark.createDataFrame([(k, *e) for k, e in enumerate(found)], "ordinal bigint, id bigint, offset bigint, length bigint, run bigint")
        root, leaves, leaf_bytes = _directories(rows, len(found))
        said = _cut(f, *s["metadata"])
        at = HEADER + len(root) + len(said)
        new = struct.pack("<8Q", HEADER, len(root), HEADER + len(root), len(said), at, leaf_bytes, at + leaf_bytes, s["data"][1])
        files, inner = pafs.FileSystem.from_uri(target)
        with files.open_output_stream(inner) as out:
            out.write(head[:8] + new + head[72:] + root + said)
            if leaves is not None:
                for row in leaves.orderBy("leaf").select("body").toLocalIterator():
                    out.write(row[0])
            for k in range(s["data"][0], sum(s["data"]), COPY):
                out.write(_cut(f, k, min(COPY, sum(s["data"]) - k)))
    return leaf_bytes
