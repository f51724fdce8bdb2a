"""N-gram Jaccard self-join by partitioning the universe of shingles (pigeonhole over segments).

Sets fall into size bands in which any two sets that link differ in at most H shingles. A band's shingles are
hashed into H + 1 segments, so two linked sets agree on a whole segment, whose order-free hash is the key of a
bucket. Segments of a shingle or none are shared by chance; a set leaves out such costly segments and looks as
many of a few reserve segments up with one difference allowed (their one-deletion neighbourhoods are indexed),
which keeps the sum that the pigeonhole needs. Candidates are first held against each other by odd sketches: a bit
per hashed shingle, flipped by each shingle, so sets that differ in D shingles differ in D bits at most. What the
sketches leave is verified on the words themselves.

Equal sets are one set from the start. In a bucket, all sets are held against one centre, so a group of n near
copies costs n pairs. Only buckets that still hold sets of different components are then compared in full, by
sketches, block by block; sets that may link across components form clusters, whose words meet block by block
inside a task that returns a spanning forest of links. No link between different texts is lost and no pairs of a
whole group are emitted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._store import dropped, freed, matching, small_batches, table, written
from ._words import groups, mix, pieces, shingle_hashes, words
from .components import components

#: Words of a shingle, least similarity in percent, most shingles of a segment that is costly to look up.
SHINGLE, PERCENT, COSTLY = 3, 90, 1
#: Roles of a set in a bucket: there to be found only, looking up only, both.
HOLD, LOOK, BOTH = 0, 1, 2
#: Sets of a block; the sets of a cluster are compared block against block. Sketches of a block, and partners that share one copy of a text.
BLOCK, SKETCHES, FAN = 512, 2048, 256


def bands(upto: int, percent: int) -> np.ndarray:
    """First sizes of the bands: a set links only with sets of its own and the two neighbouring bands."""
    edges = [1]
    while edges[-1] <= upto:
        edges.append(max(edges[-1] + 1, (edges[-1] - 1) * 100 // percent + 1))
    return np.array(edges, dtype=np.int64)


def segment_keys(shingles: np.ndarray, band: int, most: int, own: bool, percent: int, costly: int = COSTLY) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set in a band where linked sets differ in at most `most` shingles, and the role of each key.

    A set of the band is both found and looks up (BOTH), but segments it leaves out of its own search, and
    neighbourhoods it does not search, are there to be found only (HOLD). A set of the band above looks up (LOOK).
    """
    m, load = most + 1, percent / (100 - percent)
    spot = ((mix(shingles ^ np.uint64(0xA5A5A5A5)) >> np.uint64(20)) % np.uint64(m)).astype(np.int64)
    value = mix(shingles + np.uint64(0x1234567))
    total, filled = np.zeros(m, dtype=np.uint64), np.bincount(spot, minlength=m)
    np.add.at(total, spot, value)
    salt = mix(np.arange(m, dtype=np.uint64) + np.uint64(band << 32))
    # As many reserve segments as costly ones are to be expected among m, and some more.
    spare = min(m, 1 + int(1.3 * m * math.exp(-load) * (1 + load)))
    cheap = np.flatnonzero(filled[:spare] > costly)
    # Of the costly segments the emptiest, whose buckets are the largest, are left out first.
    skip = np.argsort(filled, kind="stable")[: np.count_nonzero(filled <= costly)][: len(cheap)]
    seen = np.ones(m, dtype=bool)
    seen[skip] = False
    searched = np.zeros(m, dtype=bool)
    searched[cheap[: len(skip)]] = True
    exact, inside = mix(total + salt), spot < spare
    around = mix(total[spot[inside]] - value[inside] + salt[spot[inside]])
    looks = searched[spot[inside]]
    if not own:
        keys = np.concatenate([exact[seen], around[looks]])
        return keys, np.full(len(keys), LOOK, dtype=np.int8)
    return np.concatenate([exact, around]), np.concatenate([np.where(seen, BOTH, HOLD), np.where(looks, BOTH, HOLD)]).astype(np.int8)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """As many bits as there are shingles, up to the next power of two (64 at least); a bit says if its shingles are odd in number."""
    bits = max(64, 1 << max(0, len(shingles) - 1).bit_length())
    at = (mix(shingles ^ np.uint64(0x0DD5EE7)) % np.uint64(bits)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=bits).astype(np.uint8) & 1).view(np.uint64)


def folded(sketches: list[bytes], longs: int) -> np.ndarray:
    """Sketches as rows of `longs` 64-bit words; longer ones are folded, which keeps the bound."""
    out = np.zeros((len(sketches), longs), dtype=np.uint64)
    for i, b in enumerate(sketches):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(b, dtype=np.uint64).reshape(-1, longs), axis=0)
    return out


def may_link(differ: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of together `sizes` shingles that differ in at least `differ` can reach the similarity."""
    return differ * (100 + percent) <= sizes * (100 - percent)


def set_digests(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, a 128-bit order-free hash (d1, d2) and the odd sketch of the set of every row."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            w = words(batch.column("text"))
            n, d, sketch = [], [], []
            for i in range(len(batch)):
                s = np.unique(shingle_hashes(w.hash[w.rows[i] : w.rows[i + 1]], shingle))
                n.append(len(s))
                d.append((mix(s).sum(dtype=np.uint64), mix(s ^ np.uint64(0x5555)).sum(dtype=np.uint64)))
                sketch.append(odd_sketch(s).tobytes())
            d = np.array(d, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(sketch, pa.binary())], names=["doc_id", "n_shingles", "d1", "d2", "sketch"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, sketch binary")


def keys(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """key, id, role: where every set is to be found and where it looks."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = bands(1 << 16, percent)
        for batch in pieces(batches, most=1 << 20):
            w, ids = words(batch.column("text")), batch.column("doc_id").to_numpy()
            found, role, row = [np.zeros(0, np.uint64)], [np.zeros(0, np.int8)], []
            for i in range(len(batch)):
                s = np.unique(shingle_hashes(w.hash[w.rows[i] : w.rows[i + 1]], shingle))
                while len(s) >= edges[-1]:
                    edges = bands(int(edges[-1]) * 2, percent)
                k = int(np.searchsorted(edges, len(s), side="right")) - 1
                for band, own in ((k, True), (k - 1, False)):
                    # Where no shingle may differ, linked sets are equal, and equal sets are one set already.
                    if len(s) and band >= 0 and (most := int((edges[band + 1] - 1) * (100 - percent) // percent)):
                        one, what = segment_keys(s, band, most, own, percent)
                        found.append(one)
                        role.append(what)
                        row.append(np.full(len(one), ids[i]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate([np.zeros(0, np.int64), *row])), pa.array(np.concatenate(role))], names=["key", "id", "role"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "key long, id long, role byte")


def shingle_set(text: str | None, shingle: int = SHINGLE) -> set:
    """The distinct shingles themselves; bytes.split() parts at just the separators that words() knows."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return set(zip(*[w[i:] for i in range(min(shingle, len(w)))])) if w else set()


def alike(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) whose odd sketches do not rule the similarity out. sketches: id, n, sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, sizes = batch.column("xa").to_pylist(), batch.column("xb").to_pylist(), batch.column("n").to_numpy()
            short = np.array([min(len(p), len(q)) // 8 for p, q in zip(x, y)])
            keep = np.zeros(len(batch), dtype=bool)
            for longs in np.unique(short):
                at = np.flatnonzero(short == longs)
                differ = np.bitwise_count(folded([x[i] for i in at], longs) ^ folded([y[i] for i in at], longs)).sum(axis=1, dtype=np.int64)
                keep[at] = may_link(differ, sizes[at], percent)
            yield batch.filter(pa.array(keep)).select(["a", "b"])

    side = lambda k: sketches.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"), F.col("sketch").alias(f"x{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent)
    return both.select("a", "b", (F.col("na") + F.col("nb")).alias("n"), "xa", "xb").mapInArrow(run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int, fan: int = FAN) -> DataFrame:
    """Those pairs (a, b) whose sets reach the similarity, checked on their words.

    The text of a is sent once for every `fan` partners, also where it is the centre of a very large group.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set = set()
        for batch in batches:
            keep = []
            for b, text in zip(batch.column("b").to_pylist(), batch.column("text").to_pylist()):
                other = shingle_set(text, shingle)
                if b is None:
                    held = other
                both = len(held & other)
                keep.append(b is not None and both > 0 and 100 * both >= percent * (len(held) + len(other) - both))
            yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])

    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(fan)).cast("int").alias("lots"))
    dealt = pairs.join(many, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("lots")).cast("int").alias("lot"))
    held = texts.select(F.col("doc_id").alias("t"), "text")
    ones = dealt.select("a", "lot").distinct().join(held, F.col("a") == F.col("t")).select("a", "lot", F.lit(None).cast("long").alias("b"), "text")
    rest = dealt.join(held, F.col("b") == F.col("t")).select("a", "lot", "b", "text")
    return ones.unionByName(rest).repartition("a", "lot").sortWithinPartitions("a", "lot", F.col("b").asc_nulls_first()).mapInArrow(run, "a long, b long")


def possible(open_: DataFrame, sketches: DataFrame, percent: int, block: int) -> DataFrame:
    """Edges (a, b) that join all ids which, by sketches, may link with one of another component in the same bucket.

    open_: key, id, c. A bucket of n ids is cut into n / block blocks by hash, and every two blocks meet in one task.
    """
    many = open_.groupBy("key").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("nb"))
    placed = open_.join(many, "key").withColumn("b", F.pmod(F.xxhash64(F.lit(5), "id"), F.col("nb")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select("key", "id", "c", F.least("b", "other").alias("p"), F.greatest("b", "other").alias("q"))
    rows = met.join(sketches, "id").select("key", "p", "q", "id", "c", "n", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for _, t in groups(batches, ("key", "p", "q")):
            ids, c, n, raw = t.column("id").to_numpy(), t.column("c").to_numpy(), t.column("n").to_numpy(), t.column("sketch").to_pylist()
            x = folded(raw, min(map(len, raw)) // 8)
            root = np.arange(len(ids))

            def find(v: int) -> int:
                while root[v] != v:
                    root[v] = v = root[root[v]]
                return v

            for i in range(len(ids) - 1):
                near = may_link(np.bitwise_count(x[i] ^ x[i + 1 :]).sum(axis=1, dtype=np.int64), n[i] + n[i + 1 :], percent) & (c[i + 1 :] != c[i])
                for j in np.flatnonzero(near) + i + 1:
                    if (r := find(i)) != (s := find(j)):
                        root[max(r, s)] = min(r, s)
                        a.append(ids[i])
                        b.append(ids[j])
            if len(a) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q").mapInArrow(run, "a long, b long")


def compared(mates: DataFrame, texts: DataFrame, shingle: int, percent: int, block: int) -> DataFrame:
    """Links (a, b) that join different components c within a cluster; mates: id, c, cluster.

    A cluster of n sets is cut into n / block blocks by hash, and every two blocks meet in one task, which holds
    2 * block sets and returns at most a spanning forest of the links it finds.
    """
    blocks = mates.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("nb"))
    placed = mates.join(blocks, "cluster").withColumn("b", F.pmod(F.xxhash64(F.lit(7), "id"), F.col("nb")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).select(
        "cluster", "id", "c", "b", F.least("b", "other").alias("p"), F.greatest("b", "other").alias("q"))
    rows = met.join(texts.select(F.col("doc_id").alias("id"), "text"), "id")

    def link(group: pd.DataFrame) -> pd.DataFrame:
        n, of, where = len(group), {}, []
        for i, text in enumerate(group["text"]):
            for x in (mine := shingle_set(text, shingle)):
                of.setdefault(x, []).append(i)
            where.append(len(mine))
        size, shared = np.array(where), np.zeros((n, n), dtype=np.int32)
        for have in of.values():
            if len(have) > 1:
                at = np.array(have)
                shared[at[:, None], at] += 1
        ids, c, b = group["id"].to_numpy(), group["c"].to_numpy(), group["b"].to_numpy()
        x, y = np.nonzero(np.triu((shared > 0) & (100 * shared >= percent * (size[:, None] + size - shared)), 1))
        apart = (c[x] != c[y]) & ((b[x] != b[y]) | (group["p"].iloc[0] == group["q"].iloc[0]))
        root: dict[int, int] = {}
        find = lambda v: v if root.get(v, v) == v else find(root[v])
        out = []
        for i, j in zip(x[apart], y[apart]):
            r, t = find(c[i]), find(c[j])
            if r != t:
                root[max(r, t)] = min(r, t)
                out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return rows.groupBy("cluster", "p", "q").applyInPandas(link, "a long, b long")


def jaccard_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (least doc_id that links lead to).

    A null or wordless text has no shingles and is a component of its own; fewer words than a shingle make one
    shingle. Equal sets link. Rows that repeat a doc_id are one node, whose size is that of each row. A null
    doc_id links with nothing and has a null component. Empty in, empty out. Other columns are ignored.
    """
    spark = docs.sparkSession
    signed = written(set_digests(docs, shingle))
    sets = ["n_shingles", "d1", "d2"]
    least = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy(*sets).agg(F.min("doc_id").alias("rep"))
    members = written(signed.join(least, sets, "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep"), F.when(F.col("doc_id") == F.coalesce("rep", "doc_id"), F.col("sketch")).alias("sketch")))
    dropped(signed)
    copies = members.filter("doc_id <> rep").select("doc_id").distinct()
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).filter("doc_id IS NOT NULL")
    single = matching(texts, copies, "doc_id", "left_anti")
    # Lists of ids grow with the input, so these joins shuffle at every size.
    here = W.partitionBy("key")
    rows = keys(single, shingle, percent).select("key", "id", "role", F.min("id").over(here).alias("lo"), F.max("id").over(here).alias("hi"), F.max(F.col("role") != HOLD).over(here).alias("looks"), F.max(F.col("role") != LOOK).over(here).alias("holds"))
    bucket = written(rows.filter("lo < hi AND looks AND holds").groupBy("key", "id").agg(F.max("role").alias("role")))
    freed(spark)
    shared = bucket.select("id").distinct()
    sketches = written(members.filter("sketch IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), "sketch").join(shared, "id", "left_semi").dropDuplicates(["id"]))
    # First every set of a bucket is held against one centre.
    centre = F.coalesce(F.min(F.when(F.col("role") == BOTH, F.col("id"))), F.min(F.when(F.col("role") == LOOK, F.col("id"))))
    centres = bucket.groupBy("key").agg(centre.alias("centre"))
    star = bucket.join(centres, "key").filter("id <> centre").select(F.least("centre", "id").alias("a"), F.greatest("centre", "id").alias("b")).distinct()
    near = written(alike(star, sketches, percent))
    freed(spark)
    links = written(verified(near, _texts_of(texts, near.select(F.explode(F.array("a", "b")).alias("doc_id"))), shingle, percent))
    freed(spark)
    labels = components(links)
    # A bucket that then still holds different components is compared in full, once for all buckets of the same sets.
    state = bucket.join(labels.select("id", F.col("component").alias("c")), "id", "left").withColumn("c", F.coalesce("c", "id"))
    same = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x1"), F.bit_xor(F.xxhash64(F.lit(3), "id")).alias("x2")]
    left = state.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), *same).filter("lo < hi AND n > 2").groupBy("n", "x1", "x2").agg(F.min("key").alias("key"))
    open_ = written(state.join(left.select("key"), "key").select("key", "id", "c"))
    forest = written(possible(open_, sketches, percent, SKETCHES))
    clusters = components(forest)
    mates = written(open_.select("id", "c").distinct().join(clusters, "id").withColumnRenamed("component", "cluster"))
    more = compared(mates, _texts_of(texts, mates.select(F.col("id").alias("doc_id"))), shingle, percent, block)
    both = written(links.select("a", "b").unionByName(more))
    labels = components(both)
    dropped(bucket, links, both, open_, near, sketches, forest, mates)
    freed(spark)
    final = members.join(labels.select(F.col("id").alias("rep"), "component"), "rep", "left")
    return final.select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))


def _texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of some ids, one of each."""
    return matching(texts, written(ids.distinct()), "doc_id", "left_semi").dropDuplicates(["doc_id"])


def one_of_each_group(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs with the least doc_id of every group of near duplicates.

    Where a doc_id repeats or is null, rows are told apart by doc_id and text (a 64-bit hash of both): a row goes if
    its own text's group has a lesser doc_id, a null one if there is any. Rows with the same doc_id and text all stay.
    """
    if docs.groupBy("doc_id").count().filter("doc_id IS NULL OR count > 1").isEmpty():
        gone = written(jaccard_groups(docs, shingle, percent).filter("doc_id <> component_id").select("doc_id"))
        return matching(docs, gone, "doc_id", "left_anti").select(*docs.columns)
    node = F.xxhash64(docs["doc_id"].isNull(), docs["doc_id"], docs["text"].isNull(), docs["text"])
    rows = docs.select(node.alias("node"), docs["doc_id"].alias("own_id"), docs["text"])
    groups = written(jaccard_groups(rows.select(F.col("node").alias("doc_id"), "text"), shingle, percent).select(F.col("doc_id").alias("node"), F.col("component_id").alias("c")).distinct())
    members = written(rows.select("node", "own_id").distinct().join(groups, "node"))
    best = members.groupBy("c").agg(F.min(F.struct(F.col("own_id").isNull(), "own_id", "node"))["node"].alias("best"))
    gone = written(members.join(best, "c").filter("node <> best").select(F.col("node").alias("_node")))
    return matching(docs.withColumn("_node", node), gone, "_node", "left_anti").select(*docs.columns)


def op4_jaccard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_ >= 90 * (x.n + y.n - both_)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, c) AS (SELECT a, a FROM e UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id AND r.c < e.b),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.c, d.doc_id)) AS component_id FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""
