"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

Counts cover every training text. Texts are kept as blocks of tokens; a block sends each distinct word and bigram
once, as sorted packed hashes, to the task that counts it, and gets the counts back in the same order. With these
counts each block is scored on its own. The mixture weights depend on how often the context was seen. They are
learned by expectation-maximisation on deleted counts: each training token is held out of its own counts, and all
tokens enter through a histogram whose cells are bounded by parameters.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import dropped, fold, freed, table, written
from ._words import mix, pieces, words

#: Bytes of text in a block, tokens that one counting task holds, context-frequency buckets, steps of the histogram per octave and its octaves.
BLOCK_BYTES, TASK_TOKENS, CONTEXTS, STEPS, OCTAVES = 6 << 20, 3_000_000, 14, 2, 40
END, START = np.uint64(0x656E64), np.uint64(0x7374617274)


def packed(x: np.ndarray) -> bytes:
    """An array of whole numbers, byte plane by byte plane, compressed."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw).tobytes())


def unpacked(b: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).view(kind).ravel()


def packed_sorted(x: np.ndarray) -> bytes:
    return packed(np.diff(x, prepend=np.uint64(0)))


def unpacked_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpacked(b, np.uint64), dtype=np.uint64)


_BLOCK = "ids array<long>, lens array<int>, train array<boolean>, vocab binary, inv binary"


def blocks(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text, train. Blocks of texts: tokens as places in the block's sorted words, an end after each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, most=BLOCK_BYTES):
            w = words(b.column("text"))
            lens = np.diff(w.rows) + 1
            h = np.insert(w.hash, w.rows[1:], END)
            vocab, inv = np.unique(h, return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array([b.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([lens.tolist()], pa.list_(pa.int32())), pa.array([b.column("train").to_pylist()], pa.list_(pa.bool_())),
                pa.array([packed_sorted(vocab)], pa.binary()), pa.array([packed(inv.astype(np.uint32))], pa.binary())], names=["ids", "lens", "train", "vocab", "inv"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "train").mapInArrow(run, _BLOCK).withColumn("block", F.monotonically_increasing_id())


def bigrams(vocab: np.ndarray, inv: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it in its text."""
    h = vocab[inv]
    before = np.empty_like(h)
    before[1:] = h[:-1]
    before[np.cumsum(lens) - lens] = START
    return mix(before * np.uint64(3) + mix(h))


def _requests(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                vocab, inv, lens = unpacked_sorted(r["vocab"]), unpacked(r["inv"], np.uint32), np.array(r["lens"], dtype=np.int64)
                train = np.repeat(np.array(r["train"], dtype=bool), lens)
                two, back = np.unique(bigrams(vocab, inv, lens), return_inverse=True)
                out: dict[str, list] = {"order": [], "bucket": [], "keys": [], "n": []}
                for order, keys, n in ((1, vocab, np.bincount(inv[train], minlength=len(vocab))), (2, two, np.bincount(back[train], minlength=len(two)))):
                    edges = np.searchsorted(keys, np.array([(i << 64) // buckets for i in range(buckets)], dtype=np.uint64)).tolist() + [len(keys)]
                    for i in range(buckets):
                        if edges[i + 1] > edges[i]:
                            out["order"].append(order)
                            out["bucket"].append(i)
                            out["keys"].append(packed_sorted(keys[edges[i] : edges[i + 1]]))
                            out["n"].append(packed(n[edges[i] : edges[i + 1]].astype(np.uint32)))
                yield pa.RecordBatch.from_arrays([pa.array([r["block"]] * len(out["order"]), pa.int64()), pa.array(out["order"], pa.int32()), pa.array(out["bucket"], pa.int32()), pa.array(out["keys"], pa.binary()), pa.array(out["n"], pa.binary())], names=["block", "order", "bucket", "keys", "n"])
    return run


def _replies(group: pa.Table) -> pa.Table:
    keys = [unpacked_sorted(k) for k in group.column("keys").to_pylist()]
    _, back = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(back, weights=np.concatenate([unpacked(n, np.uint32) for n in group.column("n").to_pylist()]).astype(float)).astype(np.int64)
    ends = np.cumsum([len(k) for k in keys])
    got = [packed(total[back[e - len(k) : e]].astype(np.uint64)) for e, k in zip(ends, keys)]
    zero = [0] * len(got)
    n, v = [int(total.sum()), *zero[1:]], [int((total > 0).sum()), *zero[1:]]
    return pa.table({"block": group.column("block"), "order": group.column("order"), "bucket": group.column("bucket"), "counts": pa.array(got, pa.binary()), "total": pa.array(n, pa.int64()), "kinds": pa.array(v, pa.int64())})


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the count of every word and, token by token, of its bigram."""
    for b in batches:
        for r in b.to_pylist():
            vocab, inv, lens = unpacked_sorted(r["vocab"]), unpacked(r["inv"], np.uint32), np.array(r["lens"], dtype=np.int64)
            parts = sorted(r["got"], key=lambda x: (x["order"], x["bucket"]))
            c1, c2 = (np.concatenate([unpacked(x["counts"], np.uint64) for x in parts if x["order"] == o] or [np.zeros(0, np.uint64)]) for o in (1, 2))
            _, back = np.unique(bigrams(vocab, inv, lens), return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array([r["ids"]], pa.list_(pa.int64())), pa.array([r["lens"]], pa.list_(pa.int32())), pa.array([r["train"]], pa.list_(pa.bool_())),
                pa.array([r["inv"]], pa.binary()), pa.array([packed(c1)], pa.binary()), pa.array([packed(c2[back])], pa.binary())], names=["ids", "lens", "train", "inv", "c1", "c2"])


def _tokens(r: dict, starts: int) -> tuple[np.ndarray, ...]:
    """Per token: its count, its context's count, the bigram's count, and the lengths of the texts."""
    lens = np.array(r["lens"], dtype=np.int64)
    c1 = unpacked(r["c1"], np.uint64).astype(np.int64)[unpacked(r["inv"], np.uint32)]
    context = np.empty_like(c1)
    context[1:] = c1[:-1]
    context[np.cumsum(lens) - lens] = starts
    return c1, context, unpacked(r["c2"], np.uint64).astype(np.int64), lens


def _context_bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(np.maximum(context, 0).astype(float))[1], CONTEXTS - 1)


def _cells(n: int, starts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                c1, context, c2, lens = _tokens(r, starts)
                train = np.repeat(np.array(r["train"], dtype=bool), lens)
                c1, context, c2 = c1[train] - 1, context[train] - 1, c2[train] - 1  # the token itself is deleted
                step = lambda p: np.where(p > 0, np.minimum((-np.log2(np.maximum(p, 1e-300)) * STEPS).astype(np.int64) + 1, OCTAVES * STEPS), 0)
                p2, p1 = np.where(context > 0, c2 / np.maximum(context, 1), 0.0), c1 / max(n - 1, 1)
                cell = (_context_bucket(context) * (OCTAVES * STEPS + 1) + step(p2)) * (OCTAVES * STEPS + 1) + step(p1)
                k, back, many = np.unique(cell, return_inverse=True, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(many, pa.int64()), pa.array(np.bincount(back, weights=p2, minlength=len(k)).astype(float)), pa.array(np.bincount(back, weights=p1, minlength=len(k)).astype(float))], names=["cell", "many", "s2", "s1"])
    return run


def mixture(cells: list, kinds: int, rounds: int = 60) -> np.ndarray:
    """Weights (bigram, unigram, uniform) for each context-frequency bucket, by expectation-maximisation."""
    weights = np.tile([0.3, 0.6, 0.1], (CONTEXTS, 1))
    if cells:
        cell, many, s2, s1 = (np.array(x, dtype=float) for x in zip(*cells))
        bucket = (cell // (OCTAVES * STEPS + 1) ** 2).astype(int)
        p = np.column_stack([s2 / many, s1 / many, np.full(len(many), 1 / (kinds + 1))])
        for _ in range(rounds):
            share = weights[bucket] * p
            share *= (many / np.maximum(share.sum(axis=1), 1e-300))[:, None]
            for j in range(3):
                weights[:, j] = np.bincount(bucket, weights=share[:, j], minlength=CONTEXTS) + (0.5, 0.5, 0.05)[j]
            weights /= weights.sum(axis=1, keepdims=True)
    weights[0] = [0, *(weights[0, 1:] / weights[0, 1:].sum())]  # an unseen context has no bigrams
    return weights


def _scores(n: int, kinds: int, starts: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                c1, context, c2, lens = _tokens(r, starts)
                base = np.log10((c1 + 0.5) / (n + 0.5 * (kinds + 1)))
                w = weights[_context_bucket(context)]
                p = w[:, 0] * np.where(context > 0, c2 / np.maximum(context, 1), 0.0) + w[:, 1] * (c1 / max(n, 1)) + w[:, 2] / (kinds + 1)
                at = np.cumsum(lens) - lens
                yield pa.RecordBatch.from_arrays([pa.array(r["ids"], pa.int64()), pa.array(lens), pa.array(np.add.reduceat((c1 > 0).astype(np.int64), at)), pa.array(np.full(len(lens), n, np.int64)), pa.array(np.add.reduceat(base, at)), pa.array(np.add.reduceat(np.log10(p), at))], names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def lm_scores(docs: DataFrame, train: str = "train") -> DataFrame:
    """One row per input row: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10).

    A null text is an empty text, whose only token is the end. Without training rows no token is known and the
    scores are those of the uniform estimate. Repeated rows count as often as they stand. Empty in, empty out.
    """
    spark = docs.sparkSession
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(rows, "10000")
    try:
        return _lm_scores(docs, train, lambda n: spark.conf.set(rows, str(n)))
    finally:
        spark.conf.set(rows, before)


def _lm_scores(docs: DataFrame, train: str, batch_rows: Callable[[int], None]) -> DataFrame:
    spark = docs.sparkSession
    batch_rows(3000)
    held = written(blocks(docs.select("doc_id", "text", F.coalesce(F.col(train), F.lit(False)).alias("train"))))
    size, n_blocks = held.agg(F.coalesce(F.sum(F.aggregate("lens", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0)), F.count("*")).first()
    buckets = max(12, math.ceil(size / TASK_TOKENS))
    batch_rows(4)  # a row is a block
    asked = held.select("block", "lens", "train", "vocab", "inv").mapInArrow(_requests(buckets), "block long, order int, bucket int, keys binary, n binary")
    # As many tasks as groups: the largest task stays as it is when the input grows.
    replies = written(asked.repartition(2 * buckets, "order", "bucket").groupBy("order", "bucket").applyInArrow(_replies, "block long, order int, bucket int, counts binary, total long, kinds long"))
    n, kinds = replies.filter(F.col("order") == 1).agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("kinds"), F.lit(0))).first()
    starts = held.agg(F.sum(F.size(F.filter("train", lambda x: x)))).first()[0] or 0
    freed(spark)
    got = replies.repartition(max(1, n_blocks), "block").groupBy("block").agg(F.collect_list(F.struct("order", "bucket", "counts")).alias("got"))
    counted = written(held.join(got, "block").mapInArrow(_counted, "ids array<long>, lens array<int>, train array<boolean>, inv binary, c1 binary, c2 binary"))
    dropped(held, replies)
    freed(spark)
    cells = counted.mapInArrow(_cells(n, starts), "cell long, many long, s2 double, s1 double").groupBy("cell").agg(F.sum("many"), F.sum("s2"), F.sum("s1"))
    weights = mixture([tuple(r) for r in cells.orderBy("cell").collect()], kinds)  # CONTEXTS * (OCTAVES * STEPS + 1) ** 2 cells at most
    out = written(counted.mapInArrow(_scores(n, kinds, starts, weights), "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double"))
    dropped(counted)
    return out


def op5_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("train", fold("doc_id", 5) != 1)
    return lm_scores(docs).withColumn("held_out", fold("doc_id", 5) == 1)
