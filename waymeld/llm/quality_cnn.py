"""Quality classifier: a byte-level convolutional network, trained and run in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. Bytes are embedded, learned filters
slide over each chunk, each filter keeps its largest response, and a small hidden layer reads these. The hidden
vectors of all chunks are combined by their mean and their maximum into one probability.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import fold, small_batches, table
from ._words import pieces

#: Bytes of a chunk and from one chunk to the next; bytes that a filter moves by (it sees two such blocks).
CHUNK, STEP, BLOCK = 256, 192, 4
#: Size of a byte's embedding, filters, hidden units.
EMBED, FILTERS, HIDDEN = 6, 16, 16
#: Labelled rows of either class that the network is fitted on, at most, each with its whole text.
MAX_ROWS, SEED, THRESHOLD = 900, 3, 0.5
#: Passes over the rows that the network learns from, and the least number of steps where rows are few.
EPOCHS, STEPS = 8, 300


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunks of every row as a matrix of bytes, zeros after a row's end, and the row of each chunk."""
    sizes = np.diff(offsets)
    many = np.maximum(1, -(-np.maximum(sizes - (CHUNK - STEP), 1) // STEP))
    row = np.repeat(np.arange(len(sizes)), many)
    within = (np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)) * STEP
    at = (offsets[:-1][row] + within)[:, None] + np.arange(CHUNK)
    padded = np.append(data, np.uint8(0))
    return padded[np.where(at < offsets[1:][row][:, None], at, len(data))], row


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.fill_null("").cast(pa.large_binary())
    _, off, data = texts.buffers()
    off = np.frombuffer(off, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return (np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)), off - off[0]


class Network:
    def __init__(self, seed: int = SEED) -> None:
        g = np.random.default_rng(seed)
        wide = BLOCK * EMBED
        self.p = {"e": g.normal(0, 0.5, (256, EMBED)), "a": g.normal(0, 1 / math.sqrt(2 * wide), (wide, FILTERS)), "c": g.normal(0, 1 / math.sqrt(2 * wide), (wide, FILTERS)), "f": np.zeros(FILTERS),
                  "h": g.normal(0, 1 / math.sqrt(FILTERS), (FILTERS, HIDDEN)), "g": np.zeros(HIDDEN), "o": g.normal(0, 0.2, 2 * HIDDEN), "b": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.shift = 0.0

    def pooled(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = self.p
        z = p["e"][x].reshape(len(x) * (CHUNK // BLOCK), BLOCK * EMBED)
        first, second = (z @ p["a"]).reshape(len(x), -1, FILTERS), (z @ p["c"]).reshape(len(x), -1, FILTERS)
        seen = first[:, :-1] + second[:, 1:]
        at = seen.argmax(axis=1)
        top = np.take_along_axis(seen, at[:, None], axis=1)[:, 0] + p["f"]
        return np.maximum(top, 0), at, z.reshape(len(x), -1, BLOCK * EMBED)

    def forward(self, x: np.ndarray, row: np.ndarray, n: int) -> tuple:
        p = self.p
        top, at, z = self.pooled(x)
        hid = np.tanh(top @ p["h"] + p["g"])
        many = np.bincount(row, minlength=n)
        starts = np.cumsum(many) - many
        mean, most = np.add.reduceat(hid, starts) / many[:, None], np.maximum.reduceat(hid, starts)
        return np.hstack([mean, most]) @ p["o"] + p["b"][0], (top, at, z, hid, many, mean, most)

    def logits(self, data: np.ndarray, offsets: np.ndarray, most: int = 2048) -> np.ndarray:
        """One logit per row over all of its chunks, some chunks at a time."""
        x, row = chunks(data, offsets)
        hid = np.vstack([np.tanh(self.pooled(x[i : i + most])[0] @ self.p["h"] + self.p["g"]) for i in range(0, len(x), most)])
        many = np.bincount(row, minlength=len(offsets) - 1)
        starts = np.cumsum(many) - many
        both = np.hstack([np.add.reduceat(hid, starts) / many[:, None], np.maximum.reduceat(hid, starts)])
        return both.astype(float) @ self.p["o"] + float(self.p["b"][0]) + self.shift

    def gradients(self, x: np.ndarray, row: np.ndarray, y: np.ndarray) -> dict:
        p, n = self.p, len(y)
        z_out, (top, at, z, hid, many, mean, most) = self.forward(x, row, n)
        d = ((1 / (1 + np.exp(-np.clip(z_out, -30, 30))) - y) / n).astype(np.float32)
        g = {"o": np.hstack([mean, most]).T @ d, "b": d.sum(keepdims=True)}
        back = d[:, None] * p["o"]
        dh = (back[:, :HIDDEN] / many[:, None])[row] + back[row, HIDDEN:] * (hid == most[row])
        dh = dh * (1 - hid * hid)
        g |= {"h": top.T @ dh, "g": dh.sum(0)}
        dt = (dh @ p["h"].T) * (top > 0)
        g["f"] = dt.sum(0)
        i = np.arange(len(x))[:, None]
        g["a"] = np.einsum("nfw,nf->wf", z[i, at], dt)
        g["c"] = np.einsum("nfw,nf->wf", z[i, at + 1], dt)
        g["e"] = np.zeros_like(p["e"])
        for name, move in (("a", 0), ("c", 1)):
            dz = (dt[:, :, None] * p[name].T[None]).reshape(len(x), FILTERS, BLOCK, EMBED)
            seen = x[i[:, :, None], ((at + move) * BLOCK)[:, :, None] + np.arange(BLOCK)]
            for k in range(EMBED):
                g["e"][:, k] += np.bincount(seen.ravel(), weights=dz[..., k].ravel(), minlength=256).astype(np.float32)
        return g

    def train(self, texts: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, steps: int = STEPS, batch: int = 48, rate: float = 0.006) -> None:
        """texts: each row's chunks; Adam on small batches in a seeded order."""
        epochs = max(epochs, math.ceil(steps * batch / len(texts)))
        g = np.random.default_rng(SEED)
        m1, m2, step = {k: np.zeros_like(v) for k, v in self.p.items()}, {k: np.zeros_like(v) for k, v in self.p.items()}, 0
        for epoch in range(epochs):
            order = g.permutation(len(texts))
            for s in range(0, len(order), batch):
                pick = order[s : s + batch]
                grads = self.gradients(np.vstack([texts[i] for i in pick]), np.repeat(np.arange(len(pick)), [len(texts[i]) for i in pick]), y[pick])
                step += 1
                for k, d in grads.items():
                    m1[k] = 0.9 * m1[k] + 0.1 * d
                    m2[k] = 0.99 * m2[k] + 0.01 * d * d
                    self.p[k] = (self.p[k] - rate * (1 - epoch / epochs * 0.8) * (m1[k] / (1 - 0.9**step)) / (np.sqrt(m2[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Network:
    """labels: doc_id, quality; null or contradicting labels of a doc_id are left out. With one class only, the score is its prior."""
    small_batches(docs.sparkSession)
    given = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("m")).filter("y = m").drop("m")
    total = {r[0]: r[1] for r in given.groupBy("y").count().collect()}
    net = Network()
    net.shift = math.log((total.get(1, 0) + 1) / (total.get(0, 0) + 1))
    order = [F.xxhash64(F.lit(SEED), F.col("doc_id")), F.col("doc_id")]
    chosen = given.filter("y = 1").orderBy(*order).limit(max_rows).unionByName(given.filter("y = 0").orderBy(*order).limit(max_rows))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("y"), b.column("text").fill_null("").cast(pa.large_binary()).cast(pa.binary())], names=["doc_id", "y", "x"])

    # The texts of at most 2 * max_rows labelled rows reach the driver, as their bytes.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").mapInArrow(cut, "doc_id long, y int, x binary").orderBy("doc_id", "x").collect()
    y = np.array([r[1] for r in rows], dtype=np.float32)
    if len(set(y)) == 2:
        net.train([chunks(np.frombuffer(r[2], np.uint8), np.array([0, len(r[2])]))[0] for r in rows], y)
        net.shift -= math.log(y.sum() / (len(y) - y.sum()))
    else:
        net.p = {k: np.zeros_like(v) for k, v in net.p.items()}
    return net


def score(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every row; a null text is an empty text, which is one chunk of zeros."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, most=1 << 20):
            s = 1 / (1 + np.exp(-np.clip(net.logits(*buffers(b.column("text"))), -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, predicted int")


def op9_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = fit(docs, labels.filter(fold("doc_id", 3) != 1))
    return score(docs, net).withColumn("held_out", fold("doc_id", 3) == 1)
