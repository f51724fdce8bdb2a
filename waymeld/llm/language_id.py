"""Language identification by unigrams over pieces, summed over all segmentations.

A fixed public vocabulary of byte pieces gets one probability per piece and language, learned by
expectation-maximisation over all segmentations of the training words. A word's probability in a language is the
forward sum over every way to cut it into pieces; the words of a text multiply, and the languages' priors turn
that into a posterior. Words never share pieces, so each distinct word of a batch is summed once, for all
languages together, by numpy over all words of one length.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import fold, small_batches, table
from ._words import mix, pieces, powers, words

#: Public vocabulary of byte pieces, read where fit() runs; training rows of a language, about.
VOCABULARY, MAX_ROWS, SEED = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken", 400, 5
#: Bytes of a word from which it is summed on its own, and of the parts that longer words are cut into for learning.
LONG, PART = 256, 48
UNKNOWN = "und"


def read_vocabulary(path: str = VOCABULARY) -> list[bytes]:
    """All pieces that can stand in a lower-cased word with a space in front, and every single byte."""
    if not os.path.exists(path):
        raise FileNotFoundError(f"no vocabulary of byte pieces at {path}; give another as `vocabulary`")
    with open(path, "rb") as f:
        found = {base64.b64decode(line.split()[0]) for line in f if line.strip()}
    return sorted({p for p in found if p and p == p.lower() and not re.search(rb"[\x09-\x0d]|. ", p, re.S)} | {bytes([b]) for b in range(256)})


def trie(vocabulary: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all beginnings of the pieces, sorted, and the piece that each is, or -1."""
    nodes: dict[bytes, int] = {}
    for i, p in enumerate(vocabulary):
        for n in range(1, len(p)):
            nodes.setdefault(p[:n], -1)
        nodes[p] = i
    sizes = np.array([len(p) for p in nodes])
    data = np.frombuffer(b"".join(nodes), dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    at = np.cumsum(sizes) - sizes
    within = np.arange(len(data)) - np.repeat(at, sizes)
    hashes = mix(np.add.reduceat(data * powers(int(sizes.max()))[within], at) ^ sizes.astype(np.uint64))
    order = np.argsort(hashes)
    return hashes[order], np.array(list(nodes.values()), dtype=np.int64)[order]


class Lattice:
    """Beginnings of pieces by hash, for looking up the substrings of many words at once."""

    def __init__(self, hashes: np.ndarray, piece: np.ndarray, longest: int) -> None:
        self.hashes, self.piece, self.longest = hashes, piece, longest

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a longer or equal piece begins so, and the piece itself or -1."""
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        known = self.hashes[at] == h
        return known, np.where(known, self.piece[at], -1)

    def arcs(self, block: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """start, end, words and their pieces, for a matrix of words of one length, by start."""
        length, power = block.shape[1], powers(self.longest)
        values = block.astype(np.uint64) + np.uint64(1)
        for i in range(length):
            live, h = np.arange(len(block)), np.zeros(len(block), dtype=np.uint64)
            for n in range(1, min(self.longest, length - i) + 1):
                h = h + values[live, i + n - 1] * power[n - 1]
                known, piece = self.find(mix(h ^ np.uint64(n)))
                hit = np.flatnonzero(piece >= 0)
                if len(hit):
                    yield i, i + n, live[hit], piece[hit]
                live, h = live[known], h[known]
                if not len(live):
                    break

    def forward(self, block: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Log-probability of each word in each language; p: pieces x languages."""
        n, length = block.shape
        if length > LONG:
            return np.array([self.forward_long(word, p) for word in block])
        alpha = np.zeros((length + 1, n, p.shape[1]))
        alpha[0], scale, done = 1.0, np.zeros((n, 1)), 0
        for i, j, hit, piece in self.arcs(block):
            if i >= done + 12:  # long words: keep what is still open near 1
                most = np.maximum(alpha[i : i + self.longest + 1].max(axis=(0, 2)), 1e-290)
                alpha[i : i + self.longest + 1] /= most[None, :, None]
                scale[:, 0] += np.log(most)
                done = i
            alpha[j, hit] += alpha[i, hit] * p[piece]
        return np.log(np.maximum(alpha[length], 1e-300)) + scale

    def forward_long(self, word: np.ndarray, p: np.ndarray) -> np.ndarray:
        """The same for one long word: its arcs are found for all places at once, and only open sums are held."""
        length, power, ring = len(word), powers(self.longest), self.longest + 1
        values = word.astype(np.uint64) + np.uint64(1)
        live, h, found = np.arange(length), np.zeros(length, dtype=np.uint64), []
        for n in range(1, min(self.longest, length) + 1):
            ok = live + n <= length
            live, h = live[ok], h[ok]
            h = h + values[live + n - 1] * power[n - 1]
            known, piece = self.find(mix(h ^ np.uint64(n)))
            hit = piece >= 0
            found.append((live[hit], np.full(int(hit.sum()), n), piece[hit]))
            live, h = live[known], h[known]
            if not len(live):
                break
        start, size, piece = (np.concatenate(x) for x in zip(*found))
        order = np.argsort(start, kind="stable")
        size, piece = size[order], piece[order]
        cuts = np.searchsorted(start[order], np.arange(length + 1)).tolist()
        alpha, scale = np.zeros((ring, p.shape[1])), 0.0
        alpha[0] = 1.0
        for i in range(length):
            s, e = cuts[i], cuts[i + 1]
            here = alpha[i % ring].copy()
            alpha[i % ring] = 0.0
            alpha[(i + size[s:e]) % ring] += here * p[piece[s:e]]
            if i % 12 == 11:
                most = max(alpha.max(), 1e-290)
                alpha /= most
                scale += np.log(most)
        return np.log(np.maximum(alpha[length % ring], 1e-300)) + scale


def by_length(data: np.ndarray, start: np.ndarray, end: np.ndarray, most: int = 40_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words as matrices of one length each, a space in front: which words, and their bytes."""
    sizes = end - start
    for size in np.unique(sizes):
        every = np.flatnonzero(sizes == size)
        for at in range(0, len(every), max(1, most * 8 // int(size))):
            which = every[at : at + max(1, most * 8 // int(size))]
            block = np.full((len(which), size + 1), 32, dtype=np.uint8)
            block[:, 1:] = data[start[which][:, None] + np.arange(size)]
            yield which, block


def learn(found: list[bytes], counts: np.ndarray, lattice: Lattice, n_pieces: int, rounds: int = 4) -> np.ndarray:
    """Expected uses of each piece, by expectation-maximisation over all segmentations of the words."""
    data = np.frombuffer(b"".join(found), dtype=np.uint8)
    sizes = np.array([len(w) for w in found], dtype=np.int64)
    parts = -(-sizes // PART)
    own = np.repeat(np.arange(len(sizes)), parts)
    at = (np.arange(len(own)) - np.repeat(np.cumsum(parts) - parts, parts)) * PART
    start = np.repeat(np.cumsum(sizes) - sizes, parts) + at
    blocks = [(counts[own[which]], block) for which, block in by_length(data, start, start + np.minimum(PART, sizes[own] - at))]
    arcs = [(c, b.shape, list(lattice.arcs(b))) for c, b in blocks]
    use = np.zeros(n_pieces)
    for c, _, found_arcs in arcs:
        for _, _, hit, piece in found_arcs:
            use += np.bincount(piece, weights=c[hit], minlength=n_pieces)
    for _ in range(rounds):
        p = (use + 1e-6) / (use.sum() + 1e-6 * n_pieces)
        use = np.zeros(n_pieces)
        for c, (n, size), found_arcs in arcs:
            alpha, beta = np.zeros((size + 1, n)), np.zeros((size + 1, n))
            alpha[0] = beta[size] = 1.0
            for i, j, hit, piece in found_arcs:
                alpha[j, hit] += alpha[i, hit] * p[piece]
            for i, j, hit, piece in reversed(found_arcs):
                beta[i, hit] += beta[j, hit] * p[piece]
            total = np.maximum(alpha[size], 1e-300)
            for i, j, hit, piece in found_arcs:
                use += np.bincount(piece, weights=c[hit] * alpha[i, hit] * p[piece] * beta[j, hit] / total[hit], minlength=n_pieces)
    return use


def fit(train: DataFrame, vocabulary: str = VOCABULARY, max_rows: int = MAX_ROWS, seed: int = SEED) -> dict:
    """Languages, log priors, the vocabulary's trie and the pieces' probabilities. train: doc_id, text, lang.

    Priors count all rows. Piece probabilities are fitted on all words of about max_rows rows of each language,
    drawn by a seeded hash; words longer than PART bytes are cut there for this. No row with a language: no languages.
    """
    small_batches(train.sparkSession)
    named = train.filter(F.col("lang").isNotNull())
    counts = {r[0]: r[1] for r in named.groupBy("lang").count().collect()}
    if not counts:
        return {"langs": []}
    million = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1_000_000))
    share = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1_000_000, 1_000_000 * max_rows // n + 1)))])
    sample = named.filter(million < F.element_at(share, F.col("lang"))).select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            w = words(batch.column("text"))
            row = np.searchsorted(w.rows, np.arange(len(w.hash)), side="right") - 1
            for lang in set(langs):
                mine = np.flatnonzero(langs[row] == lang) if len(row) else []
                if len(mine):
                    _, at, n = np.unique(w.hash[mine], return_index=True, return_counts=True)
                    at = mine[at]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array([w.data[s:e].tobytes() for s, e in zip(w.start[at], w.end[at])], pa.binary()), pa.array(n, pa.int64())], names=["lang", "word", "n"])

    langs, pieces_ = sorted(counts), read_vocabulary(vocabulary)
    hashes, piece = trie(pieces_)
    longest = max(map(len, pieces_))

    def learned(group: pd.DataFrame) -> pd.DataFrame:
        found = group.groupby("word", sort=True)["n"].sum()
        use = learn([bytes(w) for w in found.index], found.to_numpy(dtype=float), Lattice(hashes, piece, longest), len(pieces_))
        at = np.flatnonzero(use > 1e-6)
        return pd.DataFrame({"lang": group["lang"].iloc[0], "piece": at, "uses": use[at]})

    # One scan for all languages; at most pieces x languages rows reach the driver.
    use = np.zeros((len(pieces_), len(langs)))
    for lang, at, n in sample.mapInArrow(count, "lang string, word binary, n long").groupBy("lang").applyInPandas(learned, "lang string, piece int, uses double").collect():
        use[at, langs.index(lang)] = n
    p = (use + 0.02) / (use + 0.02).sum(axis=0)
    total = sum(counts.values())
    return {"langs": langs, "prior": np.log([counts[k] / total for k in langs]), "hashes": hashes, "piece": piece, "longest": longest, "p": p}


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score of every row; 'und' with score 0 where the text is null or has no letter."""
    spark = docs.sparkSession
    small_batches(spark, 3000)
    shared = spark.sparkContext.broadcast(model)  # the vocabulary's pieces times the languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        lattice = Lattice(m["hashes"], m["piece"], m["longest"]) if m["langs"] else None
        for batch in pieces(batches):
            texts = batch.column("text")
            w = words(texts)
            letter = np.zeros(len(w.data) + 1, dtype=np.int64)
            letter[1:] = np.cumsum((w.data >= 97) & (w.data <= 122))
            at, to = w.rows[:-1], w.rows[1:]
            has = np.zeros(len(batch), dtype=bool)
            some = to > at
            has[some] = letter[w.end[to[some] - 1]] > letter[w.start[at[some]]]
            for i in np.flatnonzero(~has & some):
                has[i] = any(c.isalpha() for c in texts[int(i)].as_py())
            best, score = np.full(len(batch), -1), np.zeros(len(batch))
            if lattice is not None and len(w.hash):
                _, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
                table_ = np.zeros((len(first), len(m["langs"])))
                for which, block in by_length(w.data, w.start[first], w.end[first], max(1000, 160_000 // len(m["langs"]))):
                    table_[which] = lattice.forward(block, m["p"])
                sums = np.zeros((len(w.hash) + 1, len(m["langs"])))
                np.cumsum(table_[back], axis=0, out=sums[1:])
                z = sums[to] - sums[at] + m["prior"]
                best, z = z.argmax(axis=1), z - z.max(axis=1, keepdims=True)
                score = 1 / np.exp(z).sum(axis=1)
            ok = has & (best >= 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([m["langs"][b] if o else UNKNOWN for b, o in zip(best, ok)], pa.string()), pa.array(np.where(ok, score, 0.0))], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.filter(fold("doc_id", 3) != 1).select("doc_id", "text", "lang"))
    return predict(docs, model).withColumn("held_out", fold("doc_id", 3) == 1)
