"""Words of whole Arrow batches as 64-bit hashes, found with numpy on the batch's bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SEPARATES = np.zeros(256, dtype=bool)
_SEPARATES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers)), _BASE, dtype=np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


@dataclass
class Words:
    """hash, start and end byte of each word; rows[i]:rows[i + 1] are the words of row i; data: lower-cased bytes."""

    data: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    rows: np.ndarray


def words(texts: pa.Array, keep_case: bool = False) -> Words:
    """Words of every text, A-Z lower-cased; null texts have none."""
    texts = pa.array(texts.fill_null("") if texts.null_count else texts, type=pa.large_string()) if texts.type != pa.large_string() else texts.fill_null("")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, dtype=np.uint8)
    off = off - off[0]
    low = raw if keep_case else _LOWER[raw]
    solid = ~_SEPARATES[raw]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    edges = off[(off > 0) & (off < len(raw))]
    first[edges] = solid[edges]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    last[edges - 1] = solid[edges - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if not len(start):
        return Words(low, np.zeros(0, np.uint64), start, end, np.zeros(len(off), np.int64))
    lengths = end - start
    at = np.cumsum(lengths) - lengths
    within = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
    values = (low[solid].astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[within]
    hashes = mix(np.add.reduceat(values, at) ^ lengths.astype(np.uint64))
    return Words(low, hashes, start, end, np.searchsorted(start, off))


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about `most` bytes of text, or one row."""
    for batch in batches:
        sizes = np.cumsum(batch.column(column).fill_null("").cast(pa.large_binary()).to_pandas().str.len().to_numpy(np.int64)) if len(batch) else []
        at = 0
        while at < len(batch):
            done = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, done + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def shingle_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n words; all words as one run if there are fewer, none without words."""
    k = min(n, len(h))
    if not k:
        return h
    out = np.zeros(len(h) - k + 1, dtype=np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(3) + h[i : len(h) - k + 1 + i])
    return out


def groups(batches: Iterator[pa.RecordBatch], names: tuple) -> Iterator[tuple[tuple, dict]]:
    """Runs of equal keys from batches sorted by them, also across batches."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        if not len(t):
            continue
        keys = np.stack([t.column(c).to_numpy() for c in names])
        cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist()]
        for s, e in zip(cuts, cuts[1:]):
            yield tuple(keys[:, s].tolist()), t.slice(s, e - s)
        held = t.slice(cuts[-1])
    if held is not None and len(held):
        yield tuple(held.column(c)[0].as_py() for c in names), held
