"""Toxicity by weak supervision.

Voters are a fixed lexicon, words and word beginnings that a bounded sample of labelled rows shows to be telling,
and a few patterns. A generative label model estimates by expectation-maximisation, from the votes alone, how often
each voter fires on either class and how far voters repeat one another; given labels only say where it starts and
which class is which. Its posterior labels train a linear classifier over the votes, which scores every whole text.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._store import fold, small_batches, table, written

#: Labelled rows of either class that the model is fitted on, at most.
MAX_TOXIC, MAX_CLEAN = 2500, 5000
#: Rows of a voter's own class at least, and the share of clean rows that may hold a voter.
SUPPORT, NOISE, THRESHOLD, SEED = 4, 0.004, 0.3, 11
#: Correlation within a class from which two voters are held to repeat each other.
REPEATS = 0.8
#: Beginnings of words that are looked at, in letters.
PREFIXES = (3, 4, 5, 6)
LEXICON = ("idiot", "moron", "stupid", "scum", "trash", "pathetic", "worthless", "disgusting", "loser", "bastard", "bitch", "whore", "slut", "shit", "fuck", "asshole", "imbecile", "retard", "kill yourself", "vermin")
PATTERNS = {"shout": r"\b[A-Z]{4,}!{2,}", "you_are": r"(?i)\byou (?:are|re) (?:a|an|such)\b", "masked": r"\b\w+[*@#$]{2,}\w+\b"}
_TOKEN = re.compile(r"[^\W\d_]+")


def _signs(text: str) -> set[str]:
    """'w:' whole words and 'p:' beginnings of a text's words."""
    seen = set(_TOKEN.findall(text.lower()))
    return {f"w:{w}" for w in seen if len(w) >= 3} | {f"p:{w[:n]}" for w in seen for n in PREFIXES if len(w) > n}


class Voters:
    """Finds which voters fire on a text, in one pass over it for all words and beginnings."""

    def __init__(self, signs: list[str]) -> None:
        self.names = [*signs, *(f"l:{w}" for w in LEXICON), *(f"r:{k}" for k in PATTERNS)]
        at: dict[str, list[tuple[int, bool]]] = {}
        for i, name in enumerate(self.names):
            if name[0] in "wpl":
                at.setdefault(name[2:], []).append((i, name[0] != "p"))
        self.machine = ahocorasick.Automaton()
        for word, found in at.items():
            self.machine.add_word(word, (len(word), found))
        self.machine.make_automaton()
        self.patterns = [(self.names.index(f"r:{k}"), re.compile(p)) for k, p in PATTERNS.items()]

    def votes(self, text: str) -> dict[int, int]:
        low, out = text.lower(), Counter()
        for end, (n, found) in self.machine.iter(low):
            if end >= n and low[end - n].isalpha():
                continue
            inside = end + 1 < len(low) and low[end + 1].isalpha()
            for i, whole in found:
                if not (whole and inside):
                    out[i] += 1
        for i, p in self.patterns:
            if n := sum(1 for _ in p.finditer(text)):
                out[i] += n
        return out


def label_model(fires: np.ndarray, given: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of class 1 for each row, and each voter's weight.

    fires: rows x voters of 0 and 1; given: 1, 0 or -1 where nothing is known, the start and the names of the two
    classes; without labels class 1 is the one that voters fire on. Rates and dependences are estimated in every round from the posteriors: a voter's weight is one over
    the sum of its correlations, of those above REPEATS, with the voters within the classes, so ten voters that
    always fire together count as one. Rows with the same votes are one row with a count.
    """
    kinds, back, many = np.unique(fires, axis=0, return_inverse=True, return_counts=True)
    back, many = back.ravel(), many.astype(float)
    known = given >= 0
    post = np.bincount(back, weights=np.where(known, given, np.where(fires.any(axis=1), 0.5, 0.1)), minlength=len(kinds)) / many
    for turn in range(rounds):
        one, none = post * many, (1 - post) * many
        prior = np.clip(one.sum() / many.sum(), 1e-4, 1 - 1e-4)
        on1, on0 = (one @ kinds + 0.2) / (one.sum() + 4), (none @ kinds + 0.02) / (none.sum() + 4)
        # Covariance within the classes: E[xy] less the products of the rates.
        both = (kinds * many[:, None]).T @ kinds - np.outer(one @ kinds, on1) - np.outer(none @ kinds, on0)
        sd = np.sqrt(np.maximum(np.diag(both), 1e-9))
        tie = np.clip(both / np.outer(sd, sd), 0, 1)
        weight = 1 / np.maximum(1, (tie * (tie > REPEATS)).sum(0))
        odds = np.log(prior / (1 - prior)) + kinds @ (weight * (np.log(on1) - np.log(on0))) + (1 - kinds) @ (weight * (np.log1p(-on1) - np.log1p(-on0)))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        still = np.abs(new - post).max() < 1e-5
        post = new
        if still:
            break
    out = post[back]
    if known.any() and np.abs(out[known] - given[known]).mean() > 0.5:
        out = 1 - out
    return out, weight


def linear(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by accelerated gradient steps."""
    w, b, v = np.zeros(x.shape[1]), float(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))), np.zeros(x.shape[1] + 1)
    rate = 4 / (np.linalg.norm(x, 2) ** 2 / len(x) + 1 + 4 * ridge / len(x))
    for _ in range(rounds):
        e = 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - y
        v = 0.9 * v - rate * 0.3 * np.append(x.T @ e / len(x) + ridge * w / len(x), e.mean())
        w, b = w + v[:-1], b + v[-1]
    return w, b


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> str:
    """The model as JSON. labels: doc_id, toxic; contradicting or null labels of one doc_id are left out.

    The first rows by a seeded hash are taken, up to the bounds; of their texts only counts of signs and votes
    reach the driver. Without a toxic label every score is the prior's.
    """
    spark = docs.sparkSession
    small_batches(spark)
    given = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("m")).filter("toxic = m").drop("m")
    order = [F.xxhash64(F.lit(SEED), F.col("doc_id")), F.col("doc_id")]
    some = given.filter("toxic = 1").orderBy(*order).limit(max_toxic).unionByName(given.filter("toxic = 0").orderBy(*order).limit(max_clean))
    # At most max_toxic + max_clean ids, so the broadcast is bounded by parameters.
    chosen = written(some, 1)
    sample = written(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").repartition(16))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for b in batches:
            for text, y in zip(b["text"], b["toxic"]):
                seen[y].update(_signs(text or ""))
        yield pd.DataFrame([(s, y, n) for y in (0, 1) for s, n in seen[y].items()], columns=["sign", "y", "n"])

    totals = {r[0]: r[1] for r in chosen.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    signs = sample.filter("toxic >= 0").mapInPandas(count, "sign string, y int, n long").groupBy("sign").agg(
        F.sum(F.expr("if(y = 1, n, 0)")).alias("on1"), F.sum(F.expr("if(y = 0, n, 0)")).alias("on0"))
    telling = signs.filter((F.col("on1") >= min(SUPPORT, max(2, n1 // 20))) & (F.col("on0") <= NOISE * max(n0, 1)) & (F.col("on1") * max(n0, 1) >= 20 * max(n1, 1) * F.col("on0")))
    mined = [r[0] for r in telling.orderBy(F.desc("on1"), F.length("sign"), "sign").collect()]
    voters = Voters(mined)

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = Voters(mined)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "toxic": b["toxic"], "fired": [json.dumps(sorted(v.votes(t or ""))) for t in b["text"]]})

    votes = sample.mapInPandas(vote, "doc_id long, toxic int, fired string").orderBy("doc_id").collect()
    fires = np.zeros((max(len(votes), 1), len(voters.names)), dtype=float)
    for i, r in enumerate(votes):
        fires[i, json.loads(r[2])] = 1
    y = np.array([r[1] for r in votes] or [0])
    post, weight = label_model(fires, y)
    w, b = linear(fires * np.sqrt(weight), post)
    return json.dumps({"signs": mined, "w": (w * np.sqrt(weight)).tolist(), "b": b})


def score(docs: DataFrame, model: str, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted for every row of docs; null text scores as empty text."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = json.loads(model)
        v, w, b = Voters(m["signs"]), m["w"], m["b"]
        for batch in batches:
            z = np.array([b + sum(w[i] for i in v.votes(t or "")) for t in batch["text"]], dtype=float)
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": s, "predicted": (s >= threshold).astype(np.int32)})

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, score double, predicted int")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without the rows that are predicted toxic; columns and repeated rows stay as they are."""
    small_batches(docs.sparkSession)
    model = fit(docs, labels)

    def run(batches):
        m = json.loads(model)
        v, w, b = Voters(m["signs"]), m["w"], m["b"]
        limit = np.log(THRESHOLD / (1 - THRESHOLD))
        for batch in batches:
            keep = [b + sum(w[i] for i in v.votes(t or "")) < limit for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit(docs, labels.filter(fold("doc_id", 4) != 2))
    return score(docs, model).withColumn("held_out", fold("doc_id", 4) == 2)
