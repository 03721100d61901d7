"""Toxicity by FTRL-proximal logistic regression over hashed word features.

Features of a text, each present or not: its words, word pairs, word pairs
with one word between them, and word stems (first bytes), hashed into
``2 ** BITS`` coordinates. Words are the lower-cased text cut at white space
and ASCII punctuation. Presence and an L1 penalty keep neutral coordinates at
exactly zero, so a long text does not dilute a toxic one and the weights are
a short list that travels with the scoring tasks.

The classifier is fitted on at most ``SAMPLE`` labelled rows, those with the
smallest id hashes; their features are made in parallel, the sequential FTRL
passes run in one task over that bounded table. Scoring covers every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratebook.llm.common import prepare

BITS = 20
STEM = 4
SAMPLE = 20_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 1.0
CACHE = 50_000
PUNCTUATION = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)


def log_odds(ones: float, rows: int) -> float:
    """Log odds of label 1 among the rows, one in ten without rows."""
    return float(np.log((ones + 1) / (rows - ones + 9)))


@dataclass
class Weights:
    ids: np.ndarray
    values: np.ndarray
    bias: float


class Features:
    """Hashed coordinates of texts, with the words' hashes remembered."""

    def __init__(self):
        self.cache: dict[bytes, tuple[int, int]] = {}

    def _hashes(self, words: list[bytes]) -> np.ndarray:
        cache, digest = self.cache, xxhash.xxh64_intdigest
        if len(cache) > CACHE:
            cache.clear()
        out = []
        for w in words:
            h = cache.get(w)
            if h is None:
                h = cache[w] = (digest(w, 1), digest(w[:STEM], 2))
            out.append(h)
        return np.array(out, dtype=np.uint64)

    def __call__(self, text: str) -> np.ndarray:
        """All coordinates, repeats included."""
        words = text.lower().encode("utf-8", "surrogatepass").translate(PUNCTUATION).split()
        if not words:
            return np.zeros(0, np.int64)
        h = self._hashes(words)
        word, stem = h[:, 0], h[:, 1]
        pair = word[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[1:]
        skip = word[:-2] * np.uint64(0xC2B2AE3D27D4EB4F) + word[2:]
        every = np.concatenate([word, stem, pair, skip])
        return ((every ^ (every >> np.uint64(29))) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def ftrl(rows: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Weights:
    """FTRL-proximal passes over (distinct coordinates, label) in given order."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    zb = nb = 0.0
    prior = log_odds(labels.sum(), len(labels))

    def weight(z, n, l1):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(epochs):
        for x, y in zip(rows, labels):
            w, b = weight(z[x], n[x], L1), float(weight(zb, nb, 0.0))
            g = 1 / (1 + np.exp(-np.clip(w.sum() + prior + b, -35, 35))) - y
            root = np.sqrt(n[x] + g * g)
            z[x] += g - (root - np.sqrt(n[x])) / ALPHA * w
            n[x] += g * g
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / ALPHA * b
            nb += g * g
    w = weight(z, n, L1)
    ids = np.flatnonzero(w)
    return Weights(ids, w[ids], prior + float(weight(zb, nb, 0.0)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", sample: int = SAMPLE) -> Weights:
    """Weights from ``labels`` (id, 0/1) joined to ``docs``. Null labels and
    labels without a text are left out; an id labelled twice counts once, 1
    before 0. Without usable rows every score is 0.1."""
    prepare(docs.sparkSession)
    chosen = (labels.select(labels[id_col].cast("long").alias("__id"), labels[label_col].cast("int").alias("y"))
              .where("__id is not null and y in (0, 1)").groupBy("__id").agg(F.max("y").alias("y"))
              .orderBy(F.xxhash64("__id"), "__id").limit(sample))

    def features(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Features()
        for pdf in it:
            yield pd.DataFrame({"o": pdf["o"], "y": pdf["y"], "x": [np.unique(make(t)).astype(np.int32) for t in pdf["text"]]})

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, y = [], []
        for pdf in batches:
            x += [np.array(v, np.int32) for v in pdf["x"]]
            y += pdf["y"].tolist()
        if x:
            got = ftrl(x, np.array(y, np.float64))
            yield pd.DataFrame({"i": np.r_[-1, got.ids], "w": np.r_[got.bias, got.values]})

    texts = docs.select(docs[id_col].cast("long").alias("__id"), docs[text_col].alias("text")).where("text is not null")
    # At most ``sample`` ids: a fixed bound.
    rows = (texts.join(F.broadcast(chosen), "__id").select(F.xxhash64("__id").alias("o"), "y", "text")
            .mapInPandas(features, "o long, y int, x array<int>"))
    # The passes are sequential, over at most ``sample`` rows, read as a stream.
    found = rows.repartition(1).sortWithinPartitions("o").mapInPandas(train, "i long, w double").toPandas()
    if found.empty:
        return Weights(np.zeros(0, np.int64), np.zeros(0), log_odds(0, 0))
    bias = float(found.loc[found["i"] < 0, "w"].iloc[0])
    found = found[found["i"] >= 0]
    return Weights(found["i"].to_numpy(np.int64), found["w"].to_numpy(), bias)


def score(docs: DataFrame, weights: Weights, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """``docs`` with the probability of the label in ``out_col``; a null or
    empty text gets what the bias alone gives. Rows and columns stay."""
    prepare(docs.sparkSession)

    @F.pandas_udf("double")
    def prob(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        make, dense = Features(), np.zeros(1 << BITS)
        dense[weights.ids] = weights.values
        for texts in batches:
            out = np.empty(len(texts))
            for i, t in enumerate(texts):
                x = make(t or "")
                x = np.unique(x[dense[x] != 0])
                out[i] = dense[x].sum() + weights.bias
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return docs.withColumn(out_col, prob(F.col(text_col)))
