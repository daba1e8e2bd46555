"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text, each counted once: words, word stems (the first 4, 5 and 6 letters of longer words),
bigrams, and skip-grams over one word in between, hashed into 2**BITS weights. FTRL-proximal keeps a rate
per coordinate; its L1 term leaves most weights at exactly zero, and only the others are broadcast.

Learnt from a bounded sample (`PER_CLASS` labelled documents of either class, see labelled.sample); labels,
language, source and ids are no inputs. Score: estimated chance of label 1.

Defined results: null texts count as empty (score from the bias alone); without usable labels every score
is 0.5; repeated rows score alike; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakewright.llm import common, labelled

PER_CLASS = 4000
MOD, OUT = 3, 1
THRESHOLD = 0.7
BITS = 21
EPOCHS, ALPHA, BETA, L1, L2 = 8, 0.6, 1.0, 2.0, 0.0
WORDS = re.compile(r"[^\W\d_]+")


class Features:
    """Whole text -> sorted distinct feature numbers."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, ...]] = {}
        self.hashes = common.WordHashes()

    def __call__(self, text: str | None) -> np.ndarray:
        words = WORDS.findall(text.lower()) if text else []
        if not words:
            return np.zeros(0, np.int32)
        h = self.hashes.array([w.encode("utf-8", "replace") for w in words])
        stems = [w[:k].encode("utf-8", "replace") for w in set(words) for k in (4, 5, 6) if len(w) > k]
        parts = [common.mix(h, 1), common.mix(common.mix(h[:-1], h[1:]), 2), common.mix(common.mix(h[:-2], h[2:]), 3)]
        if stems:
            parts.append(common.mix(self.hashes.array(list(set(stems))), 4))
        return np.unique(np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int32)


class Model:
    """Bias and the weights that are not zero, by sorted feature number."""

    def __init__(self, bias: float, at: np.ndarray, weight: np.ndarray) -> None:
        self.bias, self.at, self.weight = bias, at.astype(np.int32), weight.astype(np.float32)

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS, np.float32)
        w[self.at] = self.weight
        return w


def fit(sets: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> Model:
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1.0)
        return Model(float(np.log(share / (1 - share))), np.zeros(0, int), np.zeros(0))
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    bias_at = 1 << BITS
    order = np.random.default_rng(seed)

    def weights(i: np.ndarray) -> np.ndarray:
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    def bias() -> float:
        return -z[bias_at] / ((BETA + np.sqrt(n[bias_at])) / ALPHA)

    for _ in range(epochs):
        for k in order.permutation(len(y)):
            i = sets[k]
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias(), -35, 35)))
            g = p - y[k]
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA
            z[i] += g - step * w
            n[i] += g * g
            step = (np.sqrt(n[bias_at] + g * g) - np.sqrt(n[bias_at])) / ALPHA
            z[bias_at] += g - step * bias()
            n[bias_at] += g * g
    every = np.flatnonzero(np.abs(z[:bias_at]) > L1)
    return Model(float(bias()), every, weights(every))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    rows = labelled.sample(docs, labels, "toxic", MOD, OUT, per_class)
    features = Features()
    return fit([features(t) for t in rows["text"]], rows["label"].to_numpy(float))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, dense, bias = Features(), sent.value.dense(), sent.value.bias
        for batch in batches:
            margin = np.array([bias + float(dense[features(t)].sum()) for t in batch.column("body").to_pylist()], float)
            yield labelled.scored(batch, 1 / (1 + np.exp(-np.clip(margin, -40, 40))), THRESHOLD)

    return labelled.scoring_rows(docs, MOD, OUT).mapInArrow(common.released(run), labelled.SCORED)


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
