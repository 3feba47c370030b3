"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms, hashed to buckets. Its score is the logistic of a
bias, a weight for each bucket and, for each pair of buckets, the product of
their factor vectors: pairs that only hurt together, such as an insult and the mention of a
group, count as pairs. The pair sum needs no pairs, as it is half of the square
of the factor sum less the sum of the factors' squares.

The machine is learned from a sample of about ``TRAINING_ROWS`` labelled rows, chosen
by a hash of the id; that is what the driver holds, as bucket numbers. Scoring is one
pass over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_columns, slices, texts_of
from .decontamination import words_of

#: Labelled rows that the machine is learned from, about.
TRAINING_ROWS = 16_000
BUCKETS, FACTORS = 1 << 18, 4
#: A bucket is learned if this many texts of the sample have it and its share of label 1 is so many standard deviations
#: from what it would be by chance; the thousands of others would only add noise to long texts.
LEAST_TEXTS, DEVIATIONS = 4, 3.0
#: Pull of weights and factors towards zero at each step.
SHRINK = 0.01


def buckets_of(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of each text, text after text, and how many each text has."""
    codes = [np.fromiter(map(crc32, w), np.int64, len(w)) & (BUCKETS - 1) for w in (set(words_of(t)) for t in texts)]
    row = np.repeat(np.arange(len(texts)), [len(c) for c in codes])
    key = np.unique(row * BUCKETS + np.concatenate([*codes, np.zeros(0, np.int64)]))
    return key % BUCKETS, np.bincount(key // BUCKETS, minlength=len(texts))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of runs of rows; an empty run has sum 0."""
    total = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, 0, dtype=np.float64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


@dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, buckets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        factors = self.factors[buckets]
        sums = _sums(factors, sizes)
        pairs = ((sums**2).sum(1) - _sums((factors**2).sum(1), sizes)) / 2
        return self.bias + _sums(self.weights[buckets], sizes) + pairs, sums

    def score(self, texts: list[bytes | None]) -> np.ndarray:
        raw, _ = self.raw(*buckets_of(texts))
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def train(buckets: np.ndarray, sizes: np.ndarray, labels: np.ndarray, epochs: int = 30, batch: int = 256, seed: int = 3) -> Machine:
    """Adagrad on the logistic loss, with a little shrinkage."""
    rng = np.random.default_rng(seed)
    rate = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
    texts = np.bincount(buckets, minlength=BUCKETS)
    ones = np.bincount(buckets, np.repeat(labels, sizes), minlength=BUCKETS)
    known = (texts >= LEAST_TEXTS) & (np.abs(ones - texts * rate) > DEVIATIONS * np.sqrt(texts * rate * (1 - rate)))
    machine = Machine(
        float(np.log(rate / (1 - rate))),
        np.zeros(BUCKETS, np.float32),
        (rng.normal(0, 0.01, (BUCKETS, FACTORS)) * known[:, None]).astype(np.float32),
    )
    squares, factor_squares, bias_squares = np.ones(BUCKETS), np.ones((BUCKETS, FACTORS)), 1.0
    row = np.repeat(np.arange(len(sizes)), sizes)[known[buckets]]
    buckets, sizes = buckets[known[buckets]], np.bincount(row, minlength=len(sizes))
    ends = np.cumsum(sizes)
    for _ in range(epochs):
        order = rng.permutation(len(sizes))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            own = np.concatenate([buckets[ends[i] - sizes[i] : ends[i]] for i in chosen])
            n = sizes[chosen]
            raw, sums = machine.raw(own, n)
            slope = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen])
            each = np.repeat(slope, n)
            there, inverse = np.unique(own, return_inverse=True)
            w = np.bincount(inverse, each) + SHRINK * machine.weights[there]
            mixed = each[:, None] * (np.repeat(sums, n, axis=0) - machine.factors[own])
            v = np.stack([np.bincount(inverse, mixed[:, f]) for f in range(FACTORS)], 1) + SHRINK * machine.factors[there]
            squares[there] += w**2
            factor_squares[there] += v**2
            bias_squares += slope.sum() ** 2
            machine.weights[there] -= 0.2 * w / np.sqrt(squares[there])
            machine.factors[there] -= 0.02 * v / np.sqrt(factor_squares[there])
            machine.bias -= 0.05 * slope.sum() / np.sqrt(bias_squares)
    return machine


def learn(
    docs: DataFrame, labels: DataFrame, learnable: Column,
    id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic",
) -> Machine:
    """A machine from about ``TRAINING_ROWS`` rows of ``labels`` for which ``learnable`` (over its ``doc_id``) holds.

    Rows with a null id or label teach nothing; where an id has several labels, the
    highest counts. Without labelled rows every score is one half.
    """
    known = labels.select(labels[label_id_col].cast("long").alias("doc_id"), labels[label_col].cast("double").alias("label"))
    known = known.where(learnable & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    n, scale = known.count(), 1 << 30
    chosen = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(scale)) < int(scale * min(1, TRAINING_ROWS / max(n, 1)))
    sample = known.where(chosen).groupBy("doc_id").agg(F.max("label").alias("label"))

    def encode(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches):
            own, sizes = buckets_of(batch["text"])
            ends = np.cumsum(sizes)
            parts = [own[a:b].astype("<u4").tobytes() for a, b in zip(ends - sizes, ends)]
            yield {"doc_id": batch["doc_id"], "label": batch["label"], "buckets": parts}

    # The sample has about TRAINING_ROWS rows of two numbers.
    joined = texts_of(docs, id_col, text_col).join(F.broadcast(sample), "doc_id")
    rows = map_columns(joined, encode, "doc_id long, label double, buckets binary").orderBy("doc_id", "buckets").collect()
    if not rows:
        return Machine(0.0, np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32))
    buckets = np.frombuffer(b"".join(r["buckets"] for r in rows), "<u4").astype(np.int64)
    sizes = np.array([len(r["buckets"]) // 4 for r in rows])
    return train(buckets, sizes, np.array([r["label"] > 0 for r in rows], float))


def score_toxicity(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` of every row: how likely its label is 1.

    A null or empty text has no terms and gets the score of the bias. Null and
    repeated ids stay rows; an empty table gives none. Only the two named
    columns are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches):
            yield {"doc_id": batch["doc_id"], "score": shared.value.score(batch["text"])}

    return map_columns(texts_of(docs, id_col, text_col), run, "doc_id long, score double")
