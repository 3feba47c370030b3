"""Language identification by error-correcting output codes.

Every language gets a codeword of bits. One binary classifier for each bit is
learned over hashed byte trigrams (logistic loss). A text's bits are
predicted, and the language whose codeword has the least loss, each bit weighted by
how well its classifier does on the rows it was learned from, is chosen. The gap to
the next codeword tells how sure that is.

The classifiers are learned from a sample of at most ``TRAINING_ROWS`` labelled
texts, the least by a hash of id, text and language; equal rows count once. That is
what the driver holds. Everything else is one pass over all texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep_rows, map_columns, slices, texts_of

#: Labelled rows that the classifiers are learned from, at most.
TRAINING_ROWS = 4_000
#: Buckets of the hashed trigrams.
BUCKETS = 1 << 15
#: Below this probability of the chosen codeword a prediction counts as ambiguous.
SURE = 0.5

_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def codewords(k: int, seed: int = 7) -> np.ndarray:
    """``k`` codewords of +1 and -1: all ways to part the languages if they are few, else random ones that lie far apart."""
    if k <= 5:
        columns = [[1 if i == 0 or bits >> (i - 1) & 1 else -1 for i in range(k)] for bits in range((1 << max(0, k - 1)) - 1)]
        return np.array(columns or [[1] * k], np.float32).T
    rng = np.random.default_rng(seed)
    best, width = None, max(15, int(np.ceil(10 * np.log2(k))))
    for _ in range(50):
        code = rng.choice(np.array([-1, 1], np.float32), (k, width))
        apart = (width - code @ code.T) / 2 + np.eye(k) * width
        mixed = (np.abs(code.sum(0)) < k).all()
        if mixed and (best is None or apart.min() > best[0]):
            best = (apart.min(), code)
    return best[1]


def trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every trigram of the texts one after another, and each text's end; a blank stands before and after a text."""
    data = np.frombuffer(b"".join(b" " + t.lower() + b"  " for t in texts), np.uint8).astype(np.uint32)
    ends = np.cumsum([len(t) + 3 for t in texts])
    code = (data[:-2] | data[1:-1] << 8 | data[2:] << 16) * np.uint32(0x9E3779B1)
    return np.concatenate([code >> np.uint32(32 - BUCKETS.bit_length() + 1), [0, 0]]), ends


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray  # buckets x bits
    bias: np.ndarray
    trust: np.ndarray  # of each bit

    def margins(self, texts: list[bytes]) -> np.ndarray:
        buckets, ends = trigrams(texts)
        starts = np.concatenate([[0], ends[:-1]])
        n = ends - 2 - starts  # without the two that reach into the next text
        out = np.empty((len(texts), len(self.bias)))
        for bit in range(len(self.bias)):
            sums = np.concatenate([[0.0], np.cumsum(self.weights[:, bit][buckets], dtype=np.float64)])
            out[:, bit] = (sums[ends - 2] - sums[starts]) / n + self.bias[bit]
        return out

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the chosen language and its probability, from the losses of all codewords."""
        losses = np.logaddexp(0, -margins[:, None, :] * self.code[None]) @ self.trust
        chance = np.exp(losses.min(1, keepdims=True) - losses)
        return losses.argmin(1), 1 / chance.sum(1)


def train(texts: list[bytes], labels: list[str], rounds: int = 60) -> Model:
    """Logistic regression for all bits together, by Adagrad steps over the whole sample."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    number = {v: i for i, v in enumerate(languages)}
    target = code[[number[v] for v in labels]]
    rows, columns, values = [], [], []
    for at in range(0, len(texts), 256):
        part = texts[at : at + 256]
        buckets, ends = trigrams(part)
        sizes = np.diff(ends, prepend=0)
        row = np.repeat(np.arange(len(part)), sizes)
        inside = np.arange(len(row)) < np.repeat(ends - 2, sizes)
        key, count = np.unique(row[inside] * BUCKETS + buckets[inside], return_counts=True)
        rows.append(key // BUCKETS + at)
        columns.append(key % BUCKETS)
        values.append(count / (sizes[key // BUCKETS] - 2))
    row, column, value = np.concatenate(rows), np.concatenate(columns), np.concatenate(values).astype(np.float32)
    edges = np.searchsorted(row, np.arange(len(texts)))
    by_column = np.argsort(column, kind="stable")
    used, column_edges = np.unique(column[by_column], return_index=True)
    weights = np.zeros((BUCKETS, code.shape[1]), np.float32)
    bias = np.zeros(code.shape[1], np.float32)
    squares, bias_squares = np.full_like(weights, 1e-8), np.full_like(bias, 1e-8)
    for step in range(rounds + 1):
        margins = np.add.reduceat(weights[column] * value[:, None], edges) + bias
        if step == rounds:
            break
        slope = -target / (1 + np.exp(np.clip(target * margins, -30, 30))) / len(texts)
        gradient = np.zeros_like(weights)
        gradient[used] = np.add.reduceat((slope[row] * value[:, None])[by_column], column_edges)
        squares += gradient**2
        bias_squares += (slope.sum(0)) ** 2
        weights -= 8.0 * gradient / np.sqrt(squares)
        bias -= 0.1 * slope.sum(0) / np.sqrt(bias_squares)
    right = ((margins > 0) == (target > 0)).mean(0)
    return Model(languages, code, weights, bias, np.clip(2 * right - 1, 0.01, 1).astype(np.float32))


def learn(docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """A model from at most ``TRAINING_ROWS`` of the distinct rows with a language for which ``learnable`` holds; None if there are none."""
    labelled = docs.where(learnable & docs[lang_col].isNotNull() & docs[text_col].isNotNull()).select(
        docs[id_col].cast("string").alias("id"), docs[text_col].cast("string").alias("text"), docs[lang_col].cast("string").alias("lang")
    )
    labelled = labelled.withColumn("hash", F.xxhash64("id", "text", "lang"))
    n = labelled.agg(F.approx_count_distinct("hash", 0.02)).first()[0]
    scale = 1 << 30
    chosen = F.pmod("hash", F.lit(scale)) < int(scale * min(1, 1.25 * TRAINING_ROWS / max(n, 1)))
    sample = labelled.where(chosen).groupBy("hash").agg(F.min(F.struct("lang", "text")).alias("row"))
    order = F.pmod("hash", F.lit(scale))
    found = sorted((r["row"] for r in sample.orderBy(order, "hash").limit(TRAINING_ROWS).collect()), key=lambda r: (r["lang"], r["text"]))
    if not found:
        return None
    return train([r["text"].encode("utf-8", "replace") for r in found], [r["lang"] for r in found])


def has_letter(text: bytes | None) -> bool:
    return bool(text) and (bool(_ASCII_LETTER.search(text)) or any(c.isalpha() for c in text.decode("utf-8", "replace")))


def predict(model: Model | None, texts: list[bytes | None]) -> tuple[list[str], list[float], list[bool]]:
    """Language, score and ambiguity of each text."""
    lang, score = ["und"] * len(texts), [0.0] * len(texts)
    lettered = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
    if lettered:
        which, chance = model.decode(model.margins([texts[i] for i in lettered]))
        for i, w, c in zip(lettered, which.tolist(), chance.tolist()):
            lang[i], score[i] = model.languages[w], c
    return lang, score, [v != "und" and s < SURE for v, s in zip(lang, score)]


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` of every row.

    A text that is null or has no letter is ``und``, with score 0 and not ambiguous; so is
    every text without a model. ``score`` is the probability of the chosen codeword, and a
    prediction of less than ``SURE`` is ambiguous. Null and repeated ids stay
    rows; an empty table gives none. Only the two named columns are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches):
            lang, score, ambiguous = predict(shared.value, batch["text"])
            yield {"doc_id": batch["doc_id"], "lang_pred": lang, "score": score, "ambiguous": ambiguous}

    return map_columns(texts_of(docs, id_col, text_col), run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def with_language(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows whose language is told for sure: neither ``und`` nor ambiguous. Without a model, all rows with a letter."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def decide(texts: list[bytes | None]) -> list[bool]:
        if shared.value is None:
            return [has_letter(t) for t in texts]
        lang, _, ambiguous = predict(shared.value, texts)
        return [v != "und" and not a for v, a in zip(lang, ambiguous)]

    return keep_rows(docs, decide, text_col)
