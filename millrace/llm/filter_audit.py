"""How filters on documents interact: what each of them removes in every order of application.

Texts are read once by a table-driven transducer over their bytes. A class table sends each byte to blank, capital,
symbol, continuation byte or other; the two states, between words and within one, and the class of the next byte
give the output: a code point, a capital, a symbol, the begin or the end of a word. Begins and ends are word spans, which are
inserted into an open-addressed hash table: a slot is taken by one span, a later span of the same document that meets
an equal one, compared byte by byte, is no new word, any other goes on to the next slot.

Everything after that is counting: documents by part and by the set of filters they fail, then the orders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_columns, slices, stored

# What the classes of bytes are.
BLANK, CAPITAL, SYMBOL, CONTINUATION = 1, 2, 4, 8
_CLASSES = np.zeros(256, np.uint8)
_CLASSES[[0x20, *range(0x09, 0x0E)]] = BLANK
_CLASSES[ord("A") : ord("Z") + 1] = CAPITAL
_CLASSES[list(b"#$%&*|")] = SYMBOL
_CLASSES[0x80:0xC0] = CONTINUATION
#: What a byte of each class makes in each state (between words, within one): 1 begins a word, 2 ends one.
_MOVES = np.array([[0 if c & BLANK else 1 for c in range(16)], [2 if c & BLANK else 0 for c in range(16)]], np.uint8)

#: Factor of the polynomial hashes of spans, and bytes of two words compared at a time.
_FACTOR, _WIDTH = np.uint64(0x9E3779B97F4A7C15), 8
#: Bytes whose hashes and classes are held at a time, as far as words end there.
_HELD = 1 << 20

FACTS = "doc_id long, n_words long, n_distinct long, n_capitals long, n_points long, n_symbols long, digest binary, part string"


def _inverse(factor: np.uint64) -> np.uint64:
    """Of an odd number modulo 2^64."""
    return np.uint64(pow(int(factor), -1, 1 << 64))


def _powers(factor: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, factor, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class WordTable:
    """A hash table of the words of one document after another, each held once.

    ``insert`` takes spans of ``data`` and the number of the document each lies in, and returns which of them are
    new. Equal hashes decide nothing: the bytes do.
    """

    def __init__(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray, docs: np.ndarray):
        self.data, self.begins, self.sizes, self.docs = data, begins, ends - begins, docs
        padded = np.concatenate([data, np.zeros(_WIDTH, np.uint8)])
        self.words = np.lib.stride_tricks.sliding_window_view(padded, _WIDTH)

    def hashes(self) -> np.ndarray:
        """Of span and document: a polynomial of the bytes, from prefix sums, mixed."""
        with np.errstate(over="ignore"):
            n = len(self.data)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * _powers(_FACTOR, n), out=sums[1:])
            value = (sums[self.begins + self.sizes] - sums[self.begins]) * _powers(_inverse(_FACTOR), n + 1)[self.begins]
            value ^= self.docs.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
            value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            return value ^ (value >> np.uint64(32))

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether spans ``a`` and ``b`` are of one document and have the same bytes."""
        same = (self.docs[a] == self.docs[b]) & (self.sizes[a] == self.sizes[b])
        at, open_ = 0, np.flatnonzero(same)
        while len(open_):
            left = self.sizes[a[open_]] - at
            long_ = left >= _WIDTH
            x, y = self.begins[a[open_]] + at, self.begins[b[open_]] + at
            differ = self.words[x] != self.words[y]
            differ &= long_[:, None] | (np.arange(_WIDTH) < left[:, None])
            wrong = differ.any(1)
            same[open_[wrong]] = False
            open_ = open_[~wrong & (left > _WIDTH)]
            at += _WIDTH
            if at >= 64:  # the few long words are compared whole
                for k in open_.tolist():
                    i, j, n = self.begins[a[k]], self.begins[b[k]], self.sizes[a[k]]
                    same[k] = np.array_equal(self.data[i : i + n], self.data[j : j + n])
                break
        return same

    def new(self) -> np.ndarray:
        """Which spans are the first found of their word and document."""
        n = len(self.begins)
        mask = (1 << max(4, int(2 * n).bit_length())) - 1
        owner = np.full(mask + 1, -1, np.int64)
        fresh = np.zeros(n, bool)
        slot = (self.hashes() & np.uint64(mask)).astype(np.int64)
        open_ = np.arange(n)
        while len(open_):
            at = slot[open_]
            free = owner[at] < 0
            owner[at[free]] = open_[free]  # of several that want a slot one gets it
            held = owner[at]
            mine = held == open_
            fresh[open_[mine]] = True
            rest = np.flatnonzero(~mine)
            other = rest[~self.equal(open_[rest], held[rest])]
            open_ = open_[other]
            slot[open_] = (slot[open_] + 1) & mask
        return fresh


def _facts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Counts of each text: one pass of the transducer over all of them, a blank after each."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    ends_at = np.cumsum(sizes)
    starts_at = ends_at - sizes
    kind = _CLASSES[data]
    state = np.zeros(len(data), np.uint8)  # the state before a byte: within a word unless the byte before was blank
    state[1:] = kind[:-1] & BLANK == 0
    out = _MOVES[state, kind]
    begins, ends = np.flatnonzero(out == 1), np.flatnonzero(out == 2)
    docs = np.searchsorted(ends_at, begins, "right")

    def count(flags: np.ndarray) -> np.ndarray:
        return np.add.reduceat(flags, starts_at, dtype=np.int64)

    fresh = WordTable(data, begins, ends, docs).new() if len(begins) else np.zeros(0, bool)
    return {
        "n_words": np.bincount(docs, minlength=len(texts)),
        "n_distinct": np.bincount(docs[fresh], minlength=len(texts)),
        "n_capitals": count(kind == CAPITAL),
        "n_points": count(kind & CONTINUATION == 0) - 1,  # but for the blank put after it
        "n_symbols": count(kind == SYMBOL),
    }


def text_facts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str | None = None) -> DataFrame:
    """``doc_id, n_words, n_distinct, n_capitals, n_points, n_symbols, digest, part`` of every row.

    Words are maximal runs without ASCII blanks, case counts; ``digest`` is the SHA-256 of the text's UTF-8. A null text is
    empty, ``part`` the empty string for a null. Repeated rows and null ids stay rows; an empty table gives none. Other
    columns are not read.
    """
    part = docs[part_col].cast("string") if part_col else F.lit("")
    given = docs.select(
        docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("text"),
        F.coalesce(part, F.lit("")).alias("part"),
    )

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in slices(batches, limit=_HELD):
            texts = [t or b"" for t in batch.pop("text")]
            yield batch | _facts(texts) | {"digest": [hashlib.sha256(t).digest() for t in texts]}

    return map_columns(given, run, FACTS)


#: The filters by letter: what makes a document fail, over the facts and ``repeated``.
FILTERS: dict[str, str] = {
    "A": "n_words < 200",
    "B": "100 * n_distinct < 50 * n_words",
    "C": "100 * n_capitals > 3 * n_points",
    "D": "n_symbols > 0",
    "E": "repeated",
}


def failed_filters(
    docs: DataFrame, filters: dict[str, str] | None = None, id_col: str = "doc_id", part_col: str = "lang", text_col: str = "text"
) -> DataFrame:
    """``doc_id, part, fails`` of every row: the filters a document fails, as bits in the order of ``filters``.

    ``repeated`` is true if a row of a smaller id has the same text; an id that is null is neither smaller nor larger
    than any. ``part`` is the empty string for a null.
    """
    filters = filters or FILTERS
    facts = stored(text_facts(docs, id_col, text_col, part_col), "filter-facts")
    # Most texts occur once: only those of several ids are joined. One text's copies meet in partial sums first, and
    # the stored table lets the join broadcast it if small, and split the rows of a hot text if not.
    repeats = facts.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most")
    joined = facts.join(stored(repeats.select("digest", "least"), "repeated-texts"), "digest", "left")
    joined = joined.withColumn("repeated", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)))
    bits = [F.when(F.expr(f), F.lit(1 << i)).otherwise(0) for i, f in enumerate(filters.values())]
    return joined.select("doc_id", "part", sum(bits[1:], bits[0]).alias("fails"))


def orders(letters: Sequence[str]) -> list[tuple[str, int, str, int, int]]:
    """``(order, step, letter, bit, bits before)`` of every step of every order."""
    bit = {letter: 1 << i for i, letter in enumerate(letters)}
    return [
        ("".join(order), k + 1, letter, bit[letter], sum(bit[x] for x in order[:k]))
        for order in permutations(letters) for k, letter in enumerate(order)
    ]


def audit_filters(
    docs: DataFrame, labels: DataFrame, filters: dict[str, str] | None = None,
    id_col: str = "doc_id", part_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """One row for each part, order of the filters and step of it.

    ``kept`` after the step, ``removed`` at it, ``redundant`` (fails the step's filter, removed before), ``unique_fails``
    (fails this filter alone), ``good_lost`` and ``toxic_lost`` (removed here with label ``quality`` or ``toxic`` 1),
    ``shapley`` (what the filter removes, summed over all orders). Of several label rows of a document any 1 counts; rows of
    labels without id say nothing. Repeated documents count each. An empty table gives no rows.
    """
    filters = filters or FILTERS
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"),
    )
    marked = failed_filters(docs, filters, id_col, part_col, text_col).join(marks, "doc_id", "left")
    classes = marked.groupBy("part", "fails").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")
    )
    # At most 2^filters classes of a part from here on.
    names = ("filter_order", "step", "letter", "bit", "before")
    rows = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in orders(list(filters))]
    steps = classes.withColumn("at", F.explode(F.array(*rows))).select("part", "fails", "n", "good", "toxic", "at.*")
    failing = F.col("fails").bitwiseAND(F.col("bit")) != 0
    gone = F.col("fails").bitwiseAND(F.col("before")) != 0

    def total(condition: Column, value: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(value)).otherwise(F.lit(0).cast("long")))

    counted = steps.groupBy("part", "filter_order", "step", "letter").agg(
        total(~gone & ~failing).alias("kept"), total(~gone & failing).alias("removed"), total(gone & failing).alias("redundant"),
        total(F.col("fails") == F.col("bit")).alias("unique_fails"),
        total(~gone & failing, "good").alias("good_lost"), total(~gone & failing, "toxic").alias("toxic_lost"),
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))
    return counted.withColumn("shapley", shapley).drop("letter")
