"""Token counts: a two-tier lookup on the map side.

A SentencePiece model of the BPE kind turns blanks into ``▁``; where no piece
has a ``▁`` after another character, no merge crosses from a non-blank to a
blank, so a text is the concatenation of its pre-tokens (blanks, then
non-blanks) and its token count is the sum of theirs. That property is checked
when the model is loaded; a model without it gets whole texts.

First tier: a compact hash table of the lengths of frequent pre-tokens,
broadcast. Second tier: what is not in it is encoded by the library, once for
each worker that meets it, and kept in a bounded cache. No pre-token is
shuffled: the table is made from one bounded summary of each task.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_columns, slices, texts_of

#: Entries of the broadcast table, each of at most 48 bytes: under 4 MB.
TABLE_ENTRIES, ENTRY_BYTES = 65_536, 48
#: Entries of a task's summary, and of a worker's cache.
SUMMARY_ENTRIES, CACHE_ENTRIES = 131_072, 1_000_000
#: Pre-tokens that a task reports.
REPORTED = 4_096

_PRETOKEN = re.compile("[ ▁]*[^ ▁]+|[ ▁]+")


class Lengths(dict):
    """Pre-token to token count; misses are encoded and kept, up to a bound."""

    def __init__(self, path: str, frequent: dict[str, int]):
        from sentencepiece import SentencePieceProcessor

        super().__init__(frequent)
        self.frequent = frequent
        self.model = SentencePieceProcessor(model_file=path)
        pieces = map(self.model.id_to_piece, range(self.model.vocab_size()))
        self.separable = not any("▁" in piece.lstrip("▁") for piece in pieces) and self._plain_spaces()

    def _plain_spaces(self) -> bool:
        """Whether the model keeps runs of blanks and puts one blank in front of a text."""
        encode = self.model.encode
        return (
            encode("a  b") == encode("a") + encode(" b") and encode(" b") != encode("b") and encode("\n\tb ") != encode("b")
        )

    def __missing__(self, pretoken: str) -> int:
        if len(self) >= CACHE_ENTRIES + len(self.frequent):
            self.clear()
            self.update(self.frequent)
        self[pretoken] = n = self._count(pretoken)
        return n

    def _count(self, pretoken: str) -> int:
        encode = self.model.encode
        if pretoken[0] not in " ▁":  # the start of a text, which the model gives a blank
            return len(encode(pretoken))
        if pretoken.strip(" ▁"):  # a blank in front takes the place of the one the model adds
            return len(encode(pretoken[1:]))
        return len(encode("a" + pretoken)) - len(encode("a"))

    def count(self, data: bytes | None) -> int:
        if not data:
            return 0
        text = data.decode("utf-8", "replace")
        if not self.separable:
            return len(self.model.encode(text))
        parts, total = _PRETOKEN.findall(text), 0
        if parts[0][0] in " ▁":  # the model's blank joins those that are there
            total = len(self.model.encode(parts.pop(0)))
        return total + sum(map(self.__getitem__, parts))


def frequent_pretokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The most frequent pre-tokens of all texts: ``pretoken, n``, at most ``TABLE_ENTRIES`` rows.

    Each task counts its pre-tokens in a table of bounded size (the rarer half
    goes when it is full) and reports ``REPORTED`` of them. The counts only choose what
    is broadcast; token counts don't depend on them.
    """

    def summarise(batches: Iterator[dict]) -> Iterator[dict]:
        seen: Counter = Counter()
        for batch in slices(batches):
            for text in batch["text"]:
                seen.update(_PRETOKEN.findall((text or b"").decode("utf-8", "replace")))
            if len(seen) > SUMMARY_ENTRIES:
                seen = Counter(dict(seen.most_common(SUMMARY_ENTRIES // 2)))
        top = [(p, n) for p, n in seen.most_common(REPORTED) if n > 1 and len(p.encode()) <= ENTRY_BYTES]
        yield {"pretoken": [p for p, _ in top], "n": [n for _, n in top]}

    found = map_columns(texts_of(docs, text_col, text_col).select("text"), summarise, "pretoken string, n long")
    return found.groupBy("pretoken").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "pretoken").limit(TABLE_ENTRIES)


def pack_table(path: str, pretokens: list[str]) -> tuple[bytes, bytes]:
    """The table as broadcast: pre-tokens one after another, NUL-separated, and their token counts as 16-bit numbers."""
    lengths = Lengths(path, {})
    kept = [p for p in pretokens if "\0" not in p]
    return "\0".join(kept).encode(), np.array([min(lengths[p], 65_535) for p in kept], "<u2").tobytes()


_WORKER: dict[tuple, Lengths] = {}


def _lengths(path: str, packed: tuple[bytes, bytes]) -> Lengths:
    key = (path, hash(packed))
    if key not in _WORKER:
        _WORKER.clear()
        names = packed[0].decode().split("\0") if packed[1] else []
        _WORKER[key] = Lengths(path, dict(zip(names, np.frombuffer(packed[1], "<u2").tolist())))
    return _WORKER[key]


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` for every row of ``docs``.

    A null or empty text has no bytes and no tokens. Null and repeated ids are
    kept, one row for each. An empty table gives no rows. Columns other than
    the two named are not read.
    """
    texts = texts_of(docs, id_col, text_col)
    found = [r[0] for r in frequent_pretokens(docs, text_col).select("pretoken").collect()]
    table = docs.sparkSession.sparkContext.broadcast(pack_table(path, found))

    def count(batches: Iterator[dict]) -> Iterator[dict]:
        lengths = _lengths(path, table.value)
        for batch in batches:
            yield {
                "doc_id": batch["doc_id"],
                "n_bytes": [len(t or b"") for t in batch["text"]],
                "n_tokens": [lengths.count(t) for t in batch["text"]],
            }

    return map_columns(texts, count, "doc_id long, n_bytes long, n_tokens long")
