"""BPE by a tokenization automaton.

A deterministic automaton over tokens reads exactly the sequences that the merges make of some
word. It starts as one state with a loop for every symbol. Each merge ``u v -> w``, in order, adds one gadget: the
state that ``u`` leads to is copied without its arc ``v``, ``u`` leads to the copy from now on, and beside every arc
``u`` there is now an arc ``w`` to where ``v`` leads. So each merge adds one state, and where a token leads depends
on the token alone.

Arcs taken away come in runs: whoever loses ``v`` also has no arc for the tokens made later with ``v`` on
their left. Labels are numbered along the tree of left parts, later children first, which makes such a run
an interval; a state's row in the table is its list of intervals.

A word is encoded by going along its letters. From each place, whose state is settled by then, a trie gives the tokens
that begin there; where such a token ends, it is the last one of that prefix if the state has an arc for it, and of all
tokens that end there only one has. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
import re
from array import array
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from xxhash import xxh64_hexdigest

from .common import map_columns, slices, texts_of
from .tokenizing import _BYTE_LETTERS, _SPLIT, _UNUSUAL

#: Words that a worker keeps and their longest letters: together they bound its cache. A full one starts anew.
WORDS_KEPT, LETTERS_KEPT = 1 << 19, 48
_PLAIN_ID = "word_bpe_49k.json"
_BLANK = re.compile("[\\x20\\x09-\\x0D]+")


class Automaton:
    """``encode(letters) -> ids`` of one word and ``labels`` of the ids, for merges and vocabulary of a BPE model.

    ``suffix`` marks the last letter of a word. Every token must be a letter or the product of one merge of earlier
    tokens; other vocabularies raise ``ValueError``.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.size = max(vocabulary.values()) + 1
        self.suffix = suffix
        parts = {a + b: (a, b) for a, b in merges}
        if len(parts) != len(merges):
            raise ValueError("two merges make the same token")
        letters = [t for t in vocabulary if t not in parts]
        if any(len(t.removesuffix(suffix) if suffix else t) != 1 for t in letters):
            raise ValueError("a token of several letters has no merge")
        made = set(letters)
        left, born = [-1] * self.size, [-1] * self.size
        for m, (a, b) in enumerate(merges):
            if a not in made or b not in made:
                raise ValueError("a merge comes before its parts")
            made.add(a + b)
            left[vocabulary[a + b]], born[vocabulary[a + b]] = vocabulary[a], m
        place, upto = _numbered(left, born)
        #: The row each token leads to, and of each row the edges of the intervals of labels it lacks.
        self.goes, self.rows, never = _compiled(
            [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges], self.size, place, upto
        )
        self.place = array("i", place)
        self.longest = max(map(len, vocabulary), default=0)
        self.vocabulary = {t: i for t, i in vocabulary.items() if i not in never}
        self.trie: dict = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"trie": {}}

    def _trie(self) -> dict:
        """Letters to nodes; a node has the token that ends there within a word at 0, at the end of one at 1."""
        trie: dict = {}
        for token, number in self.vocabulary.items():
            final = bool(self.suffix) and token.endswith(self.suffix)
            node = trie
            for letter in token.removesuffix(self.suffix) if final else token:
                node = node.setdefault(letter, {})
            node[1 if final else 0] = number
            if not self.suffix:
                node[1] = number
        return trie

    def leaves(self, before: int | None, token: int) -> bool:
        """Whether there is an arc for ``token`` after the token ``before`` (at the start: None)."""
        row = self.rows[0 if before is None else self.goes[before]]
        return bisect_right(row, self.place[token]) % 2 == 0

    def encode(self, word: str) -> list[int]:
        """The ids of one word, given in the letters of the vocabulary; ``ValueError`` at an unknown letter."""
        self.trie = trie = self.trie or self._trie()
        n, goes, rows, place = len(word), self.goes, self.rows, self.place
        last, begins = [-1] * (n + 1), [0] * (n + 1)
        row = rows[0]
        for start in range(n):
            node, end = trie, start
            for letter in word[start : start + self.longest]:
                if letter not in node:
                    break
                node = node[letter]
                end += 1
                if last[end] < 0 and (token := node.get(end == n)) is not None and not bisect_right(row, place[token]) & 1:
                    last[end], begins[end] = token, start
            if last[start + 1] < 0:
                raise ValueError(f"no token for the letter {word[start]!r}")
            row = rows[goes[last[start + 1]]]
        out, at = [], n
        while at:
            out.append(last[at])
            at = begins[at]
        return out[::-1]


def _numbered(left: list[int], born: list[int]) -> tuple[list[int], list[list[tuple[int, int]]]]:
    """Each token's number along the tree of left parts, and for each token ``(born, end)`` of its children, later ones first."""
    children: list[list[int]] = [[] for _ in left]
    for token in sorted((t for t, p in enumerate(left) if p >= 0), key=born.__getitem__, reverse=True):
        children[left[token]].append(token)
    place, ends, at = [0] * len(left), [0] * len(left), 0
    for root in (t for t, p in enumerate(left) if p < 0):
        stack = [(root, False)]
        while stack:
            token, done = stack.pop()
            if done:
                ends[token] = at
                continue
            place[token], at = at, at + 1
            stack.append((token, True))
            stack.extend((c, False) for c in reversed(children[token]))
    return place, [[(born[c], ends[c]) for c in kids] for kids in children]


def _compiled(
    merges: list[tuple[int, int, int]], size: int, place: list[int], children: list[list[tuple[int, int]]]
) -> tuple[array, list[array], set[int]]:
    """The row each token leads to (the start is row 0), of each row the edges of the intervals of missing arcs, and tokens without arcs."""
    goes = [0] * size
    origin, lost = [0], [(0, 0)]  # of each state: the one it copies, and the interval of arcs it lacks besides
    never: set[int] = set()
    for m, (u, v, w) in enumerate(merges):
        at = goes[u]
        while at and not lost[at][0] <= place[v] < lost[at][1]:
            at = origin[at]
        if at or u in never or v in never:  # v never follows u: nothing to merge
            never.add(w)
            continue
        end = place[v] + 1
        for birth, upto in children[v]:
            if birth < m:
                break
            end = upto
        goes[w] = goes[v]
        origin.append(goes[u])
        lost.append((place[v], end))
        goes[u] = len(origin) - 1
    numbers = {0: 0}
    rows = [array("i")]
    for state in goes:
        if state in numbers:
            continue
        numbers[state] = len(rows)
        spans, at = [], state
        while at:
            spans.append(lost[at])
            at = origin[at]
        row = array("i")
        for a, b in sorted(spans):
            if not row or a > row[-1]:
                row.extend((a, b))
            elif b > row[-1]:
                row[-1] = b
        rows.append(row)
    return array("i", [numbers[s] for s in goes]), rows, never


class _Words(dict):
    """Words to their ids, little-endian unsigned 32-bit; long words are not kept."""

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.encode(word)).tobytes()
        if len(word) <= LETTERS_KEPT:
            if len(self) >= WORDS_KEPT:
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Texts to ids and back, as the library of the tokenizer file ``source`` (its JSON text) does it.

    The library normalizes unusual texts and cuts them into words; plain ones are cut here. All words are encoded by the automaton.
    """

    def __init__(self, source: str, automaton: Automaton, name: str = ""):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(source)
        described = json.loads(source)
        self.automaton = automaton
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.labels = {i: t for t, i in described["model"]["vocab"].items()} | {i: t for t, i in self.special.items()}
        self.bytes_of = {letter: byte for byte, letter in _BYTE_LETTERS.items()}
        self.by_bytes = (described["decoder"] or {}).get("type") == "ByteLevel"
        if described["decoder"] and not self.by_bytes:
            raise ValueError("only byte-level decoders, or none, are known")
        self.split = _SPLIT[_PLAIN_ID] if name == _PLAIN_ID else None
        self.kept = _Words(automaton.encode)
        self.plain = _Words(lambda word: automaton.encode(word.encode("utf-8").decode("latin-1").translate(_BYTE_LETTERS)))

    def _plain(self, text: str) -> bytes | None:
        """The ids of a plain text; None for any other."""
        text = text.lower()
        if _UNUSUAL.search(text):
            return None
        return b"".join(map(self.plain.__getitem__, self.split.findall(text)))

    def _any(self, text: str) -> bytes:
        normalizer = self.library.normalizer
        words = self.library.pre_tokenizer.pre_tokenize_str(normalizer.normalize_str(text) if normalizer else text)
        return b"".join([self.kept[word] for word, _ in words])

    def _part(self, text: str) -> bytes:
        if self.split is None:
            return self._any(text)
        ids = self._plain(text)
        if ids is not None:
            return ids
        # This vocabulary drops white space, across which nothing is normalized: only unusual pieces go to the library.
        pieces = [(self._plain(p), p) for p in _BLANK.split(text) if p]
        return b"".join([self._any(p) if ids is None else ids for ids, p in pieces])

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if self.cut is None:
            return self._part(text)
        parts = self.cut.split(text)
        return b"".join(
            np.array([self.special[p]], "<u4").tobytes() if i % 2 else self._part(p) for i, p in enumerate(parts) if p
        )

    def decode(self, ids: bytes) -> str:
        """The labels of the ids: as bytes where the file has a byte-level decoder, else with blanks between them."""
        labels = list(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        if not self.by_bytes:
            return " ".join(labels)
        out = bytearray()
        for label in labels:
            known = [self.bytes_of.get(c) for c in label]
            out += label.encode("utf-8") if label in self.special or None in known else bytes(known)
        return out.decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> tuple[str, Automaton, str]:
    """What a worker needs for a :class:`Codec`: made once on the driver, as large as the tokenizer file."""
    with open(path, encoding="utf-8") as file:
        source = file.read()
    model = json.loads(source)["model"]
    unknown = [n for n in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(n)]
    if model["type"] != "BPE" or unknown:
        raise ValueError(f"not a plain BPE model: {model['type']} {unknown}")
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return source, Automaton(model["vocab"], pairs, model.get("end_of_word_suffix") or ""), path.rsplit("/", 1)[-1]


def _of_worker(parts: tuple[str, Automaton, str]) -> Codec:
    key = xxh64_hexdigest(parts[0]) + parts[2]
    if key not in _CODECS:
        _CODECS[key] = Codec(*parts)
    return _CODECS[key]


def encode_texts(docs: DataFrame, path: str, decode: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids`` (little-endian unsigned 32-bit) of every row, with ``decoded`` if asked.

    The ids are those of the tokenizers library without special tokens added; strings of special tokens in a
    text become those tokens, as its default is. A null or empty text has no ids and decodes to the empty
    text. Repeated rows and null ids stay rows; an empty table gives no rows. Other columns are not read.
    """
    parts = docs.sparkSession.sparkContext.broadcast(codec(path))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        own = _of_worker(parts.value)
        for batch in slices(batches):
            ids = [own.encode(t.decode("utf-8", "replace")) if t else b"" for t in batch["text"]]
            texts = [own.decode(i) if decode else None for i in ids]
            yield {"doc_id": batch["doc_id"], "n_tokens": [len(i) // 4 for i in ids], "ids": ids, "decoded": texts}

    found = map_columns(texts_of(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids binary, decoded string")
    return found if decode else found.drop("decoded")


def decode_ids(rows: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, decoded`` of every row's ids, special tokens included; null ids decode to the empty text."""
    parts = rows.sparkSession.sparkContext.broadcast(codec(path))
    given = rows.select(rows[id_col].cast("long").alias("doc_id"), rows[ids_col].alias("ids"))

    def run(batches: Iterator[dict]) -> Iterator[dict]:
        own = _of_worker(parts.value)
        for batch in slices(batches, "ids"):
            yield {"doc_id": batch["doc_id"], "decoded": [own.decode(i or b"") for i in batch["ids"]]}

    return map_columns(given, run, "doc_id long, decoded string")
