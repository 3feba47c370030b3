"""Token ids through the public tokenizer libraries, with worker caches of pre-tokens.

Every id comes from the library's own model. What is added is the knowledge
where texts can be cut so that their parts are tokenized alike alone and
together, so that a part met before need not be tokenized again.
"""

from __future__ import annotations

import re
from array import array

#: Pre-tokens that a worker keeps; a full cache is emptied and starts anew.
WORDS_KEPT = 1_000_000

# The split patterns of the two vocabularies, for texts of the letters below only.
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ſ"
_SPLIT = {
    "byte_bpe_50k.json": re.compile(
        rf" ?[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+"
    ),
    "word_bpe_49k.json": re.compile(rf"[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\s{_LETTERS}0-9]+"),
}
_UNUSUAL = re.compile(rf"[^\t-\r\x20-\x7e{_LETTERS}]")


def _byte_letters() -> dict[int, str]:
    """Byte-level vocabularies write bytes as letters: printable ones as they are, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


class _Words(dict):
    """Pre-token to its ids as bytes."""

    def __init__(self, model):
        super().__init__()
        self.tokenize = model.tokenize

    def __missing__(self, word: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        letters = word.encode("utf-8").decode("latin-1").translate(_BYTE_LETTERS)
        self[word] = ids = array("H", [token.id for token in self.tokenize(letters)]).tobytes()
        return ids


def _ids(library, text: str) -> bytes:
    return array("H", library.encode(text, add_special_tokens=False).ids).tobytes()


class Encoder:
    """``encode(text as UTF-8) -> ids`` as little-endian unsigned 16-bit numbers.

    For the two named vocabularies a plain text (ASCII without control characters, and the
    letters of Latin-1 and Latin Extended-A, no ``<|``) is split here and its
    pre-tokens go to the library's model. ``word_bpe_49k.json`` drops white space,
    so other texts are cut at ASCII white space and only their unusual parts
    go to the library as they are; with ``byte_bpe_50k.json`` they go there whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.name = path.rsplit("/", 1)[-1]
        self.library = Tokenizer.from_file(path)
        if self.library.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids need more than 16 bits")
        self.split = _SPLIT.get(self.name)
        self.lower = self.name == "word_bpe_49k.json"
        self.words = _Words(self.library.model)

    def encode(self, data: bytes | None) -> bytes:
        if not data:
            return b""
        text = data.decode("utf-8", "replace")
        ids = self.plain(text)
        if ids is not None:
            return ids
        if not self.lower:
            return _ids(self.library, text)
        return b"".join([self.part(part.decode("utf-8", "replace")) for part in data.split()])

    def part(self, text: str) -> bytes:
        ids = self.plain(text)
        return _ids(self.library, text) if ids is None else ids

    def plain(self, text: str) -> bytes | None:
        """The ids of a plain text, None for any other."""
        if self.split is None or "<|" in text:
            return None
        if self.lower:
            text = text.lower()
        if _UNUSUAL.search(text):
            return None
        return b"".join(map(self.words.__getitem__, self.split.findall(text)))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file; its cache lives across tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
