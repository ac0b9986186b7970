"""Token ids of whole texts, with a memory of the words a Python worker has met.

Words follow a steep law, so most of a corpus is looked up and only new words reach the tokenizer's merges. Both
kinds of tokenizer file split a text before they merge, and nothing crosses these pieces, so ids of a text are
the ids of its pieces in order. Results equal ``Tokenizer.encode(text, add_special_tokens=False).ids``.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from tokenizers import Tokenizer

# White space as the tokenizers' patterns know it.
SPACE = r"\t-\r \x85\xa0" + "".join(f"\\u{c:04x}" for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
# Byte-level: other characters with at most one space before them, or white space up to the character that
# belongs to what follows.
SPACED = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# Word-level, where white space is dropped: what stands between the plain ones.
PLAIN = re.compile(r"[^ \n\r\t]+")
# The same patterns with Latin-1's own letters, numbers and white space, for texts of nothing else: such texts
# have no combining marks and lower-case character by character.
LETTER, NUMBER, BLANK = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\t-\r \x85\xa0"
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
SPACED_LATIN = re.compile(
    f"{ENDINGS}| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{BLANK}{LETTER}{NUMBER}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+"
)
PLAIN_LATIN = re.compile(f"{ENDINGS}|[{LETTER}]+|[{NUMBER}]|[^{BLANK}{LETTER}{NUMBER}]+")


def byte_letters() -> list[str]:
    """The visible character that stands for each byte in a byte-level vocabulary: Latin-1's own where it is
    visible, else the next one from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


def packed(ids: list[int]) -> bytes:
    return b"".join(i.to_bytes(2, "little") for i in ids)


class _Memory(dict):
    """Ids of pieces met before. It starts anew at ``limit`` entries, which costs time and changes no result."""

    def __init__(self, find: Callable[[str], bytes], limit: int):
        super().__init__()
        self.find, self.limit = find, limit

    def __missing__(self, piece: str) -> bytes:
        ids = self.find(piece)
        if len(piece) <= 64:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = ids
        return ids


class IdEncoder:
    """Calls give a text's ids as little-endian 16-bit numbers. ``pieces_kept`` bounds the memory's entries."""

    def __init__(self, path: str, pieces_kept: int = 1_000_000):
        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size(with_added_tokens=True) > 65536:
            raise ValueError("ids must fit in 16 bits")
        specials = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, specials)) or r"(?!)", re.IGNORECASE)
        self.lowers = self.tokenizer.normalizer is not None
        self.pieces, self.latin = (PLAIN, PLAIN_LATIN) if self.lowers else (SPACED, SPACED_LATIN)
        self.model, self.letters = self.tokenizer.model, dict(enumerate(byte_letters()))
        self.words = _Memory(self._word, pieces_kept)
        self.others = _Memory(self._whole, pieces_kept // 8)

    def _whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        """``word`` is what the splitting pattern gives; each byte is written as its visible character."""
        shown = word.encode().decode("latin-1").translate(self.letters)
        return packed([token.id for token in self.model.tokenize(shown)])

    def __call__(self, text: str) -> bytes:
        if "<|" in text and self.special.search(text):
            return self._whole(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return b"".join(map(self.others.__getitem__, self.pieces.findall(text)))
        words = self.latin.findall(text.lower() if self.lowers else text)
        return b"".join(map(self.words.__getitem__, words))


_open: dict[str, IdEncoder] = {}


def id_encoder(path: str) -> IdEncoder:
    """One encoder for each Python worker and file."""
    if path not in _open:
        _open[path] = IdEncoder(path)
    return _open[path]
