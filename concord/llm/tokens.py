"""Encoding of texts with a given tokenizer, with encoded pieces kept for reuse.

Both supported kinds of tokenizer split a text at white space before any merge, so the ids of
a text are the ids of its blank-separated pieces, one after the other. Natural text repeats
few pieces very often: a piece is encoded once per worker and then looked up. Plain words go
straight to the tokenizer's merge model, anything else through the whole tokenizer.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

#: Plain words, and other pieces, remembered per worker (some 200 bytes each); further ones are
#: encoded each time. This bounds memory and changes speed only, never results.
WORDS = 900_000
OTHERS = 150_000

#: White space other than blank and line feed: such texts are encoded whole.
_OTHER_SPACE = re.compile(
    "[\\t\\r\\x0b\\x0c\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
)
#: A word of Latin letters, the line feed before it and the punctuation behind it (without the
#: apostrophe, which may start a token together with letters).
_PLAIN = re.compile("(\\n?)([A-Za-z\\u00c0-\\u00d6\\u00d8-\\u00f6\\u00f8-\\u012f]+)([!-&(-/:-@\\[-`{-~]*)")


def _byte_letters() -> dict[int, int]:
    """The byte-level alphabet: printable bytes stand for themselves, others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: b for b in shown} | {b: 0x100 + i for i, b in enumerate(hidden)}


class Pieces(dict):
    """Ids of pieces, as bytes; a piece not seen before is encoded on the way."""

    def __init__(self, encode, most: int) -> None:
        super().__init__()
        self.encode = encode
        self.most = most

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece)
        if self.most:
            self.most -= 1
            self[piece] = ids
        return ids


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    ``keeps_space`` says whether a blank belongs to the piece after it (byte-level vocabularies)
    or white space is dropped and letters are lowered (vocabularies with word ends).
    """

    def __init__(self, path: str, keeps_space: bool) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.keeps_space = keeps_space
        self.others = Pieces(self.whole, OTHERS)
        self.known = Pieces(self._piece, WORDS)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _merged(self, word: str) -> bytes:
        """Ids of one pre-token of Latin letters, led by a blank at most."""
        if word.isascii():
            spelled = word.replace(" ", "\u0120")
        else:
            spelled = word.encode().decode("latin-1").translate(self.letters)
        return array("I", [x.id for x in self.model.tokenize(spelled)]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """A piece between blanks; a line feed starts it or is absent."""
        plain = _PLAIN.fullmatch(piece)
        if not plain:
            return self.whole(" " + piece if self.keeps_space and piece[:1] != "\n" else piece)
        line, word, marks = plain.groups()
        if not self.keeps_space:
            ids = self._merged(word.lower())
        else:
            ids = self.others[line] + self._merged(word) if line else self._merged(" " + word)
        return ids + self.others[marks] if marks else ids

    def encode(self, text: str) -> bytes:
        if not self.keeps_space:
            return b"".join(map(self.known.__getitem__, text.replace("\n", " ").split(" ")))
        spread = text.replace("\n", " \n")
        if "  " in spread or "\n " in spread or _OTHER_SPACE.search(text):
            return self.whole(text)  # a run of white space must not be cut
        first, *rest = spread.split(" ")
        return self.whole(first) + b"".join(map(self.known.__getitem__, rest))


@lru_cache(maxsize=2)
def encoder(path: str, keeps_space: bool) -> Encoder:
    """One encoder per worker process, kept between tasks."""
    return Encoder(path, keeps_space)
