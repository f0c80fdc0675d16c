"""Fast exact encoding with a byte-level BPE tokenizer file.

The tokenizer's pattern never joins a blank to what stands before it: a blank
followed by something visible always opens a new stretch. So a text's ids are
those of its pieces between such blanks, and pieces repeat. They are kept in a
bounded table per task; pieces of plain letters and marks go straight to the
BPE model, anything else through the tokenizer's whole pipeline.
"""

from __future__ import annotations

import re
import sys
from array import array
from functools import cache

from tokenizers import Tokenizer

from poseval.llm.wordpieces import MARKS, PLAIN, SEPARATORS, Words, _byte_letters

#: Pieces of one generation; a worker keeps two, of about 250 bytes a piece.
KEPT_PIECES = 400_000

#: A blank before white space or the end does not open a stretch.
LOOSE = re.compile(r" (?:\s|\Z)")
CUT = re.compile(r" (?=\S)")
#: White space to one of Python and the tokenizer only.
DOUBTFUL = SEPARATORS + "\x85᠎​"


class ByteTokenizer:
    """A tokenizer with its table of pieces."""

    def __init__(self, file: str):
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.inner, self.outer = Words(self._inner, {}), Words(self._outer, {})

    def ids(self, text: str) -> bytes:
        """Ids as unsigned 32-bit little-endian numbers."""
        if len(self.inner) > KEPT_PIECES:
            self.inner = Words(self._inner, dict(self.inner))
        if len(self.outer) > KEPT_PIECES:
            self.outer = Words(self._outer, dict(self.outer))
        if any(c in text for c in DOUBTFUL):
            return self._whole(text)
        first, *rest = CUT.split(text) if LOOSE.search(text) else text.split(" ")
        inner = self.inner
        return self.outer[first] + b"".join([inner[w] for w in rest])

    def _inner(self, piece: str) -> bytes:
        return self._piece(piece, " ")

    def _outer(self, piece: str) -> bytes:
        return self._piece(piece, "")

    def _piece(self, piece: str, blank: str) -> bytes:
        """Ids of a piece that follows a blank, or nothing."""
        head, line, tail = piece.partition("\n")
        if line and head and tail and not head[-1].isspace() and not tail[0].isspace():
            return (self.inner if blank else self.outer)[head] + self.outer["\n"] + self.outer[tail]
        stem = piece.rstrip(MARKS)
        if stem.isalpha() and (stem.isascii() or max(stem) < PLAIN):
            if len(stem) < len(piece):
                return (self.inner if blank else self.outer)[stem] + self.outer[piece[len(stem) :]]
            letters = stem if stem.isascii() else "".join([self.letters[b] for b in stem.encode()])
            return _ids([t.id for t in self.model.tokenize(self.letters[32] + letters if blank else letters)])
        return self._whole(blank + piece)

    def _whole(self, text: str) -> bytes:
        return _ids(self.tokenizer.encode(text, add_special_tokens=False).ids)


def _ids(numbers: list[int]) -> bytes:
    out = array("I", numbers)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


@cache
def tokenizer_of(file: str) -> ByteTokenizer:
    """The worker's tokenizer for a file; its pieces serve all tasks of the worker."""
    return ByteTokenizer(file)
