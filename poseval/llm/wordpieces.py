"""Fast exact encoding with a word-level BPE tokenizer file.

The tokenizer lower-cases, drops white space and never joins across it, so a
text's ids are its words' ids in a row. Words repeat, so they are kept in a
bounded table per task; a word of plain letters goes straight to the BPE
model, anything else through the tokenizer's whole pipeline.
"""

from __future__ import annotations

import string

import numpy as np
from tokenizers import Tokenizer

#: Words of one generation; a task keeps two, of about 250 bytes a word.
KEPT_WORDS = 200_000
#: Letters below this need no normalization, and lower-case the same everywhere.
PLAIN = "İ"
MARKS = string.punctuation.replace("'", "")
#: Python splits at these, the tokenizer does not.
SEPARATORS = "\x1c\x1d\x1e\x1f"


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Bytes that print stand for themselves; the rest take the letters from 256 on.
    """
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b if b in prints else next(spare)) for b in range(256)]


class Words(dict):
    """Ids by word. A full generation becomes the old one, and words met again move on."""

    def __init__(self, make, old: dict[str, bytes]):
        self.make, self.old = make, old

    def __missing__(self, word: str) -> bytes:
        ids = self.old.pop(word, None)
        if ids is None:
            ids = self.make(word)
        self[word] = ids
        return ids


class WordTokenizer:
    """A tokenizer for one task. It is not kept by the worker, which other steps use after it."""

    def __init__(self, file: str):
        self.tokenizer = Tokenizer.from_file(file)
        self.tokenizer.encode_special_tokens = True
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.words = Words(self._word, {})

    def ids(self, text: str) -> bytes:
        """Ids as unsigned 32-bit little-endian numbers."""
        if len(self.words) > KEPT_WORDS:
            self.words = Words(self._word, dict(self.words))
        if any(c in text for c in SEPARATORS):
            return self._whole(text)
        words = self.words
        return b"".join([words[w] for w in text.split()])

    def forget(self) -> None:
        """Let go of the words, and of what they refer back to."""
        self.words = Words(None, {})

    def _word(self, word: str) -> bytes:
        if max(word) < PLAIN:
            stem = word.rstrip(MARKS)
            if stem.isalpha():
                lower, tail = stem.lower(), word[len(stem) :]
                if tail or lower != word:
                    return self.words[lower] + (self.words[tail] if tail else b"")
                text = lower if lower.isascii() else "".join([self.letters[b] for b in lower.encode()])
                return np.array([t.id for t in self.model.tokenize(text)], "<u4").tobytes()
        return self._whole(word)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
