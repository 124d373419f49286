"""Texts of a batch as one array of code points, for kernels that work on all of them at once."""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import numpy as np

BREAK, WORD, DROP = 0, 1, 2
#: Bracket tags such as [laughs], [/shouting], [clears throat].
TAG = re.compile(r"\[\s*/?\s*[A-Za-z_ \-]{1,40}?\s*\]")
#: Texts are joined by this character; occurrences of it in a text count as blanks.
SEAM = "\0"
#: Vowel marks and other signs above and below Arabic letters, and the stretching stroke. Madda and hamza aren't among them.
VOWEL_MARKS = ((0x0610, 0x061A), (0x064B, 0x0652), (0x0656, 0x065F), (0x0670, 0x0670), (0x06D6, 0x06DC), (0x06DF, 0x06E4), (0x06E7, 0x06E8), (0x06EA, 0x06ED), (0x0640, 0x0640), (0x08D3, 0x08FF))


@cache
def kinds() -> np.ndarray:
    """BREAK, WORD or DROP of every code point: letters, digits and marks make words; vowel marks and characters without a glyph vanish."""
    table = np.full(0x110000, WORD, np.uint8)  # planes of rare letters and private use count as letters
    for c in range(0x30000):
        kind = unicodedata.category(chr(c))
        if kind in ("Cf", "Cc") and chr(c) not in "\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85":
            table[c] = DROP
        elif kind[0] not in "LNM":
            table[c] = BREAK
    for low, high in VOWEL_MARKS:
        table[low : high + 1] = DROP
    table[0xFE00:0xFE10] = DROP
    table[0xE0100:0xE01F0] = DROP
    table[0] = BREAK
    return table


def plain(texts: list[str], keep_tags: bool = False) -> str:
    """The texts joined by SEAM, in compatibility form and lower case, without bracket tags."""
    joined = SEAM.join(t.replace(SEAM, " ") if SEAM in t else t for t in texts)
    joined = unicodedata.normalize("NFKC", joined)
    if not keep_tags and "[" in joined:
        joined = TAG.sub(" ", joined)
    return joined.casefold()


class Words:
    """The words of a batch of texts.

    chars: code points of all words, without anything between; starts: where each word begins in chars, and at the end
    the length of chars; text_of: the text of each word; bounds: the first word of each text, and at the end the number
    of words.
    """

    def __init__(self, texts: list[str]):
        points = np.frombuffer(plain(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        kind = kinds()[points]
        text = np.cumsum(points == 0, dtype=np.int32)
        kept = kind != DROP
        if not kept.all():
            points, kind, text = points[kept], kind[kept], text[kept]
        word = kind == WORD
        begins = word.copy()
        begins[1:] &= ~word[:-1]
        at = np.flatnonzero(begins)
        place = np.cumsum(word) - 1
        self.chars = points[word]
        self.starts = np.append(place[at], len(self.chars)).astype(np.int64)
        self.text_of = text[at]
        self.char_text = text[word]
        self.bounds = np.searchsorted(self.text_of, np.arange(len(texts) + 1))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word."""
        n = len(self.starts) - 1
        if not n:
            return np.zeros(0, np.uint64)
        within = (np.arange(len(self.chars)) - np.repeat(self.starts[:-1], np.diff(self.starts))).astype(np.uint64)
        return mix(np.add.reduceat(mix(self.chars.astype(np.uint64) + (within << np.uint64(32))), self.starts[:-1]))


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs_of(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of each `length` consecutive word hashes."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = words[:n].copy()
    for i in range(1, length):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[i : n + i]
    return mix(total)
