"""Pre-token splitting and word-level caches for the public BPE tokenizers.

A BPE tokenizer merges inside pre-tokens only, so the ids of a text are the
concatenated ids of its pre-tokens.  Texts whose characters all lie below
U+0180 are split here with one compiled pattern over explicit character
classes; any other text is split by the tokenizer library itself, so no result
depends on which Unicode version Python carries.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

LIMIT = 0x180  # below it: no combining marks, NFC is the identity, lower-casing stays below
# U+0130 lowers to a letter and a combining mark, so it takes the library path
OUTSIDE = re.compile(f"[^\\x00-\\u012f\\u0131-\\u{LIMIT - 1:04x}]")
SPACE = "\\t-\\r \\x85\\xa0"


def _char_class(prefix: str) -> str:
    """Ranges of the code points below LIMIT whose category starts with prefix."""
    points = [c for c in range(LIMIT) if unicodedata.category(chr(c)).startswith(prefix)]
    out, start = [], None
    for i, c in enumerate(points):
        start = c if start is None else start
        if i + 1 == len(points) or points[i + 1] != c + 1:
            out.append(f"\\u{start:04x}-\\u{c:04x}")
            start = None
    return "".join(out)


LETTER, NUMBER = _char_class("L"), _char_class("N")
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"  # fixed values of both tokenizers
#: words of word_bpe_49k.json, after lower-casing
WORDS = re.compile(f"{CONTRACTIONS}|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+")
#: pieces of byte_bpe_50k.json
PIECES = re.compile(
    f"{CONTRACTIONS}| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+"
    f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_alphabet() -> dict[int, str]:
    """The byte-level BPE alphabet: printable bytes stand for themselves, the
    others for the code points from U+0100 on, in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordCache(dict):
    """word -> value, computed by ``make`` on a miss; emptied when full, so a
    task's memory does not grow with its vocabulary."""

    def __init__(self, make: Callable, limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.make(word)
        return value


def split_specials(text: str, specials: re.Pattern) -> list[tuple[str, bool]]:
    """(segment, is special) in order; special strings stand alone."""
    out, at = [], 0
    for m in specials.finditer(text):
        out += [(text[at:m.start()], False), (m.group(), True)]
        at = m.end()
    return [*out, (text[at:], False)]
