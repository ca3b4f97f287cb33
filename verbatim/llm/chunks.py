"""Cuts a text where byte-level BPE always cuts it, so that its parts can be encoded once.

The pre-tokenizer's pattern lets no piece run from a non-space into a space, so a cut before
a run of spaces or line feeds that follows something else never goes through a piece, and
the pattern's look-ahead past the run stays within the part.  Texts with any other white
space are left whole.
"""

from __future__ import annotations

import re

import numpy as np

_OTHER_SPACE = re.compile("[\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]")
_PART = re.compile("[ \n]*[^ \n]+|[ \n]+")


def parts(text: str) -> list[str]:
    """Consecutive parts of a text that are encoded independently of each other."""
    if _OTHER_SPACE.search(text):
        return [text]
    return _PART.findall(text)


def part_starts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``parts`` of many texts at once: their joined bytes in UTF-8, where each part starts in
    them, and where each text starts, with the end."""
    raw = [t.encode() for t in texts]
    joined = np.frombuffer(b"".join(raw), np.uint8)
    begins = np.cumsum([0] + [len(r) for r in raw])
    space = (joined == 0x20) | (joined == 0x0A)
    cut = space.copy()
    cut[1:] &= ~space[:-1]
    for i, text in enumerate(texts):
        if _OTHER_SPACE.search(text):
            cut[begins[i]:begins[i + 1]] = False
    cut[begins[:-1][np.diff(begins) > 0]] = True
    return joined, np.flatnonzero(cut), begins
