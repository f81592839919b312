"""Character classes and byte letters of byte-level tokenizers."""

from __future__ import annotations

import re
import unicodedata

import numpy as np

#: Unicode's White_Space, as the tokenizer's own expressions have it.
WHITE = "\t-\r \x85\xa0  -     　"
#: Latin letters and general punctuation, on which all editions of Unicode agree.
LATIN = re.compile("[\\x00-\u024f\u2010-\u2027\u20ac]*")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(moved)}


def class_of(kind: str) -> str:
    """A regular expression's class of the characters of a general category among those of LATIN."""
    marks = np.array([unicodedata.category(chr(c))[0] == kind for c in range(0x250)], np.int8)
    edges = np.diff(np.concatenate(([0], marks, [0])))
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)))
