"""Words and word n-grams of Arrow text columns, as numpy arrays.

Everything works on the UTF-8 bytes of a whole slice of texts at once. Hashes are 64 bits: two
different sequences collide with a chance of about 2**-58, which callers accept or confirm.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 21
LONG_WORD = 48
PRIME, STEP = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE
#: Bytes of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after A-Z are lower-cased: digits, letters and all of UTF-8's high bytes.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """The words of a slice of texts: those of text d are ptr[d] to ptr[d + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    ptr: np.ndarray
    hash: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ptr) - 1), np.diff(self.ptr))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive slices of about ``most`` bytes, or one text where that is longer; null counts as empty."""
    if not len(texts):
        return
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, texts.slice(at, upto - at)
        at = upto


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a large_string array without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def words(texts: pa.Array, kind: np.ndarray = NOT_SPACE, lower: bool = False, hashed: bool = True) -> Words:
    data, offsets = raw(texts)
    if lower:
        data = LOWER[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    inside = np.concatenate(([False], kind[data], [False]))
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    ptr = np.searchsorted(start, offsets)
    return Words(data, start, end, ptr, word_hashes(data, start, end) if hashed else np.empty(0, np.uint64))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes: byte by byte over all words of at least that length together."""
    size = end - start
    short = np.minimum(size, LONG_WORD + 1).astype(np.uint8)
    order = np.argsort(short, kind="stable")[::-1]
    at, left = start[order], np.cumsum(np.bincount(short, minlength=LONG_WORD + 2)[::-1])[::-1]
    h = np.full(len(order), 0xCBF29CE484222325, np.uint64)
    for k in range(LONG_WORD):
        m = left[k + 1]
        if not m:
            break
        part = h[:m]
        part ^= data[at[:m] + k]
        part *= PRIME
    h = mix(h)
    for i in range(int(left[LONG_WORD + 1])):
        h[i] = xxhash.xxh3_64_intdigest(data[start[order[i]] : end[order[i]]].tobytes())
    out = np.empty_like(h)
    out[order] = h
    return out


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive entries of h (len(h) - n + 1 of them), by doubling."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    total, width, done, power = None, 1, 0, h
    while True:
        if n & width:
            if total is None:
                total, done = power, width
            else:
                shift = power_of(done)
                count = len(h) - done - width + 1
                total, done = power[:count] * shift + total[width : width + count], done + width
        width *= 2
        if width > n:
            return mix(total[: len(h) - n + 1])
        half = width // 2
        power = power[: len(power) - half] * power_of(half) + power[half:]


def power_of(n: int) -> np.uint64:
    return np.uint64(pow(int(STEP), n, 1 << 64))


def windows(w: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, first word) of every n consecutive words of one text."""
    g = ngrams(w.hash, n)
    doc = w.doc
    ok = np.flatnonzero(doc[: len(g)] == doc[n - 1 :]) if len(g) else np.empty(0, np.int64)
    return g[ok], doc[ok], ok
