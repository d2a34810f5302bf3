"""Words, lines and their hashes over the UTF-8 bytes of many texts at once, in numpy.

A hash is a polynomial in a random odd base modulo 2^64 over a random 64-bit value per byte, so the hash of any stretch
comes from two prefix sums, and n-grams of words are rolled from the word hashes in the same way. Modulo a power of two some long, regular strings
collide in every base, so stretches of more than `LONG` bytes are hashed one by one in another way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1 << 20
LONG = 512  # bytes

_RANDOM = np.random.default_rng(20240611)
BYTE_VALUES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
WORD_BASE = np.uint64(0xC2B2AE3D27D4EB4F)

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finisher: close polynomials become unrelated numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Texts:
    """Some texts as one byte array; text i is data[starts[i]:starts[i + 1]]. Null texts are empty."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, first: int):
        self.data, self.starts, self.first, self.n = data, starts, first, len(starts) - 1

    def word_bounds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, end) of every stretch without ASCII white space; words never cross texts."""
        space = SPACES[self.data]
        edge = np.ones(len(self.data) + 1, bool)
        edge[1:-1] = space[1:] != space[:-1]
        edge[self.starts] = True
        at = np.flatnonzero(edge)
        begin, end = at[:-1], at[1:]
        word = ~space[begin] if len(begin) else np.zeros(0, bool)
        begin, end = begin[word], end[word]
        return np.searchsorted(self.starts, begin, "right") - 1, begin, end

    def line_bounds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, start, end) of every \\n-split line with a word in it."""
        text, begin, end = self.word_bounds() if not hasattr(self, "_words") else self._words
        breaks = np.zeros(len(self.data) + 1, bool)
        breaks[:-1] = self.data == 10
        breaks[self.starts] = True
        edge = np.flatnonzero(breaks)  # a line runs from one edge to the next; the edge itself may be its \n or a text's start
        line = np.unique(np.searchsorted(edge, begin, "right") - 1)
        left = edge[line]
        right = edge[np.minimum(line + 1, len(edge) - 1)]
        skip = (self.data[np.minimum(left, len(self.data) - 1)] == 10) if len(self.data) else np.zeros(0, bool)
        return np.searchsorted(self.starts, left, "right") - 1, left + skip, right

    def hashes(self, begin: np.ndarray, end: np.ndarray, fold: bool = False) -> np.ndarray:
        """64-bit hash of each stretch; with `fold` as if A-Z were lower-cased."""
        data = LOWER[self.data] if fold else self.data
        if not hasattr(self, "_inverse"):
            self._inverse = powers(INVERSE, len(data))
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * powers(BASE, len(data))[:-1], out=prefix[1:])
        found = mixed((prefix[end] - prefix[begin]) * self._inverse[begin] + (end - begin).astype(np.uint64))
        for i in np.flatnonzero(end - begin > LONG):
            found[i] = xxhash.xxh3_64_intdigest(data[begin[i] : end[i]].tobytes())
        return found

    def characters(self) -> np.ndarray:
        """Code points before each byte position."""
        count = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum((self.data & 0xC0) != 0x80, out=count[1:])
        return count


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[Texts]:
    """A batch of strings (or binaries) in parts of about `size` bytes; a longer text is a part of its own."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield Texts(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], a)
        a = b


def windows(text: np.ndarray, words: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of every n-word window that stays in one text; `words` are word hashes."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(count, np.uint64)
    for k in range(n):
        h = h * WORD_BASE + words[k : count + k]
    first = np.flatnonzero(text[:count] == text[n - 1 :])
    return first, mixed(h[first])


def groups(text: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, opens): rows sorted so that equal (text, key) are neighbours in their old order, and where a group begins.
    `text` must not decrease."""
    order = np.argsort(key, kind="stable")
    k, t = key[order], text[order]
    opens = np.ones(len(key), bool)
    opens[1:] = (k[1:] != k[:-1]) | (t[1:] != t[:-1])
    return order, opens


def repeated(text: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether a row's (text, key) occurs more than once."""
    order, opens = groups(text, key)
    alone = opens & np.append(opens[1:], True) if len(opens) else opens
    out = np.zeros(len(key), bool)
    out[order] = ~alone
    return out
