"""Lists of unequal length as (values, offsets) in numpy, and texts cut into words that tokenizers treat on their own."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa

from eddyline.llm.textbytes import slices

# ASCII characters that any of the libraries takes as white space; more than one of them does no harm, it only makes a word longer
ASCII_WHITE = np.zeros(256, bool)
ASCII_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
# fixed values: white space beyond ASCII, as the last two bytes of its UTF-8 form
THREE_BYTES = {0xE1: {0x9A80}, 0xE2: {*range(0x8080, 0x808B), 0x80A8, 0x80A9, 0x80AF, 0x819F}, 0xE3: {0x8080}}
TWO_BYTES = {0x85, 0xA0}


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def flat(lists: Sequence[Sequence[int]], kind: type = np.int64) -> tuple[np.ndarray, np.ndarray]:
    offsets = offsets_of(np.fromiter(map(len, lists), np.int64, len(lists)))
    return np.fromiter(chain.from_iterable(lists), kind, int(offsets[-1])), offsets


def gather(values: np.ndarray, offsets: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The lists `picks` one after the other: (values, offsets)."""
    lengths = (offsets[1:] - offsets[:-1])[picks]
    out = offsets_of(lengths)
    return values[np.repeat(offsets[:-1][picks] - out[:-1], lengths) + np.arange(out[-1])], out


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of each list."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def as_lists(values: pa.Array, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def white(data: np.ndarray) -> np.ndarray:
    """Whether a byte belongs to a white-space character."""
    out = ASCII_WHITE[data]
    for lead, ends in THREE_BYTES.items():
        at = np.flatnonzero(data[:-2] == lead) if len(data) > 2 else np.zeros(0, np.int64)
        at = at[np.isin((data[at + 1].astype(np.int32) << 8) | data[at + 2], list(ends))]
        for k in range(3):
            out[at + k] = True
    at = np.flatnonzero(data[:-1] == 0xC2) if len(data) > 1 else np.zeros(0, np.int64)
    at = at[np.isin(data[at + 1], list(TWO_BYTES))]
    out[at] = out[at + 1] = True
    return out


class Words:
    """The words of some texts: text i has the words codes[first[i]:first[i + 1]] of `distinct`.

    A text is cut before every single space that stands between two characters other than white space. The space opens its word, so words joined
    are the text. Tokenizers that start a token at such a space never join over it: the tokens of a text are those of its words.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        blank = white(data)
        cut = np.zeros(len(data) + 1, bool)
        if len(data) > 2:
            cut[1:-2] = (data[1:-1] == 0x20) & ~blank[:-2] & ~blank[2:]
            # a text's last space and the first character of the next text are no neighbours
            edges = starts[1:-1]
            cut[edges[edges > 0] - 1] = False
        cut[starts] = True
        at = np.flatnonzero(cut)
        words = pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(data))])
        coded = words.dictionary_encode()
        self.codes = coded.indices.to_numpy()
        self.distinct = coded.dictionary
        self.first = np.searchsorted(at[:-1], starts, "left")


def words_of(texts: pa.Array, size: int) -> Iterator[tuple[int, int, Words]]:
    """(first text, number of texts, their words) for parts of about `size` bytes; a longer text is a part of its own."""
    for part in slices(texts, size):
        yield part.first, part.n, Words(part.data, part.starts)
