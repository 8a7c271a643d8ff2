"""Texts of an Arrow column as words and flat arrays.

A word is a maximal run of characters other than the space and U+0009 to U+000D. In UTF-8 these
are single bytes, and ``bytes.split()`` splits at exactly them.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes of text worked on at once; a longer text stands alone.
SLICE_BYTES = 1 << 20


class Vocabulary(dict):
    """Numbers things in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n

    def ids(self, things: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, things), np.int64, len(things))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and the offsets of each; null counts as empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows with about ``most`` bytes each."""
    data, offsets = flat(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def split_words(data: np.ndarray, offsets: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The words of all rows of a slice in order, and the offsets of each row's words."""
    raw, words, ends = data.tobytes(), [], [0]
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        words += raw[a:b].split()
        ends.append(len(words))
    return words, np.array(ends, np.int64)


def word_array(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.LargeBinaryArray, np.ndarray]:
    """The words of all rows of a slice in order, as one Arrow array, and the offsets of each row's words."""
    inside = ~SPACE[data]
    edges = np.zeros(len(data) + 1, bool)  # at the first byte of each word, and past its last
    edges[1:-1] = inside[1:] != inside[:-1]
    if len(data):
        edges[0], edges[-1] = inside[0], inside[-1]
    # A word that goes on over the start of a row is two words: what ends there starts there too.
    cuts = np.unique(offsets[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    marks = np.flatnonzero(edges)
    starts, stops = marks[::2], marks[1::2]
    if len(cuts):
        starts, stops = np.sort(np.concatenate([starts, cuts])), np.sort(np.concatenate([stops, cuts]))
    ends = np.concatenate([[0], np.cumsum(stops - starts)])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])])
    return words, np.searchsorted(starts, offsets)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The sum of each row's values."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def count_words(texts: pa.Array) -> np.ndarray:
    """Words of each text, counted on the bytes."""
    out = np.zeros(len(texts), np.int64)
    for first, data, offsets in slices(texts):
        inside = ~SPACE[data]
        starts = inside.copy()
        starts[1:] &= ~inside[:-1]
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        starts[heads] = inside[heads]
        out[first : first + len(offsets) - 1] = sums(starts.astype(np.int64), offsets)
    return out


def repeated_window_words(ids: np.ndarray, n_ids: int, width: int = 3) -> int:
    """Words in ``width``-word windows that occur twice or more in the sequence, the first occurrence included."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    key = ids[:n]
    for k in range(1, width):
        if n_ids and key.max(initial=0) >= (1 << 62) // max(n_ids, 1):
            key = np.unique(key, return_inverse=True)[1]
        key = key * n_ids + ids[k : k + n]
    _, at, counts = np.unique(key, return_inverse=True, return_counts=True)
    again = (counts[at] > 1).astype(np.int64)
    edge = np.zeros(len(ids) + 1, np.int64)
    edge[:n] += again
    edge[width : width + n] -= again
    return int(np.count_nonzero(np.cumsum(edge)))
