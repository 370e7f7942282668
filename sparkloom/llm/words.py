"""Words of Arrow text batches as numpy arrays, and 64-bit hashes of them.

Functions work on one chunk of whole texts at a time: ``data`` holds the UTF-8 bytes of all texts of
the chunk back to back, ``offsets[i]:offsets[i + 1]`` those of text ``i``. A null text is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19

# Blank characters, as in [^\x20\x09-\x0D]+ for a word.
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"

_rng = np.random.default_rng(20240229)
_BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5
_UNBASE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


class Chunk(NamedTuple):
    first: int            # row of the batch that is text 0 here
    data: np.ndarray      # uint8
    offsets: np.ndarray   # int64, one more than texts


class Words(NamedTuple):
    starts: np.ndarray    # byte positions in the chunk
    ends: np.ndarray
    text: np.ndarray      # index of the text that has the word
    first: np.ndarray     # per text and one more: index of its first word


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Whole texts, about ``limit`` bytes at a time; a longer text is a chunk of its own."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, where, body = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(body, np.uint8) if body is not None else np.empty(0, np.uint8)
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), len(texts))
        part = offsets[begin:end + 1]
        yield Chunk(begin, data[part[0]:part[-1]], part - part[0])
        begin = end


def byte_table(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_IS_BLANK = byte_table(BLANKS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def split_words(chunk: Chunk, is_blank: np.ndarray = _IS_BLANK) -> Words:
    """Maximal runs of bytes that are no separators; a run ends with its text."""
    data, offsets = chunk.data, chunk.offsets
    n_texts = len(offsets) - 1
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~is_blank[data]
    begins = inside[1:-1] & ~inside[:-2]
    finishes = inside[1:-1] & ~inside[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[1:-1][edges]
    finishes[edges - 1] = inside[1:-1][edges - 1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    first = np.searchsorted(text, np.arange(n_texts + 1))
    return Words(starts, ends, text, first)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(size: int) -> list[np.ndarray]:
    if len(_powers[0]) < size:
        size = max(size, CHUNK_BYTES + 1)
        for slot, base in ((0, _BASE), (1, _UNBASE)):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _powers[slot] = np.cumprod(steps, dtype=np.uint64)
    return _powers


def hash_words(data: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit hash of every word, from prefix sums over the chunk."""
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODE[data] * up[:len(data)], out=sums[1:], dtype=np.uint64)
    return mix((sums[words.ends] - sums[words.starts]) * down[words.starts])


def hash_runs(hashes: np.ndarray, words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside one text, and the index of their first words."""
    if len(hashes) < size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    last = len(hashes) - size + 1
    at = np.flatnonzero(words.text[:last] == words.text[size - 1:])
    total = np.zeros(last, np.uint64)
    for k in range(size):
        total += hashes[k:k + last] * _PLACE[k]
    return mix(total[at] + np.uint64(size)), at


def shingle_sets(chunk: Chunk, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles, A-Z in lower case.

    A text with fewer words has one shingle, its whole sequence; one without words has none.
    """
    data = lower_ascii(chunk.data)
    words = split_words(chunk)
    hashes = hash_words(data, words)
    runs, at = hash_runs(hashes, words, size)
    first_run = np.searchsorted(words.text[at], np.arange(len(chunk.offsets)))
    sets = []
    for i in range(len(chunk.offsets) - 1):
        a, b = words.first[i], words.first[i + 1]
        if b - a >= size:
            own = np.sort(runs[first_run[i]:first_run[i + 1]])
            sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif b > a:
            short = (hashes[a:b] * _PLACE[:b - a]).sum(dtype=np.uint64, keepdims=True)
            sets.append(mix(short + np.uint64(b - a)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
