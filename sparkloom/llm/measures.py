"""Measures of whole texts that the quality operators share, from numpy passes over chunks."""

from __future__ import annotations

import numpy as np

from sparkloom.llm.words import (BLANKS, Chunk, Words, byte_table, hash_runs, hash_words, mix,
                                 split_words)

# The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 5
_IS_SYMBOL = byte_table(SYMBOLS)
_IS_BLANK = byte_table(BLANKS)
_IS_WORD = byte_table(bytes(range(48, 58)) + bytes(range(65, 91)) + bytes(range(97, 123))
                      + bytes(range(128, 256)))
_BLANK_TEXT = BLANKS.decode()


def per_text(chunk: Chunk, flags: np.ndarray) -> np.ndarray:
    """How many bytes of each text are flagged."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[chunk.offsets[1:]] - sums[chunk.offsets[:-1]]


def per_word(words: Words, flags: np.ndarray) -> np.ndarray:
    """How many words of each text are flagged."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[words.first[1:]] - sums[words.first[:-1]]


def repeated_words(hashes: np.ndarray, words: Words) -> np.ndarray:
    """Flags the words inside a window of five that its text has twice or more."""
    runs, at = hash_runs(hashes, words, REPEAT_WINDOW)
    own = runs ^ mix(words.text[at].astype(np.uint64) + np.uint64(1))
    order = np.argsort(own)
    same = own[order[1:]] == own[order[:-1]]
    again = np.zeros(len(own) + 1, bool)
    again[:-1][1:] |= same if len(own) else False
    twice = np.zeros(len(own), bool)
    if len(own):
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
    edges = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edges, at[twice], 1)
    np.add.at(edges, at[twice] + REPEAT_WINDOW, -1)
    return np.cumsum(edges)[:-1] > 0


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    seen, n = set(), 0
    for line in text.split("\n"):
        if line.strip(_BLANK_TEXT):
            n += line in seen
            seen.add(line)
    return n


def base_measures(chunk: Chunk) -> dict[str, np.ndarray]:
    words = split_words(chunk)
    hashes = hash_words(chunk.data, words)
    body = chunk.data.tobytes()
    lines = [repeated_lines(body[a:b].decode()) if b > a else 0
             for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:])]
    characters = ((chunk.data & 0xC0) != 0x80) & ~_IS_BLANK[chunk.data]
    return {"n_words": np.diff(words.first), "word_chars": per_text(chunk, characters),
            "n_symbols": per_text(chunk, _IS_SYMBOL[chunk.data]),
            "n_dup_lines": np.array(lines, np.int64),
            "n_repeat_words": per_word(words, repeated_words(hashes, words))}


def tokens(chunk: Chunk) -> tuple[np.ndarray, Words]:
    """Hashes of runs of word characters and of runs of punctuation, in order of the text."""
    word = split_words(chunk, ~_IS_WORD)
    mark = split_words(chunk, _IS_WORD | _IS_BLANK)
    starts = np.concatenate((word.starts, mark.starts))
    order = np.argsort(starts, kind="stable")
    text = np.concatenate((word.text, mark.text))[order]
    both = Words(starts[order], np.concatenate((word.ends, mark.ends))[order], text,
                 np.searchsorted(text, np.arange(len(chunk.offsets))))
    return hash_words(chunk.data, both), both
