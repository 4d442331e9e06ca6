"""Words and word shingles of UTF-8 texts as 64-bit hashes, for a batch of texts at a time.

A word is a run of bytes other than space and U+0009 to U+000D, with A-Z in lower case. All of
it works on bytes: a continuation byte is never a space or a letter of A-Z.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np

BATCH_BYTES = 1 << 21

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
AS_IS = np.arange(256, dtype=np.uint8)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
# All of ASCII but letters and digits.
IS_MARK = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection that spreads every bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(seed: int, count: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


LENGTH_KEY = _keys(1, 1)[0] | np.uint64(1)
MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)
SHINGLE_KEYS = _keys(3, 64) | np.uint64(1)


def encoded(texts: Iterable[str | None]) -> list[bytes]:
    """UTF-8 of each text; null is empty, and lone surrogates become question marks."""
    return [b"" if t is None else t.encode("utf-8", "replace") for t in texts]


def batches(texts: Sequence[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes; a longer text is a range of its own."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def word_bounds(buffer: np.ndarray, breaks: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a buffer that ends in a break."""
    space = breaks[buffer]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(space) and not space[0]:
        edges = np.concatenate([np.zeros(1, edges.dtype), edges])
    return edges[0::2], edges[1::2]


def word_hashes(texts: Sequence[bytes], breaks: np.ndarray = IS_SPACE, letters: np.ndarray = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the number of words up to its end.

    ``breaks`` says which bytes are not part of a word; line feed and space must be among them.
    ``letters`` replaces each byte first; AS_IS leaves them unchanged.

    A word is hashed eight bytes at a time, all words of the batch at once; only the words that
    are longer take part in the next round.
    """
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    buffer = letters[np.frombuffer(b"\n".join([*texts, b" " * 8]), dtype=np.uint8)]
    starts, ends = word_bounds(buffer, breaks)
    upto = np.searchsorted(starts, np.cumsum(sizes), "left")
    if not len(starts):
        return np.zeros(0, np.uint64), upto
    eight = np.ndarray((len(buffer) - 7,), dtype="<u8", buffer=buffer, strides=(1,))
    lengths = (ends - starts).astype(np.uint64)
    with np.errstate(over="ignore"):
        hashes = lengths * LENGTH_KEY
        hashes = mix(hashes + (eight[starts] & MASKS[np.minimum(lengths, 8)]))
        left, at = np.flatnonzero(lengths > 8), 8
        while len(left):
            rest = np.minimum(lengths[left] - np.uint64(at), 8)
            hashes[left] = mix(hashes[left] * LENGTH_KEY + (eight[starts[left] + at] & MASKS[rest]))
            at += 8
            left = left[lengths[left] > at]
    return hashes, upto


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words in order; a shorter sequence is one shingle, none is none."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        size = min(n, width)
        total = np.full(n - size + 1, size, dtype=np.uint64)
        for k in range(size):
            total = total + words[k : n - size + 1 + k] * SHINGLE_KEYS[k]
        return mix(total)


def shingle_sets(texts: Sequence[bytes], width: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for first, last in batches(texts):
        words, upto = word_hashes(texts[first:last])
        begin = 0
        for end in upto:
            yield np.unique(shingle_hashes(words[begin:end], width))
            begin = end
