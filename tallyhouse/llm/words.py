"""Words of UTF-8 texts as 64-bit hashes, by whole arrays."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

U64 = np.uint64
WHITE = b" \t\n\x0b\x0c\r"
CHUNK = 1 << 20  # bytes hashed at a time, so that temporary arrays stay small
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(WHITE)] = True
_BASE = 0x9E3779B97F4A7C15
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits each depend on all input bits (splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def weights(n: int, seed: int) -> np.ndarray:
    """n odd 64-bit factors."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(_BASE) + U64(seed)) | U64(1)


class Words(NamedTuple):
    hash: np.ndarray  # one 64-bit hash a word, equal for equal words
    first: np.ndarray  # index of the first word of each text, and the number of words at the end

    @property
    def text(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    @property
    def position(self) -> np.ndarray:
        """Index of each word within its text."""
        return np.arange(len(self.hash)) - np.repeat(self.first[:-1], np.diff(self.first))


def _hash_chunk(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    white = _IS_WHITE[data]
    inside = ~white
    starts = np.flatnonzero(inside & np.concatenate(([True], white[:-1])))
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    first = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.zeros(0, U64), first
    ends = np.flatnonzero(white & np.concatenate(([False], inside[:-1])))
    length = ends - starts
    offset = np.arange(len(data), dtype=np.int64)
    offset -= np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(data)]))))
    np.minimum(offset, length.max(), out=offset)  # white space, which counts nothing below
    power = np.cumprod(np.full(int(length.max()) + 1, _BASE, U64))
    value = (data.astype(U64) + U64(1)) * power[offset]
    value[white] = 0
    return mix(np.add.reduceat(value, starts) + length.astype(U64) * U64(_BASE)), first


def hash_words(texts: list[bytes]) -> Words:
    """Hashes of the words between ASCII white space. Equal words have equal hashes; an empty text has no words."""
    hashes, firsts, done, i = [np.zeros(0, U64)], [np.zeros(1, np.int64)], 0, 0
    while i < len(texts):
        size, j = 0, i
        while j < len(texts) and (j == i or size + len(texts[j]) <= CHUNK):
            size += len(texts[j])
            j += 1
        h, first = _hash_chunk(texts[i:j])
        hashes.append(h)
        firsts.append(first[1:] + done)
        done += len(h)
        i = j
    return Words(np.concatenate(hashes), np.concatenate(firsts))


def window_hashes(words: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A hash of every run of `width` consecutive words, across text borders too; callers leave those out."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    for k, factor in enumerate(weights(width, seed)):
        total += words[k : k + n] * factor
    return mix(total)


def whole_windows(words: Words, width: int) -> np.ndarray:
    """True where a run of `width` words starts that ends within the same text."""
    n = max(0, len(words.hash) - width + 1)
    last = np.repeat(words.first[1:], np.diff(words.first))[:n]
    return np.arange(n) + width <= last


def encode(texts) -> list[bytes]:
    """UTF-8 of texts; null is empty."""
    return [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
