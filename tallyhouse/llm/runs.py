"""Periodic runs of words: maximal stretches that repeat a shorter sequence three times or more.

At the scale B, a power of two, every aligned block of B words is looked for in the window that follows it, at the distances B
to 2B - 1 (the smallest scale takes all distances below 2B). A run of period q is at least 3q words long, so that it holds a
whole aligned block of the scale below or at q together with the copy of it q words on: no run is missed. A block occurs at a
distance when the sum of squared differences of the word numbers is zero there, that is sum x^2 + sum y^2 - 2 sum xy; the last
sum is a convolution, computed for all distances at once by a number-theoretic transform, in whole numbers modulo a prime.
A zero seeds an extension, which compares the words themselves, so that a number that is zero modulo the prime only is found out.

Two exact tests save most transforms. A block cannot recur at a distance below 2B if one of its words does not, which the
distance from each word to its next occurrence tells. A block whose window lies within a run of a smaller period that is known
already has nothing new: by Fine and Wilf, what it finds there is a multiple of that period.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.native import let, words_of
from tallyhouse.llm.words import U64, Words, encode, hash_words, mix

SHORTEST, TIMES, LEAST_BLOCK = 24, 3, 8  # words in a run; periods in a run; words in a block of the smallest scale
PRIME, ROOT = 998244353, 3  # 119 * 2^23 + 1 and a generator of its multiplicative group
LONGEST_BLOCK = 1 << 14  # a longer block is looked for by its first words, so that a transform stays small
ROWS = 1 << 18  # numbers transformed at a time
CHUNK = 4 << 20  # bytes of text worked on at a time
_RUNS = "array<struct<start: long, length: long, period: long>>"
_OUT = f"doc_id long, n_words long, runs {_RUNS}, collapsed string"
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.string()),
])


@lru_cache(maxsize=64)
def _roots(half: int, inverse: bool) -> np.ndarray:
    """The powers of a primitive root of unity of order 2 * half."""
    base = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
    base = pow(base, PRIME - 2, PRIME) if inverse else base
    out = np.ones(half, U64)
    done = 1
    while done < half:  # doubles what there is
        step = U64(pow(base, done, PRIME))
        out[done : 2 * done] = out[: min(done, half - done)] * step % U64(PRIME)
        done *= 2
    return out


def transform(rows: np.ndarray) -> np.ndarray:
    """The number-theoretic transform of every row (a power of two long), in bit-reversed order."""
    p, (m, n) = U64(PRIME), rows.shape
    half = n // 2
    while half:
        pairs = rows.reshape(m, -1, 2, half)
        u, v = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack(((u + v) % p, (u + (p - v)) * _roots(half, False) % p), 2).reshape(m, n)
        half //= 2
    return rows


def untransform(rows: np.ndarray) -> np.ndarray:
    """The inverse of `transform`, from bit-reversed order."""
    p, (m, n) = U64(PRIME), rows.shape
    half = 1
    while half < n:
        pairs = rows.reshape(m, -1, 2, half)
        u, v = pairs[:, :, 0], pairs[:, :, 1] * _roots(half, True) % p
        rows = np.stack(((u + v) % p, (u + (p - v)) % p), 2).reshape(m, n)
        half *= 2
    return rows * U64(pow(n, PRIME - 2, PRIME)) % p


def squared_differences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """For every row, the sum of squared differences of the block and each stretch of the window as long, modulo the prime."""
    p, size, length = U64(PRIME), blocks.shape[1], windows.shape[1]
    n = 1 << (length - 1).bit_length()
    x, y = np.zeros((len(blocks), n), U64), np.zeros((len(blocks), n), U64)
    x[:, :size], y[:, :length] = blocks[:, ::-1], windows
    product = untransform(transform(x) * transform(y) % p)[:, size - 1 : length]  # what wraps around falls before these
    squares = np.concatenate((np.zeros((len(windows), 1), U64), np.cumsum(windows * windows % p, 1, dtype=U64)), 1)
    own = (blocks * blocks % p).sum(1, dtype=U64)[:, None]
    return (own + squares[:, size:] - squares[:, :-size] + U64(2) * (p - product)) % p


def _agree(words: np.ndarray, i: int, j: int, n: int, step: int) -> int:
    """How many of the n pairs words[i], words[j], then i + step, j + step, and so on are equal before the first that is not."""
    done, width = 0, 64
    while done < n:
        m = min(width, n - done)
        a, b = i + step * done, j + step * done
        same = words[a : a + m] == words[b : b + m] if step > 0 else (words[a - m + 1 : a + 1] == words[b - m + 1 : b + 1])[::-1]
        if not same.all():
            return done + int(same.argmin())
        done, width = done + m, 2 * width
    return done


def _is_primitive(words: np.ndarray) -> bool:
    """Whether the words are not a shorter sequence repeated a whole number of times."""
    n = len(words)
    divisors = {d for k in range(1, int(n**0.5) + 1) if n % k == 0 for d in (k, n // k)} - {n}
    return not any(np.array_equal(words[d:], words[:-d]) for d in sorted(divisors))


class _Texts:
    """The words of several texts in a row, and the runs found in them, as (start, end, period) of the whole row."""

    def __init__(self, words: Words):
        self.word, self.first = words.hash, words.first
        self.number = self.word % U64(PRIME)
        self.long = np.flatnonzero(np.diff(self.first) >= SHORTEST)  # texts that can hold a run
        self.next = self._next(words)
        self.found: list[tuple[int, int, int]] = []

    @staticmethod
    def _next(words: Words) -> np.ndarray:
        """Distance from each word to its next occurrence in the same text; a large number if there is none."""
        key = mix(words.hash + words.text.astype(U64) * U64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        out = np.full(len(key), np.iinfo(np.int64).max)
        same = key[order][1:] == key[order][:-1]
        out[order[:-1][same]] = np.diff(order)[same]
        return out

    def search(self) -> list[tuple[int, int, int]]:
        block = LEAST_BLOCK
        while len(self.long):
            self._scale(block)
            block *= 2
            self.long = self.long[np.diff(self.first)[self.long] >= TIMES * block]
        return self.found

    def _scale(self, block: int) -> None:
        low = 1 if block == LEAST_BLOCK else block
        sizes = np.diff(self.first)[self.long]
        many = -(-sizes // block)
        text = np.repeat(self.long, many)
        at = self.first[text] + block * (np.arange(len(text)) - np.repeat(np.cumsum(many) - many, many))
        end = self.first[text + 1]
        near = np.maximum.reduceat(self.next, at) < 2 * block  # the last block of a text takes what follows in, and is left out
        fits = at + low + block <= end
        reach = np.zeros(len(self.word) + 1, np.int64)
        for s, e, _ in self.found:
            reach[s] = max(reach[s], e)
        known = np.maximum.accumulate(reach)[at] >= np.minimum(at + 3 * block, end)
        chosen = near & fits & ~known
        seeds = sorted(self._seeds(at[chosen], end[chosen], block, low))
        last: tuple[int, int] = (-1, -1)  # period, and end of the stretch that has been extended
        for period, start, stop, size in seeds:
            if last[0] == period and start + period + size <= last[1]:
                continue
            low_end = int(self.first[np.searchsorted(self.first, start, "right") - 1])
            last = (period, self._extend(start, period, size, low_end, stop))

    def _seeds(self, at: np.ndarray, end: np.ndarray, block: int, low: int) -> Iterator[tuple[int, int, int, int]]:
        """(distance, start, end of the text, words compared) of each zero."""
        size = min(block, LONGEST_BLOCK)
        for shift in range(low, 2 * block, size if block > LEAST_BLOCK else 2 * block):
            width = (2 * block - low if block == LEAST_BLOCK else size) + size - 1
            rows = max(1, ROWS // (2 * width))
            for k in range(0, len(at), rows):
                a, e = at[k : k + rows, None], end[k : k + rows, None]
                place = a + shift + np.arange(width)
                inside = place < e
                window = np.where(inside, self.number[np.minimum(place, len(self.number) - 1)], U64(0))
                zero = squared_differences(self.number[a + np.arange(size)], window) == 0
                zero &= a + shift + np.arange(zero.shape[1]) + size <= e
                for r, t in zip(*np.nonzero(zero)):
                    yield shift + int(t), int(a[r, 0]), int(e[r, 0]), size

    def _extend(self, start: int, period: int, size: int, first: int, end: int) -> int:
        """Keeps the run of this period around a seed, if there is one; the end of the stretch that has the period."""
        w = self.word
        right = _agree(w, start, start + period, end - period - start, 1)
        if right < size:
            return start  # equal modulo the prime only
        left = _agree(w, start - 1, start - 1 + period, start - first, -1)
        s, e = start - left, start + right + period
        if e - s >= max(SHORTEST, TIMES * period) and _is_primitive(w[s : s + period]):
            self.found.append((s, e, period))
        return e


def runs_of(texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int, int]]]]:
    """For every text its number of words, and its runs as (start, length, period) by start, then period."""
    words = hash_words(texts)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if len(words.hash):
        for s, e, q in sorted(_Texts(words).search()):
            text = int(np.searchsorted(words.first, s, "right")) - 1
            found[text].append((s - int(words.first[text]), e - s, q))
    return np.diff(words.first).tolist(), [sorted(set(f), key=lambda r: (r[0], r[2])) for f in found]


def collapse(text: bytes, runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by a space, without those that a run holds after its first period."""
    words = text.split()
    if runs:
        gone = np.zeros(len(words), bool)
        for start, length, period in runs:
            gone[start + period : start + length] = True
        words = [words[i] for i in np.flatnonzero(~gone).tolist()]
    return b" ".join(words)


def find_runs(docs: DataFrame) -> DataFrame:
    """One row a document: its words, its periodic runs by start, then period, and its text with the repetitions left out.

    A run is a maximal stretch of words whose smallest period is `period`, at least 24 words and three periods long. Words are
    what ASCII white space separates. A null or empty text has no words and no runs and collapses to the empty text. Documents
    are taken each for itself, so repeated and null ids stay as they are; a text of any length is searched whole, in memory
    in proportion to it. Columns but doc_id and text are not read. There is no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, i = batch["doc_id"].to_pylist(), encode(batch["text"].to_pylist()), 0
            while i < len(ids):
                j, size = i, 0
                while j < len(ids) and (j == i or size + len(texts[j]) <= CHUNK):
                    size += len(texts[j])
                    j += 1
                counts, runs = runs_of(texts[i:j])
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids[i:j], pa.int64()), pa.array(counts, pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in f] for f in runs], _SCHEMA.field("runs").type),
                    pa.array([collapse(t, f).decode("utf-8", "surrogatepass") for t, f in zip(texts[i:j], runs)], pa.string()),
                ], schema=_SCHEMA)
                i = j

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, _OUT)


def planted(doc_id: Column, text: Column) -> Column:
    """The text that the query judges: of a tenth of the documents, the words from one on repeat with a period."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("long")
        tail = F.transform(F.sequence(F.lit(0).cast("long"), n - a - 1), lambda i: F.get(words, (a + i % p).cast("int")))
        return F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), tail), " ")

    words = words_of(text)
    return F.when((h % 10 == 0) & (F.get(words, F.lit(0)) != ""), let(words, repeated)).otherwise(text)


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the run with the most repetitions (the first of equals), and hashes of all runs and of what is left."""
    longer = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    best = F.aggregate("runs", none, lambda b, r: F.when(longer(b, r), r).otherwise(b))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), *[F.col("best")[c].alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
