"""Quality classifier: a generalised additive model with pairwise interactions, as lookup tables over binned features.

Features are numbers of a text alone. Each is cut into bins at quantiles of the training rows. Boosting goes round the features
in a cycle: a step fits a tree of few leaves to the loss gradients of one feature's bins and adds a small share of it to that
feature's table, so what the model says about a feature stays one lookup table. Then the pairs of features whose joint bins
explain most of what is left get tables of their own in the same way. A score is the sum of one table entry per feature and
pair through the logistic function, for a batch of texts at once.

The model is fitted on at most `MOST_ROWS` labelled rows, those with the smallest hash of their id; that is a bound of the
classifier's training alone. Every document is scored over its whole text.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.blocks import parts
from tallyhouse.llm.words import encode, hash_words, window_hashes
from tallyhouse.session import unused_name

MOST_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 120
LEAVES = 3
RATE = 0.15
THRESHOLD = 0.3
FOLDS = 5

FEATURES = (
    "log_chars", "log_words", "mean_word", "distinct_words", "same_as_before", "repeat_3", "top_word", "upper_share", "digit_share",
    "symbol_share", "bar_share", "bang_share", "stop_share", "comma_share", "other_ascii_share", "log_line", "distinct_lines", "long_word_share",
)
_CLASS = np.zeros(256, np.int64)  # 0 other, 1 upper, 2 digit, 3 symbol, 4 bar, 5 bang, 6 stop, 7 comma, 8 white, 9 other ASCII sign
for _chars, _k in ((range(65, 91), 1), (range(48, 58), 2), (b"#*$%&<>@^~_=+", 3), (b"|", 4), (b"!", 5), (b".?", 6), (b",;:", 7), (b" \t\n\x0b\x0c\r", 8), (b"\"'()/-[]{}\\`", 9)):
    _CLASS[list(_chars)] = _k


def features(texts: list[bytes]) -> np.ndarray:
    """One row a text. An empty text has 0 in every place."""
    out = np.zeros((len(texts), len(FEATURES)))
    words = hash_words(texts)
    for i, text in enumerate(texts):
        w = words.hash[words.first[i] : words.first[i + 1]]
        if not len(w):
            continue
        n, size = len(w), len(text)
        kinds = np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=10)
        _, counts = np.unique(w, return_counts=True)
        runs = window_hashes(w, 3, 5)
        lines = [x for x in text.split(b"\n") if x.strip()]
        out[i] = (
            np.log1p(size), np.log1p(n), (size - kinds[8]) / n, len(counts) / n, np.count_nonzero(w[1:] == w[:-1]) / n,
            1 - len(np.unique(runs)) / len(runs) if len(runs) else 0.0, counts.max() / n, kinds[1] / size, kinds[2] / size,
            kinds[3] / n, kinds[4] / n, kinds[5] / n, kinds[6] / n, kinds[7] / n, kinds[9] / n, np.log1p(n / max(1, len(lines))),
            len(set(lines)) / max(1, len(lines)), sum(len(x) > 20 for x in text.split()) / n,
        )
    return out


class Model(NamedTuple):
    """Cuts and tables; small, so it travels with the task."""

    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    pair_cuts: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for j, (c, t) in enumerate(zip(self.cuts, self.tables)):
            total += t[np.searchsorted(c, x[:, j], "right")]
        for (a, b), t in zip(self.pairs, self.pair_tables):
            total += t[np.searchsorted(self.pair_cuts[a], x[:, a], "right"), np.searchsorted(self.pair_cuts[b], x[:, b], "right")]
        return 1 / (1 + np.exp(-total))


def _cuts(x: np.ndarray, bins: int) -> np.ndarray:
    """Borders between bins: quantiles, each once; ties never fall on both sides of a border."""
    return np.unique(np.quantile(x, np.arange(1, bins) / bins)) if len(x) else np.zeros(0)


def _leaf_values(g: np.ndarray, h: np.ndarray, leaves: int) -> np.ndarray:
    """Values by bin of the shallow tree that splits an ordered feature where the loss falls most, one leaf at a time."""
    parts = [(0, len(g))]
    G, H = np.concatenate(([0], np.cumsum(g))), np.concatenate(([0], np.cumsum(h)))

    def gain(a: int, b: int) -> float:
        return (G[b] - G[a]) ** 2 / (H[b] - H[a] + 1.0)

    while len(parts) < leaves:
        best = max(((gain(a, m) + gain(m, b) - gain(a, b), i, m) for i, (a, b) in enumerate(parts) for m in range(a + 1, b)), default=(0, 0, 0))
        if best[0] <= 1e-9:
            break
        a, b = parts.pop(best[1])
        parts += [(a, best[2]), (best[2], b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = (G[b] - G[a]) / (H[b] - H[a] + 1.0)
    return out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS) -> Model:
    """Boosts main effects in cycles, then the pairs that explain most. Without rows, or with one label only, a constant."""
    rate = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    bias = float(np.log(rate / (1 - rate)))
    d = x.shape[1]
    cuts, pair_cuts = [_cuts(x[:, j], BINS) for j in range(d)], [_cuts(x[:, j], PAIR_BINS) for j in range(d)]
    bins = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(x), bias)
    if not 0 < y.sum() < len(y):
        return Model(cuts, tables, pair_cuts, [], [], bias)
    for _ in range(rounds):
        for j in range(d):
            p = 1 / (1 + np.exp(-total))
            step = RATE * _leaf_values(np.bincount(bins[j], y - p, len(tables[j])), np.bincount(bins[j], p * (1 - p), len(tables[j])), LEAVES)
            tables[j] += step
            total += step[bins[j]]
    small = [np.searchsorted(c, x[:, j], "right") for j, c in enumerate(pair_cuts)]
    sizes = [len(c) + 1 for c in pair_cuts]

    def joint(a: int, b: int) -> np.ndarray:
        return small[a] * sizes[b] + small[b]

    p = 1 / (1 + np.exp(-total))
    gains = []
    for a in range(d):
        for b in range(a + 1, d):
            at, n = joint(a, b), sizes[a] * sizes[b]
            gains.append((float((np.bincount(at, y - p, n) ** 2 / (np.bincount(at, p * (1 - p), n) + 5.0)).sum()), (a, b)))
    chosen = [k for _, k in sorted(gains, reverse=True)[:pairs]]
    pair_tables = [np.zeros(sizes[a] * sizes[b]) for a, b in chosen]
    for _ in range(rounds // 4):
        for k, (a, b) in enumerate(chosen):
            p = 1 / (1 + np.exp(-total))
            at, n = joint(a, b), len(pair_tables[k])
            step = RATE * np.bincount(at, y - p, n) / (np.bincount(at, p * (1 - p), n) + 5.0)
            pair_tables[k] += step
            total += step[at]
    return Model(cuts, tables, pair_cuts, chosen, [t.reshape(sizes[a], sizes[b]) for t, (a, b) in zip(pair_tables, chosen)], bias)


def fold(key: Column | str = "doc_id", folds: int = FOLDS) -> Column:
    """crc32 of the id as text, modulo the folds; fold 0 is held out."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % folds


def train(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> Model:
    """Fits on labelled documents outside fold 0.

    Labels without an id or quality are left out; of labels or documents with the same id each counts. The labels taken are those
    with the smallest hash of their id, at most `most_rows`; where they meet more rows than that, as with an id that repeats, about as
    many of those by a hash of id, text and label. Only their features reach the driver.
    """
    rows = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold() != 0))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(most_rows)
    )
    schema = "quality int, x array<double>"

    def measure(batches):
        for batch in batches:
            for part in parts(batch):
                x = features(encode(part["text"].to_pylist()))
                yield pa.RecordBatch.from_arrays([part["quality"], pa.array(list(x), pa.list_(pa.float64()))], ["quality", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # at most most_rows small rows on this side
    met = texts.join(F.broadcast(rows), "doc_id").select("doc_id", "text", "quality")
    many = met.select("doc_id").count()
    if many > most_rows:  # an id that repeats: an even share of all that was met, by hash
        place = F.pmod(F.xxhash64(F.lit(5), "doc_id", "text", "quality"), F.lit(1 << 40))
        met = met.filter(place < int((1 << 40) * max(0.0, most_rows - 4 * most_rows**0.5) / many)).limit(most_rows)
    got = met.mapInArrow(measure, schema).toArrow()
    x = np.array(got["x"].to_pylist(), dtype=float).reshape(-1, len(FEATURES))
    y = got["quality"].to_numpy().astype(float)
    order = np.lexsort((*x.T, y))  # the same model whatever order the rows come in
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Every column of the documents and `name`, from 0 to 1, which takes the place of a column of that name. A null or empty
    text is scored as one with 0 in every feature."""
    if name in docs.columns:
        docs = docs.drop(name)
    schema = docs.select("*", F.lit(0.0).cast("double").alias(name)).schema

    def run(batches):
        for batch in batches:
            for part in parts(batch):
                s = model.score(features(encode(part["text"].to_pylist())))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(s, pa.float64())], [*part.schema.names, name])

    return docs.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every document row."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier accepts, with the columns they had."""
    name = unused_name("quality_score", docs.columns)
    return score(docs, train(docs, labels), name).filter(F.col(name) >= threshold).drop(name)
