"""Boosted trees of rows that a task can hold, many fits side by side. Of more rows they are grown by ``spread``.

A search fits hundreds of models of the same few rows. The rows, all there are, are sent to the tasks once; Spark
deals the fits over the cluster, each task grows the trees of its fits on binned features, and only figures and nodes come back.
Fits share what they can: features are binned once per training part, and as the trees of a short fit are the first trees
of a longer one, candidates that differ in their number of trees only are one fit that is judged at several stages.

A tree is grown by levels from histograms of gradient and curvature of the logistic loss. A split gains
T(GL)^2 / (HL + l2) + T(GR)^2 / (HR + l2) - T(G)^2 / (H + l2), where T moves a sum towards 0 by l1, and a leaf is -T(G) / (H + l2).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

from tallyhouse.operators.trees import Input, Model, Tree

BINS = 64  # bins of a feature
# What a parameter is where it is not given.
DEFAULTS = {
    "n_estimators": 100, "max_depth": 5, "learning_rate": 0.1, "subsample": 1.0, "colsample_bytree": 1.0,
    "gamma": 0.0, "min_child_weight": 1, "reg_alpha": 0.0, "reg_lambda": 1.0,
}


class Sample(NamedTuple):
    """Rows that models are fitted on."""

    x: np.ndarray  # a row a sample row, a column a feature; NaN: missing
    label: np.ndarray
    fold: np.ndarray  # -1: not for training, only to be judged


class Fit(NamedTuple):
    part: int  # which sample
    fold: int  # the fold held out; -1: none, and the trees come back
    params: dict
    stages: tuple[int, ...]  # numbers of trees at which the held-out rows are judged


def area(label: np.ndarray, score: np.ndarray) -> float:
    """Area under the ROC curve, ties by half; NaN for one class."""
    pos = int(label.sum())
    neg = len(label) - pos
    if not pos or not neg:
        return float("nan")
    _, at, n = np.unique(score, return_inverse=True, return_counts=True)
    rank = np.cumsum(n) - (n - 1) / 2
    return float((rank[at][label > 0].sum() - pos * (pos + 1) / 2) / (pos * neg))


def edges_of(x: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Values of a feature that cut it into about equally filled bins; a value up to the k-th edge is in bin k or below."""
    return np.unique(np.quantile(x, np.arange(1, bins) / bins, method="lower")) if len(x) else np.zeros(0)


class Binned(NamedTuple):
    missing: np.ndarray  # median of each feature
    edges: list[np.ndarray]
    bins: np.ndarray


def bin_features(x: np.ndarray, train: np.ndarray) -> Binned:
    """Bins fitted on the rows `train`, for all rows. A missing value takes the median of those rows."""
    missing = np.zeros(x.shape[1])
    for j in range(x.shape[1]):
        known = x[train, j][~np.isnan(x[train, j])]
        missing[j] = np.quantile(known, 0.5, method="lower") if len(known) else 0.0
    filled = np.where(np.isnan(x), missing, x)
    edges = [edges_of(filled[train, j]) for j in range(x.shape[1])]
    bins = [np.searchsorted(e, filled[:, j], "left") for j, e in enumerate(edges)]
    return Binned(missing, edges, np.column_stack(bins).astype(np.int64) if bins else np.zeros(x.shape, np.int64))


def _towards_zero(g: np.ndarray, by: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - by, 0) if by else g


def _grow(bins: np.ndarray, g: np.ndarray, h: np.ndarray, used: np.ndarray, cols: np.ndarray, p: Mapping) -> tuple[Tree, np.ndarray]:
    """One tree from the rows `used` and the features `cols`, its thresholds as bins; and the value of every row's leaf."""
    l1, l2, wide = p["reg_alpha"], p["reg_lambda"], len(cols)
    feature, cut, left, right, value = ([-1], [0], [-1], [-1], [0.0])
    at, level = np.zeros(len(bins), np.int64), [0]
    part = bins[:, cols]
    for depth in range(p["max_depth"] + 1):
        slot = np.full(len(feature), -1)
        slot[level] = np.arange(len(level))
        used = used[slot[at[used]] >= 0]
        s, n = slot[at[used]], len(level)
        total_g, total_h = np.bincount(s, g[used], n), np.bincount(s, h[used], n)
        for k, node in enumerate(level):
            value[node] = float(-_towards_zero(total_g[k : k + 1], l1)[0] / (total_h[k] + l2)) if total_h[k] + l2 else 0.0
        if depth == p["max_depth"] or not wide:
            break
        place = ((s[:, None] * wide + np.arange(wide)) * BINS + part[used]).ravel()
        below_g = np.bincount(place, np.repeat(g[used], wide), n * wide * BINS).reshape(n, wide, BINS).cumsum(2)[:, :, :-1]
        below_h = np.bincount(place, np.repeat(h[used], wide), n * wide * BINS).reshape(n, wide, BINS).cumsum(2)[:, :, :-1]
        count = np.bincount(place, minlength=n * wide * BINS).reshape(n, wide, BINS).cumsum(2)[:, :, :-1]
        above_g, above_h = total_g[:, None, None] - below_g, total_h[:, None, None] - below_h
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = _towards_zero(below_g, l1) ** 2 / (below_h + l2) + _towards_zero(above_g, l1) ** 2 / (above_h + l2)
            gain -= (_towards_zero(total_g, l1) ** 2 / (total_h + l2))[:, None, None]
        open_to = (below_h >= p["min_child_weight"]) & (above_h >= p["min_child_weight"]) & (count > 0) & (count < np.bincount(s, minlength=n)[:, None, None])
        gain = np.where(open_to & np.isfinite(gain), gain, -np.inf).reshape(n, -1)
        best = gain.argmax(1)
        children = []
        for k, node in enumerate(level):
            if gain[k, best[k]] > max(p["gamma"], 1e-12):
                feature[node], cut[node] = int(cols[best[k] // (BINS - 1)]), int(best[k] % (BINS - 1))
                left[node], right[node] = len(feature), len(feature) + 1
                children += [left[node], right[node]]
                for column, start in ((feature, -1), (cut, 0), (left, -1), (right, -1), (value, 0.0)):
                    column.extend([start, start])
        if not children:
            break
        f, c, lo, hi = (np.array(v)[at] for v in (feature, cut, left, right))
        go = bins[np.arange(len(bins)), np.maximum(f, 0)] > c
        at = np.where(f >= 0, np.where(go, hi, lo), at)
        level = children
    tree = Tree(np.array(feature), np.array(cut, float), np.array(left), np.array(right), np.array(value) * p["learning_rate"])
    return tree, tree.value[at]


def boost(binned: Binned, label: np.ndarray, train: np.ndarray, params: Mapping, seed: int) -> Iterator[tuple[Tree, np.ndarray]]:
    """Tree after tree, with the margins of all rows after it. Which rows and features a tree sees hangs on its number and the
    seed alone, so that a longer fit goes on where a shorter one ends."""
    p = DEFAULTS | dict(params)
    rows = np.flatnonzero(train)
    share = float(label[rows].mean())
    margin = np.full(len(label), float(np.log(share / (1 - share))))
    for number in range(p["n_estimators"]):
        draw = np.random.default_rng([seed, number])
        probability = 1 / (1 + np.exp(-margin))
        g, h = probability - label, probability * (1 - probability)
        used = np.sort(draw.permutation(rows)[: max(1, round(p["subsample"] * len(rows)))])
        wide = binned.bins.shape[1]
        cols = np.sort(draw.permutation(wide)[: max(1, round(p["colsample_bytree"] * wide))])
        tree, step = _grow(binned.bins, g, h, used, cols, p)
        margin = margin + step
        yield tree, margin


def _with_edges(tree: Tree, edges: Sequence[np.ndarray]) -> Tree:
    """The tree with values of the features as thresholds."""
    at = [edges[f][int(c)] if f >= 0 else 0.0 for f, c in zip(tree.feature, tree.threshold)]
    return tree._replace(threshold=np.array(at, float))


def fit_one(sample: Sample, fit: Fit, features: Sequence[str], binned: Binned | None, seed: int) -> tuple[list[float], Model | None]:
    """Areas of the held-out rows at each stage, or the model if no fold is held out. A training part without both labels
    has neither."""
    train = (sample.fold >= 0) & (sample.fold != fit.fold)
    if not train.any() or sample.label[train].min() == sample.label[train].max():
        return [float("nan")] * len(fit.stages), None
    binned = binned or bin_features(sample.x, train)
    held = sample.fold == fit.fold
    areas, kept = dict.fromkeys(fit.stages, float("nan")), []
    for k, (tree, margin) in enumerate(boost(binned, sample.label, train, fit.params, seed), 1):
        if fit.fold < 0:
            kept.append(_with_edges(tree, binned.edges))
        elif k in areas:
            areas[k] = area(sample.label[held], margin[held])
    if fit.fold >= 0:
        return [areas[k] for k in fit.stages], None
    share = float(sample.label[train].mean())
    inputs = [Input(n, float(m)) for n, m in zip(features, binned.missing)]
    return [], Model(inputs, float(np.log(share / (1 - share))), kept)


_NODES = pa.list_(pa.struct([(n, pa.int32()) for n in ("tree", "feature", "left", "right")] + [(n, pa.float64()) for n in ("threshold", "value")]))
_SCHEMA = pa.schema([("fit", pa.int64()), ("areas", pa.list_(pa.float64())), ("base", pa.float64()), ("missing", pa.list_(pa.float64())), ("nodes", _NODES)])
_OUT = (
    "fit long, areas array<double>, base double, missing array<double>, "
    "nodes array<struct<tree: int, feature: int, left: int, right: int, threshold: double, value: double>>")


def _nodes(model: Model) -> list[dict]:
    return [
        {"tree": k, **{n: int(getattr(t, n)[i]) for n in ("feature", "left", "right")}, **{n: float(getattr(t, n)[i]) for n in ("threshold", "value")}}
        for k, t in enumerate(model.trees) for i in range(len(t.feature))]


def run_fits(
    spark: SparkSession, samples: Sequence[Sample], fits: Sequence[Fit], features: Sequence[str], seed: int = 0,
) -> tuple[list[list[float]], list[Model | None]]:
    """All fits, dealt over the cluster; per fit its areas and its model. `samples` are bounded by the caller.

    What comes back is bounded by the fits' parameters. A lost task is run again and gives the same trees.
    """
    if not fits:
        return [], []
    shared = spark.sparkContext.broadcast((list(samples), list(fits)))
    features = list(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, jobs = shared.value
        at: tuple = ()
        binned = None
        for batch in batches:
            for k in batch["id"].to_pylist():
                fit = jobs[k]
                sample = rows[fit.part]
                if at != (fit.part, fit.fold):  # binned once for all fits of a training part that a task has
                    at, binned = (fit.part, fit.fold), bin_features(sample.x, (sample.fold >= 0) & (sample.fold != fit.fold))
                areas, model = fit_one(sample, fit, features, binned, seed)
                yield pa.RecordBatch.from_pylist([{
                    "fit": k, "areas": areas, "base": model and model.base, "missing": model and [i.missing for i in model.inputs],
                    "nodes": model and _nodes(model)}], schema=_SCHEMA)

    tasks = min(len(fits), 4 * spark.sparkContext.defaultParallelism)
    found = {r.fit: r for r in spark.range(0, len(fits), 1, tasks).mapInArrow(run, _OUT).collect()}
    models: list[Model | None] = []
    for k in range(len(fits)):
        if found[k].nodes is None:
            models.append(None)
            continue
        trees: dict[int, list] = {}
        for n in found[k].nodes:
            trees.setdefault(n.tree, []).append(n)
        grown = [Tree(*[np.array([n[c] for n in ns]) for c in ("feature", "threshold", "left", "right", "value")]) for ns in trees.values()]
        models.append(Model([Input(n, m) for n, m in zip(features, found[k].missing)], found[k].base, grown))
    return [found[k].areas for k in range(len(fits))], models
