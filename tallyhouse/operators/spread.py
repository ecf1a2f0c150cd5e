"""Boosted trees of all rows, however many: the rows stay in the tasks, and all fits grow side by side, level by level.

The trees are those of ``boosting``: features in bins of equally many training rows, splits by the same gain. There a fit is one
task's; here a task has some of the rows and goes through them for every fit. Per level it sends a histogram of gradient and
curvature per open node, whose size is bounded by the parameters; the histograms of a fit are added up in one task, and its best
splits come back. Between trees the tasks keep each row's margin, on disk.

Gradient and curvature are whole multiples of a power of two, small enough that no sum is ever rounded. So the trees hang neither
on how the rows are cut nor on the order in which tasks end, and a lost task is run again to the same figures.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, functions as F

from tallyhouse.operators.boosting import BINS, DEFAULTS, Fit, _towards_zero
from tallyhouse.operators.ranks import running_totals
from tallyhouse.operators.trees import Input, Model, Tree
from tallyhouse.session import cut_lineage, drop_staged

BLOCK = 1 << 15  # rows that a task handles at a time
TASK = 1 << 17  # most rows of a task
FEW = 1 << 13  # rows that are not worth a further task
SIDE = 512  # most fits side by side: what a task holds of their histograms, and the rows of their margins, is bounded by it
RANGE = 18  # bits of a score within a range of scores


class Spread(NamedTuple):
    """Rows that models are fitted on, as a staged table: ``part``, ``place``, ``label``, ``fold`` and ``x``."""

    rows: DataFrame
    parts: list  # the values of ``part``: a fit's number of its part is the place here
    counts: dict[tuple[int, int], list[int]]  # rows of label 0 and 1 by number of the part and fold

    def trained(self, fit: Fit) -> list[int]:
        """Training rows of a fit with label 0 and 1."""
        return [sum(n[k] for (p, f), n in self.counts.items() if p == fit.part and f != fit.fold) for k in (0, 1)]


def spread(rows: DataFrame) -> Spread:
    rows = cut_lineage(rows, "fit-rows")
    found = rows.groupBy("part", "fold", "label").count().collect()  # parts times folds
    parts = sorted({r["part"] for r in found})
    counts: dict[tuple[int, int], list[int]] = {}
    for r in found:
        counts.setdefault((parts.index(r["part"]), r["fold"]), [0, 0])[int(r["label"] > 0)] += r["count"]
    return Spread(rows, parts, counts)


def bin_edges(at: Spread, wide: int, folds: Sequence[int]) -> tuple[np.ndarray, dict[tuple[int, int], list[np.ndarray]]]:
    """What ``boosting.bin_features`` finds, for each part and each fold held out, by counting: the median of each feature, by part,
    held-out fold and feature; and by part and place of the fold the features' edges.
    """
    long = at.rows.select("part", "fold", F.posexplode("x").alias("feature", "value"))
    none = F.col("value").isNull() | F.isnan("value")
    train = {f"n{i}": (F.col("fold") != fold).cast("long") if fold >= 0 else F.lit(1) for i, fold in enumerate(folds)}
    totals = cut_lineage(running_totals(long.where(~none), "value", train, ["part", "feature"]), "bin-totals")
    by_fold = totals.select("part", "feature", "value", F.explode(F.array(*[F.struct(
        F.lit(i).alias("i"), F.col(n).alias("n"), F.col(f"before_{n}").alias("before"), F.col(f"all_{n}").alias("all"))
        for i, n in enumerate(train)])).alias("at")).select("part", "feature", "value", "at.*").where("n > 0")
    missing = np.zeros((len(at.parts), len(folds), wide))
    holes = np.zeros(missing.shape, int)
    number = {p: k for k, p in enumerate(at.parts)}
    for r in by_fold.where("before <= (all - 1) div 2 AND (all - 1) div 2 < before + n").collect():  # one row a part, fold and feature
        missing[number[r.part], r.i, r.feature] = r.value
    for r in long.where(none).groupBy("part", "feature").agg(*[F.sum(e).alias(n) for n, e in train.items()]).collect():
        holes[number[r.part], :, r.feature] = [r[n] for n in train]
    filled = at.rows.sparkSession.createDataFrame(
        [(p, j, i, float(missing[k, i, j]), int(holes[k, i, j])) for k, p in enumerate(at.parts) for i in range(len(folds)) for j in range(wide)],
        f"part {at.rows.schema['part'].dataType.simpleString()}, feature int, i int, middle double, holes long")
    # With what was missing at its place: ranks before a value, of it, and of all, the k-th edge being at rank (all - 1) * k / BINS.
    ranks = by_fold.join(F.broadcast(filled), ["part", "feature", "i"]).selectExpr(
        "part", "feature", "i", "value", "before + CASE WHEN value > middle THEN holes ELSE 0L END AS before",
        "n + CASE WHEN value = middle THEN holes ELSE 0L END AS n", "all + holes - 1 AS last")
    first = f"greatest(1L, (before * {BINS} + last - 1) div greatest(last, 1L))"  # the first edge that is not before the value
    picked = ranks.withColumn("k", F.expr(first)).where(f"k < {BINS} AND (last * k) div {BINS} < before + n")
    edges: dict[tuple[int, int], list[list[float]]] = {
        (k, i): [[] for _ in range(wide)] for k in range(len(at.parts)) for i in range(len(folds))}
    for r in picked.select("part", "i", "feature", "value").collect():  # fewer than BINS rows a part, fold and feature
        edges[number[r.part], r.i][r.feature].append(r.value)
    drop_staged(totals)
    return missing, {at_: [np.array(sorted(e) or [0.0]) for e in found] for at_, found in edges.items()}


class Block(NamedTuple):
    """Some rows of one part."""

    part: int
    place: np.ndarray
    label: np.ndarray
    fold: np.ndarray
    bins: list[np.ndarray]  # per fold held out, a row a feature
    margin: dict[int, np.ndarray]  # per fit, once it has trees


def _blocks(at: Spread, missing: np.ndarray, edges: dict, n_rows: int) -> RDD:
    spark, parts = at.rows.sparkSession, {p: k for k, p in enumerate(at.parts)}
    shared = spark.sparkContext.broadcast((missing, edges))

    def made(part: int, held: list[tuple]) -> pa.RecordBatch:
        missing, edges = shared.value
        place, label, fold, x = (np.concatenate(v) for v in zip(*held))
        bins = [
            np.stack([np.searchsorted(e, np.where(np.isnan(x[:, j]), missing[part, i, j], x[:, j]), "left") for j, e in enumerate(edges[part, i])]).astype(np.uint8)
            for i in range(missing.shape[1])]
        return pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(Block(part, place, label, fold, bins, {}))], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[tuple]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            part = np.array([parts[p] for p in batch["part"].to_pylist()])
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1).astype(float)
            columns = [batch["place"].to_numpy().astype(np.uint64), batch["label"].to_numpy().astype(np.uint8), batch["fold"].to_numpy().astype(np.int16), x]
            for k in np.unique(part).tolist():
                kept.setdefault(k, []).append(tuple(v[part == k] for v in columns))
                if sum(len(v[0]) for v in kept[k]) >= BLOCK:
                    yield made(k, kept.pop(k))
        for k, held in kept.items():
            yield made(k, held)

    tasks = max(-(-n_rows // TASK), min(spark.sparkContext.defaultParallelism, -(-n_rows // FEW)))
    table = at.rows.repartition(tasks).mapInArrow(run, "block binary")
    return table.rdd.map(lambda r: pickle.loads(r[0]))


def _drawn(place: np.ndarray, seed: int, number: int, share: float) -> np.ndarray:
    """Rows that a tree sees: about a share, by their hashed keys and the tree's number alone."""
    with np.errstate(over="ignore"):
        z = place + np.random.default_rng([seed, number]).integers(1 << 63, dtype=np.uint64)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) < np.uint64(round(share * (1 << 53)))


class Growing:
    """A tree as it grows: nodes by number, their sums, and which of them are open."""

    def __init__(self, params: dict, cols: np.ndarray):
        self.params, self.cols = params, cols
        self.feature, self.cut, self.left, self.right = [-1], [0], [-1], [-1]
        self.sums: list[tuple[float, float]] = [(0.0, 0.0)]
        self.open = [0]

    def shape(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(v) for v in (self.feature, self.cut, self.left, self.right))

    def split(self, found: list[tuple], level: int) -> None:
        """A level down, by the best split of every open node: its sums, feature (-1: none), cut, and sums to the left."""
        opened, self.open = self.open, []
        for node, (g, h, feature, cut, left_g, left_h) in zip(opened, found):
            self.sums[node] = (g, h)
            if feature < 0 or level >= self.params["max_depth"]:
                continue
            self.feature[node], self.cut[node] = feature, cut
            for side, sums in ((self.left, (left_g, left_h)), (self.right, (g - left_g, h - left_h))):
                side[node] = len(self.feature)
                for column, start in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1), (self.sums, sums)):
                    column.append(start)
                if sums[1] >= 2 * self.params["min_child_weight"] and level + 1 < self.params["max_depth"]:  # else no split is allowed
                    self.open.append(side[node])

    def values(self) -> np.ndarray:
        g, h = np.array(self.sums).T
        below = h + self.params["reg_lambda"]
        return np.divide(-_towards_zero(g, self.params["reg_alpha"]), below, out=np.zeros(len(g)), where=below != 0) * self.params["learning_rate"]


def _leaf(shape: tuple[np.ndarray, ...], bins: np.ndarray, levels: int) -> np.ndarray:
    """The node that each row is in."""
    feature, cut, left, right = shape
    n, inner, stay = bins.shape[1], feature >= 0, np.arange(len(feature))
    start, most = np.where(inner, feature, 0) * n, np.where(inner, cut, BINS).astype(np.uint8)
    child = np.stack([np.where(inner, left, stay), np.where(inner, right, stay)], 1).ravel()
    flat, every, at = bins.ravel(), np.arange(n), np.zeros(n, np.int64)
    for _ in range(levels):
        at = child.take(2 * at + (flat.take(start.take(at) + every) > most.take(at)))
    return at


def best_splits(hist: np.ndarray, params: dict, cols: np.ndarray) -> list[tuple]:
    """Per node its sums and its best split; `hist` has gradient and curvature by feature, node and bin."""
    g, h = hist.reshape(2, len(cols), -1, BINS).transpose(0, 2, 1, 3).cumsum(3)
    total_g, total_h = g[:, 0, -1], h[:, 0, -1]
    low_g, low_h = g[:, :, :-1], h[:, :, :-1]
    up_g, up_h = total_g[:, None, None] - low_g, total_h[:, None, None] - low_h
    l1, l2 = params["reg_alpha"], params["reg_lambda"]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _towards_zero(low_g, l1) ** 2 / (low_h + l2) + _towards_zero(up_g, l1) ** 2 / (up_h + l2)
        gain -= (_towards_zero(total_g, l1) ** 2 / (total_h + l2))[:, None, None]
    least = params["min_child_weight"]
    allowed = (low_h >= least) & (up_h >= least) & (low_h > 0) & (up_h > 0)
    gain = np.where(allowed & np.isfinite(gain), gain, -np.inf).reshape(len(gain), -1)
    out = []
    for k, best in enumerate(gain.argmax(1)):
        j, cut = divmod(int(best), BINS - 1)
        found = gain[k, best] > max(params["gamma"], 1e-12)
        out.append((float(total_g[k]), float(total_h[k]), int(cols[j]) if found else -1, cut, float(low_g[k, j, cut]), float(low_h[k, j, cut])))
    return out


def _counted(score: np.ndarray, pos: np.ndarray, neg: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of either label by distinct score."""
    value, at = np.unique(score, return_inverse=True)
    return value, np.bincount(at, pos, len(value)), np.bincount(at, neg, len(value))


def _ranges(score: np.ndarray, label: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """The counted scores by ranges, which are in order and hold a bounded number of scores each: those alike but for their last bits."""
    value, pos, neg = _counted(score + np.float32(0), label, 1 - label)  # no -0
    bits = value.view(np.uint32)
    place = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31)) >> np.uint32(RANGE)
    for mine in np.split(np.arange(len(value)), np.flatnonzero(np.diff(place)) + 1) if len(value) else ():
        yield int(place[mine[0]]), (value[mine], pos[mine], neg[mine])


def areas_of(state: RDD, judged: dict[int, int], tasks: int) -> dict[int, float]:
    """The area under the ROC curve of each fit's held-out rows, ties by half; NaN for one class. `judged`: the fits' folds."""
    size = 32 - RANGE

    def scores(blocks: Iterable[Block]) -> Iterator[tuple]:
        for b in blocks:
            for i in sorted(set(judged) & set(b.margin)):
                held = b.fold == judged[i]
                for place, counted in _ranges(b.margin[i][held], b.label[held].astype(float)):
                    yield (i << size) | place, counted

    def pairs(counted: tuple[np.ndarray, ...]) -> tuple[int, int, int]:
        _, pos, neg = counted
        twice = sum((pos * (2 * (np.cumsum(neg) - neg) + neg)).astype(np.int64).tolist())
        return int(pos.sum()), int(neg.sum()), twice

    merged = state.mapPartitions(scores).reduceByKey(lambda a, b: _counted(*(np.concatenate(v) for v in zip(a, b))), tasks)
    sums = {i: [0, 0, 0] for i in judged}
    for key, (pos, neg, twice) in sorted(merged.mapValues(pairs).collect()):  # three numbers a range
        s = sums[key >> size]
        s[2] += twice + 2 * pos * s[1]
        s[0], s[1] = s[0] + pos, s[1] + neg
    return {i: twice / (2 * pos * neg) if pos and neg else float("nan") for i, (pos, neg, twice) in sums.items()}


def run_spread(at: Spread, fits: Sequence[Fit], features: Sequence[str], seed: int = 0) -> tuple[list[list[float]], list[Model | None]]:
    """All fits on all rows: per fit its areas and its model, as ``boosting.run_fits``.

    What the driver holds is trees and figures. A tree sees the share of the rows and of the features that its number and the
    seed say, so that a longer fit goes on where a shorter one ends.
    """
    if len(fits) > SIDE:
        turns = [run_spread(at, fits[k : k + SIDE], features, seed) for k in range(0, len(fits), SIDE)]
        return [a for areas, _ in turns for a in areas], [m for _, models in turns for m in models]
    sc = at.rows.sparkSession.sparkContext
    params = [DEFAULTS | dict(f.params) for f in fits]
    trained = [at.trained(f) for f in fits]
    live = [i for i, n in enumerate(trained) if all(n)]  # a training part without both labels has neither areas nor a model
    areas: list[dict[int, float]] = [dict.fromkeys(f.stages, float("nan")) for f in fits]
    base = [float(np.log(pos / neg)) if neg and pos else 0.0 for neg, pos in trained]
    models: list[list[Tree]] = [[] for _ in fits]
    if not live:
        return [list(a.values()) for a in areas], [None for _ in fits]
    folds = sorted({fits[i].fold for i in live})
    held = [folds.index(f.fold) if f.fold in folds else -1 for f in fits]
    part, fold = [f.part for f in fits], [f.fold for f in fits]
    parts = {part[i] for i in live}
    if len(parts) < len(at.parts):
        at = at._replace(rows=at.rows.where(F.col("part").isin([at.parts[p] for p in sorted(parts)])))
    missing, edges = bin_edges(at, len(features), folds)
    n_rows = sum(sum(n) for (p, _), n in at.counts.items() if p in parts)
    scale = float(1 << (51 - n_rows.bit_length()))
    tasks = min(len(live), sc.defaultParallelism)

    def margins(b: Block, i: int) -> np.ndarray:
        return b.margin[i] if i in b.margin else np.full(len(b.label), base[i], np.float32)

    state = _blocks(at, missing, edges, n_rows).persist(StorageLevel.DISK_ONLY)
    before: list[RDD] = []  # what the state is made of; let go once it is there
    for number in range(max(params[i]["n_estimators"] for i in live)):
        growing = {}
        for i in live:
            if number < params[i]["n_estimators"]:
                cols = np.random.default_rng([seed, number]).permutation(len(features))
                growing[i] = Growing(params[i], np.sort(cols[: max(1, round(params[i]["colsample_bytree"] * len(features)))]))
        for level in range(max(1, *[params[i]["max_depth"] for i in growing])):
            asked = {i: (t.shape(), t.open, t.cols) for i, t in growing.items() if t.open}
            if not asked:
                break
            groups: dict[tuple, list[int]] = {}
            for i in asked:
                groups.setdefault((part[i], held[i], fold[i], params[i]["subsample"]), []).append(i)

            sent = sc.broadcast(asked)

            def histograms(blocks: Iterable[Block], asked=sent, groups=groups, number=number, level=level) -> Iterator[tuple]:
                found: dict[int, np.ndarray] = {}
                for b in blocks:
                    for (p, k, f, share), members in groups.items():
                        if p != b.part:
                            continue
                        used = b.fold != f
                        rows = np.flatnonzero(used & _drawn(b.place, seed, number, share) if share < 1 else used)
                        bins, label = b.bins[k].take(rows, 1), b.label[rows]
                        for i in members:
                            shape, nodes, cols = asked.value[i]
                            probability = 1 / (1 + np.exp(-margins(b, i)[rows].astype(float)))
                            g, h = np.rint((probability - label) * scale), np.rint(probability * (1 - probability) * scale)
                            place = np.full(len(shape[0]), -1)
                            place[nodes] = np.arange(len(nodes)) * BINS
                            slot, here = place.take(_leaf(shape, bins, level)), None
                            if (slot < 0).any():
                                here = np.flatnonzero(slot >= 0)
                                slot, g, h = slot.take(here), g.take(here), h.take(here)
                            size = len(nodes) * BINS
                            if i not in found:
                                found[i] = np.zeros((2, len(cols), size))
                            hist = found[i]
                            for c, j in enumerate(cols):
                                to = slot + (bins[j] if here is None else bins[j].take(here))
                                hist[0, c] += np.bincount(to, g, size)
                                hist[1, c] += np.bincount(to, h, size)
                yield from found.items()

            def best(item: tuple, asked=asked) -> tuple[int, list[tuple]]:
                i, hist = item
                return i, best_splits(hist / scale, params[i], asked[i][2])

            found = dict(state.mapPartitions(histograms).reduceByKey(np.add, tasks).map(best).collect())
            sent.destroy()
            for rdd in before:
                rdd.unpersist()
            before = []
            for i in asked:
                growing[i].split(found[i], level) if i in found else growing[i].open.clear()
        done, judged, on = {}, {}, set()
        for i, t in growing.items():
            feature, cut, left, right = shape = t.shape()
            value = t.values()
            done[i] = shape, value, params[i]["max_depth"]
            own = edges[part[i], held[i]]
            if fold[i] < 0:
                models[i].append(Tree(feature, np.array([own[f][c] if f >= 0 else 0.0 for f, c in zip(feature, cut)], float), left, right, value))
            if fold[i] >= 0 and number + 1 in areas[i]:
                judged[i] = fold[i]
            if number + 1 < params[i]["n_estimators"]:
                on.add(i)
        done = {i: t for i, t in done.items() if i in on or i in judged}
        if not done:
            break

        def advanced(blocks: Iterable[Block], done=sc.broadcast(done)) -> Iterator[Block]:
            for b in blocks:
                margin = {}
                for i, (shape, value, levels) in done.value.items():
                    if part[i] == b.part:
                        margin[i] = (margins(b, i) + value[_leaf(shape, b.bins[held[i]], levels)]).astype(np.float32)
                yield b._replace(margin=margin)

        before.append(state)
        state = state.mapPartitions(advanced).persist(StorageLevel.DISK_ONLY)
        if judged:
            for i, area in areas_of(state, judged, sc.defaultParallelism).items():
                areas[i][number + 1] = area
    for rdd in [*before, state]:
        rdd.unpersist()
    made = [
        Model([Input(n, float(m)) for n, m in zip(features, missing[part[i], held[i]])], base[i], models[i]) if i in live and fold[i] < 0 else None
        for i in range(len(fits))]
    return [list(a.values()) for a in areas], made
