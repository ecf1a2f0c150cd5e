"""Fitted trees as data: compiled to column expressions, walked in numpy, kept as a table of nodes.

A compiled model is a sum of nested CASE expressions, which Spark evaluates like any other column: no vector is assembled, no
Python runs, and only the columns that some tree asks for are read. Models of this package and Spark's own boosted trees take
the same form.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

NODES = "tree int, node int, feature int, threshold double, left int, right int, value double"


class Tree(NamedTuple):
    """Nodes by number, the root first; a leaf has the feature -1. Values up to the threshold go left."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # what a leaf adds to the margin


class Input(NamedTuple):
    """A feature as the trees see it: what stands for a missing value, then (x - shift) * factor."""

    name: str
    missing: float
    shift: float = 0.0
    factor: float = 1.0


class Model(NamedTuple):
    inputs: list[Input]
    base: float  # margin before the first tree
    trees: list[Tree]
    link: float = 1.0  # the probability is 1 / (1 + exp(-link * margin))

    def walk(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of rows of raw features (NaN: missing), by following every tree from its root."""
        x = np.column_stack([(np.where(np.isnan(x[:, i]), f.missing, x[:, i]) - f.shift) * f.factor for i, f in enumerate(self.inputs)]) if self.inputs else x
        margin = np.full(len(x), self.base)
        every = np.arange(len(x))
        for t in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := t.feature[at] >= 0).any():
                go = x[every, np.maximum(t.feature[at], 0)] <= t.threshold[at]
                at = np.where(inner, np.where(go, t.left[at], t.right[at]), at)
            margin = margin + t.value[at]
        return 1 / (1 + np.exp(-self.link * margin))


def _literal(x: float) -> str:
    if not math.isfinite(x):
        raise ValueError(f"{x} cannot stand in a compiled model")
    return f"{x!r}D"


def _case(t: Tree, names: Sequence[str], node: int = 0) -> str:
    if t.feature[node] < 0:
        return _literal(float(t.value[node]))
    return (
        f"CASE WHEN {names[t.feature[node]]} <= {_literal(float(t.threshold[node]))} THEN {_case(t, names, int(t.left[node]))} "
        f"ELSE {_case(t, names, int(t.right[node]))} END")


def with_probability(df: DataFrame, model: Model, name: str = "probability") -> DataFrame:
    """Adds the probability of label 1. A feature that is null or NaN counts as the model's stand-in for it.

    The inputs are one projection, the trees the next, so that no input is worked out once a node. The base comes out of a
    higher-order function, which Spark does not fuse with what is around it: in a projection of its own the trees are compiled as
    many small methods, while one method for all of them would pass the JVM's limit of 64 KB.
    """
    used = sorted({int(f) for t in model.trees for f in t.feature if f >= 0})
    names = {i: f"_input_{i}" for i in used}
    taken = set(df.columns) & set(names.values())
    if taken:
        raise ValueError(f"columns {sorted(taken)} are in the way")
    made = {}
    for i in used:
        f = model.inputs[i]
        x = F.col(f"`{f.name}`").cast("double")
        x = F.when(x.isNull() | F.isnan(x), F.lit(f.missing)).otherwise(x)
        made[names[i]] = x if (f.shift, f.factor) == (0.0, 1.0) else (x - F.lit(f.shift)) * F.lit(f.factor)
    start = _literal(model.base)
    if used:
        start = f"get(transform(array({names[used[0]]}), x -> {start}), 0)"
    margin = " + ".join([start, *[_case(t, names) for t in model.trees]])
    shown = [F.col(f"`{c}`") for c in df.columns if c != name]
    out = df.withColumns(made).select(*shown, F.expr(margin).alias("_margin"))
    return out.withColumn(name, 1 / (1 + F.exp(F.lit(-model.link) * F.col("_margin")))).drop("_margin")


_LINE = re.compile(r"(If|Else) \(feature (\d+) (<=|>) ([^)]+)\)|Predict: (\S+)")


def _read_tree(text: str, weight: float) -> Tree:
    """A tree from Spark's printed form, whose numbers are printed in full."""
    feature, threshold, left, right, value = [], [], [], [], []
    lines = iter(_LINE.findall(text))

    def node() -> int:
        kind, at, sign, bound, leaf = next(lines)
        me = len(feature)
        feature.append(-1 if leaf else int(at))
        threshold.append(0.0 if leaf else float(bound))
        value.append(float(leaf) * weight if leaf else 0.0)
        left.append(-1)
        right.append(-1)
        if not leaf:
            if (kind, sign) != ("If", "<="):
                raise ValueError("a split that is not a threshold cannot be compiled")
            left[me] = node()
            next(lines)  # the matching Else
            right[me] = node()
        return me

    node()
    return Tree(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value))


def of_pipeline(model: PipelineModel, df: DataFrame) -> Model:
    """The model in Spark's pipeline of imputer, assembler, scaler and boosted trees; `df` tells the features' types."""
    imputer, _, scaler, boosted = model.stages
    stand_ins = imputer.surrogateDF.first()
    whole = {n for n, kind in df.dtypes if kind in ("tinyint", "smallint", "int", "bigint")}  # filled in their own type
    inputs = [
        Input(n, float(math.trunc(stand_ins[n]) if n in whole else stand_ins[n]), float(m), 1 / float(s) if s else 0.0)
        for n, m, s in zip(imputer.getInputCols(), scaler.mean, scaler.std)]
    return Model(inputs, 0.0, [_read_tree(t.toDebugString, w) for t, w in zip(boosted.trees, boosted.treeWeights)], 2.0)


def to_rows(model: Model) -> list[Row]:
    """The nodes of a model, a row each; their number is bounded by the model's parameters."""
    return [
        Row(k, n, int(t.feature[n]), float(t.threshold[n]), int(t.left[n]), int(t.right[n]), float(t.value[n]))
        for k, t in enumerate(model.trees) for n in range(len(t.feature))]


def save_trees(spark: SparkSession, model: Model, record: DataFrame, path: str) -> None:
    """A model as tables beside its record: its nodes, and one row with its inputs and base."""
    head = [Row(model.base, model.link, [tuple(i) for i in model.inputs])]
    schema = "base double, link double, inputs array<struct<name: string, missing: double, shift: double, factor: double>>"
    spark.createDataFrame(head, schema).write.mode("overwrite").parquet(f"{path}/head")
    spark.createDataFrame(to_rows(model), NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
    record.write.mode("overwrite").parquet(f"{path}/record")


def load_trees(spark: SparkSession, path: str) -> tuple[Model, DataFrame]:
    """The model and its record."""
    head = spark.read.parquet(f"{path}/head").first()
    nodes: dict[int, list[Row]] = {}
    for r in spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect():  # bounded by the model's parameters
        nodes.setdefault(r.tree, []).append(r)
    kept = [Tree(*[np.array([r[c] for r in rows]) for c in ("feature", "threshold", "left", "right", "value")]) for rows in nodes.values()]
    return Model([Input(*i) for i in head.inputs], head.base, kept, head.link), spark.read.parquet(f"{path}/record")
