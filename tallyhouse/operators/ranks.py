"""Exact order statistics without one task per group: quantiles, five numbers, AUC.

Rows are first counted per distinct value (with map-side combining, so copies of a value cost nothing).
Values are then placed in cells of two levels, running totals are taken over the cells and within them,
and added up. The cell of a value is a function of the value and of exact minima and maxima alone, so it is
the same in every branch of a plan and on every rerun. Cells have a bounded width relative to their values:
however many rows there are, a window holds a few million rows at most, and more values only fill more cells.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyhouse.session import cut_lineage

OCTAVE = 1_024     # first-level cells between a value and its double
INNER = 1 << 22    # second-level cells in one of those


def _group_key(by: Sequence[str]) -> Column:
    """One null-safe grouping column, also for no grouping at all."""
    return F.struct(*[F.col(b).alias(b) for b in by]) if by else F.struct(F.lit(0).alias("all"))


def _outer_cell(v: Column, octave: int) -> Column:
    """A whole number that never falls as ``v`` grows: sign and leading bits of the logarithm. NaN comes last, as in sorts."""
    far = F.lit(1 << 50)

    def place(x: Column) -> Column:
        return F.floor((F.log2(x) + 1_100) * octave).cast("long") + 1

    infinite = F.lit(float("inf"))
    return (
        F.when(F.isnan(v), far + 1).when(v == infinite, far).when(v == -infinite, -far)
        .when(v > 0, place(v)).when(v < 0, -place(-v)).otherwise(F.lit(0).cast("long")))


def running_totals(
    df: DataFrame, value: str, measures: dict[str, Column], by: Sequence[str] = (), octave: int = OCTAVE,
    inner: int = INNER,
) -> DataFrame:
    """Totals per distinct value, and over all smaller values of the same group.

    ``measures`` maps names to whole-number expressions that are summed. The result has ``by``, ``value``,
    per measure its total at the value, ``before_<name>`` over smaller values and ``all_<name>`` over
    the group.
    """
    counts = (
        df.groupBy(_group_key(by).alias("group"), F.col(value).alias("value"))
        .agg(*[F.sum(m.cast("long")).alias(n) for n, m in measures.items()])
    )
    number = F.col("value").cast("double")
    counts = counts.withColumn("outer", F.coalesce(_outer_cell(number, octave), F.lit(0)))  # never null, so no branch gets a filter

    def earlier(*keys: str, order: str):
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def total(n: str, window) -> Column:
        return F.coalesce(F.sum(n).over(window), F.lit(0))

    outer = counts.groupBy("group", "outer").agg(
        F.min(number).alias("low"), F.max(number).alias("high"), *[F.sum(n).alias(n) for n in measures])
    outer = outer.select(
        "group", "outer", "low", "high", *[total(n, earlier("group", order="outer")).alias(f"base_{n}") for n in measures],
        *[F.sum(n).over(Window.partitionBy("group")).alias(f"all_{n}") for n in measures])
    # Always true. It keeps the totals in every branch, which would otherwise prune them and read the rows anew.
    outer = outer.where(" AND ".join(f"`all_{n}` >= 0 AND `base_{n}` >= 0" for n in measures))
    share = (number - F.col("low")) / (F.col("high") - F.col("low"))
    placed = counts.join(outer, ["group", "outer"]).withColumn(
        "inner", F.when(F.col("low") == F.col("high"), 0).otherwise(F.floor(share * inner)).cast("int"))
    cells = placed.groupBy("group", "outer", "inner").agg(*[F.sum(n).alias(n) for n in measures]).select(
        "group", "outer", "inner", *[total(n, earlier("group", "outer", order="inner")).alias(f"inner_{n}") for n in measures])
    within = earlier("group", "outer", "inner", order="value")
    return placed.join(cells, ["group", "outer", "inner"]).select(
        *[F.col("group")[b].alias(b) for b in by], F.col("value").alias(value), *measures,
        *[(F.col(f"base_{n}") + F.col(f"inner_{n}") + total(n, within)).alias(f"before_{n}") for n in measures],
        *[f"all_{n}" for n in measures])


def quantiles(
    df: DataFrame, value: str, fractions: Sequence[float], by: Sequence[str] = (), name: str = "quantiles",
    weight: str | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation between neighbours, as one array per group. Skips nulls.

    ``weight`` names a count column when ``df`` holds counted values instead of single rows.
    """
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    ranked = running_totals(known, value, {"n": F.lit(1) if weight is None else F.col(weight)}, by)

    def value_at(rank: str) -> str:
        held = f"before_n <= {rank} AND {rank} < before_n + n"
        return f"max(CASE WHEN {held} THEN CAST(`{value}` AS DOUBLE) END)"

    picked, result = [], []
    for i, p in enumerate(fractions):
        place = f"({float(p)}D * (all_n - 1))"
        picked += [
            F.expr(f"{value_at(f'floor{place}')} AS low_{i}"), F.expr(f"{value_at(f'ceil{place}')} AS high_{i}"),
            F.expr(f"max({place} - floor{place}) AS part_{i}")]
        # measured from the nearer neighbour, which fixes the last digit
        result.append(
            f"CASE WHEN part_{i} < 0.5 THEN low_{i} + (high_{i} - low_{i}) * part_{i} "
            f"ELSE high_{i} - (high_{i} - low_{i}) * (1 - part_{i}) END")
    return ranked.groupBy(*by).agg(*picked).select(*by, F.expr(f"array({', '.join(result)})").alias(name))


def deciles(
    df: DataFrame, value: str, by: Sequence[str] = (), buckets: int = 10, weight: str | None = None,
) -> DataFrame:
    """Edges of ``buckets`` equally filled buckets, as the array ``edges``."""
    return quantiles(df, value, [i / buckets for i in range(buckets + 1)], by, "edges", weight)


def unpivot(df: DataFrame, cols: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per kept row and column: ``feature`` and its ``value`` as double."""
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(keep), list(cols), "feature", "value")


FEW = 1 << 22  # rows around a rank that are ordered by their distinct values
MOST_TARGETS = 200_000  # groups times columns whose bounds are sent to every task; more are joined by a shuffle


class Ranked(NamedTuple):
    values: DataFrame  # by, ``feature`` and ``value``
    targets: int  # rows of that


def lower_medians(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), few: int = FEW, inner: int = INNER, most_targets: int = MOST_TARGETS,
) -> Ranked:
    """The lower median of each column per group, exactly, by selection: rows are counted, never ordered.

    The first pass counts the rows of all columns by the leading bits of their values, combined map-side; what leaves a task
    is cells, not rows. Only the cell that holds the rank is looked into, again by counting, until it has one value or ``few``
    rows at most, whose distinct values are ordered. Mostly that takes one pass more, and none where a cell is one value, as
    with small whole numbers. The passes run as this is called; stage ``df`` if it is costly. Null is no value, NaN the largest.
    """
    group = _group_key(by)
    value = F.col("value")
    long = unpivot(df, cols, by).where(value.isNotNull()).select(group.alias("group"), "feature", "value")
    cells = long.groupBy("group", "feature", _outer_cell(value, OCTAVE).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    here = Window.partitionBy("group", "feature")
    below = F.coalesce(F.sum("n").over(here.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rank = F.ceil(F.sum("n").over(here) / 2)
    held = cut_lineage(cells, "median-cells").withColumns({"below": below, "rank": rank}).where(
        (F.col("below") < F.col("rank")) & (F.col("rank") <= F.col("below") + F.col("n"))).select(
        "group", "feature", "low", "high", "n", (F.col("rank") - F.col("below")).alias("rank"))
    target = cut_lineage(held, "median-targets")
    is_open = F.col("low") < F.col("high")

    def found(name: str, targets: DataFrame) -> DataFrame:
        return targets.select(*[F.col("group")[b].alias(b) for b in by], "feature", F.col(name).alias("value"))

    size = target.agg(F.count(F.lit(1)).alias("all"), F.count_if(is_open).alias("open"), F.max(F.when(is_open, F.col("n"))).alias("n")).first()
    known, left, most = found("low", target.where(~is_open)), size["open"], size["n"]
    while left:
        bounds = target.where(is_open).drop("n")
        bounds = F.broadcast(bounds) if left <= most_targets else bounds
        near = long.join(bounds, ["group", "feature"]).where(value.between(F.col("low"), F.col("high")))
        last = most <= few
        share = (value - F.col("low")) / (F.col("high") - F.col("low"))
        at = value if last else F.floor(share * inner)
        counted = near.groupBy("group", "feature", "rank", at.alias("cell")).agg(
            F.count(F.lit(1)).alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        picked = counted.withColumn("below", below).where(
            (F.col("below") < F.col("rank")) & (F.col("rank") <= F.col("below") + F.col("n"))).select(
            "group", "feature", "low", "high", "n", (F.col("rank") - F.col("below")).alias("rank"))
        if last:
            return Ranked(known.unionByName(found("low", picked)), size["all"])
        target = cut_lineage(picked, "median-targets")
        again = target.agg(F.count_if(is_open).alias("open"), F.max(F.when(is_open, F.col("n"))).alias("n")).first()
        known, left, most = known.unionByName(found("low", target.where(~is_open))), again["open"], again["n"]
    return Ranked(known, size["all"])


def five_numbers(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Minimum, quartiles and maximum of each column per group: the table behind a box plot."""
    names = ["minimum", "lower_quartile", "median", "upper_quartile", "maximum"]
    boxes = quantiles(unpivot(df, cols, by), "value", [0, 0.25, 0.5, 0.75, 1], [*by, "feature"], "box")
    return boxes.select(*by, "feature", *[F.get("box", F.lit(i)).alias(n) for i, n in enumerate(names)])


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve per group, ties by half, with the two class sizes.

    Pairs are counted in whole numbers, so the result does not hang on the order of addition. A group
    with one class only has a null area. Rows without label or score are left out.
    """
    known = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    ranked = running_totals(
        known, score, {"pos": F.col(label).cast("int"), "neg": 1 - F.col(label).cast("int")}, by)
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    # twice the number of (positive, negative) pairs in right order
    pairs = whole("pos") * (whole("before_neg") * 2 + whole("neg")).cast("decimal(18,0)")
    summed = ranked.groupBy(*by).agg(
        F.sum(pairs.cast("decimal(38,0)")).alias("pairs"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    all_pairs = F.col("positives").cast("double") * F.col("negatives") * 2
    return summed.select(
        *by, "positives", "negatives", F.try_divide(F.col("pairs").cast("double"), all_pairs).alias("auc"))


def gini(area: Column) -> Column:
    """Gini coefficient with three decimals."""
    return F.round(2 * area - 1, 3)
