"""Order statistics against numpy and brute force, with a value that holds a third of all rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.ranks import auc, deciles, five_numbers, gini, quantiles, running_totals


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    return [(rng.choice("ab"), rng.randint(0, 1), 0.25 if i % 3 == 0 else round(rng.random(), 3)) for i in range(1500)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "g string, label int, x double").repartition(6)


@pytest.mark.parametrize("octave, inner", [(1, 1), (1, 3), (2, 1 << 22), (1024, 1 << 22)])
def test_running_totals(df, rows, octave, inner):
    got = running_totals(df, "x", {"n": F.lit(1), "bad": F.col("label")}, ["g"], octave, inner).collect()
    assert len(got) == len({(g, x) for g, _, x in rows})
    for r in got:
        same = [q for q in rows if q[0] == r["g"]]
        assert r["n"] == sum(q[2] == r["x"] for q in same)
        assert r["before_n"] == sum(q[2] < r["x"] for q in same)
        assert r["before_bad"] == sum(q[1] for q in same if q[2] < r["x"])
        assert r["all_n"] == len(same) and r["all_bad"] == sum(q[1] for q in same)


def test_quantiles_equal_numpy(df, rows):
    wanted = [0, 0.1, 1 / 3, 0.5, 0.77, 1]
    for r in quantiles(df, "x", wanted, ["g"]).collect():
        assert r["quantiles"] == [float(np.quantile([q[2] for q in rows if q[0] == r["g"]], p)) for p in wanted]
    assert deciles(df, "x").first()["edges"] == [
        float(v) for v in np.percentile([q[2] for q in rows], np.linspace(0, 100, 11))]


def test_five_numbers(df, rows):
    for r in five_numbers(df, ["x"], ["label"]).collect():
        mine = [q[2] for q in rows if q[1] == r["label"]]
        assert [r["minimum"], r["lower_quartile"], r["median"], r["upper_quartile"], r["maximum"]] == [
            float(v) for v in np.percentile(mine, [0, 25, 50, 75, 100])]


def pairs(rows):
    pos, neg = [q[2] for q in rows if q[1]], [q[2] for q in rows if not q[1]]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc(df, rows):
    got = {r["g"]: r["auc"] for r in auc(df, "label", "x", ["g"]).collect()}
    for g in "ab":
        assert got[g] == pytest.approx(pairs([q for q in rows if q[0] == g]), abs=1e-12)
    turned = auc(df.withColumn("x", -F.col("x")), "label", "x").first()["auc"]
    assert turned == pytest.approx(1 - auc(df, "label", "x").first()["auc"], abs=1e-12)
    assert auc(df.where("label = 1"), "label", "x").first()["auc"] is None


def test_gini(spark):
    assert spark.range(1).select(gini(F.lit(0.7125))).first()[0] == pytest.approx(0.425)


def test_cells_follow_the_order_of_values(spark):
    """Signs, zeros, powers apart, neighbours, infinities and NaN: no cell is before that of a smaller value."""
    import math

    from tallyhouse.operators.ranks import _outer_cell

    near = [math.nextafter(x, s * math.inf) for x in (1.0, -2.0, 1e300, 0.1) for s in (1, -1)]
    values = sorted([0.0, 5e-324, -5e-324, 1e308, -1e308, math.inf, -math.inf, 3.0, -3.0, *near, *[1.1**k for k in range(-90, 90)]]) + [math.nan]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    cells = [r.c for r in got.orderBy("i").select(_outer_cell(F.col("v"), 1024).alias("c")).collect()]
    assert cells == sorted(cells) and len(set(cells)) > 150
    ranked = running_totals(got, "v", {"n": F.lit(1)}).orderBy("v").collect()
    assert [r.before_n for r in ranked] == list(range(len(values)))


def test_no_sketch_in_the_plan(df):
    text = running_totals(df, "x", {"n": F.lit(1)}, ["g"])._jdf.queryExecution().toString()
    assert "percentile" not in text and "Broadcast" not in text.split("Physical")[0]
