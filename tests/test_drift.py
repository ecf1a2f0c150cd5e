"""Stability index and densities against the formulas in numpy."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.drift import (
    bad_rate_curve, bin_shares, density, drift_status, histogram, performance_status, psi,
)

JAN, FEB, MAR, MAY = (dt.date(2024, m, 1) for m in (1, 2, 3, 5))


def formula(expected, actual, buckets=10, floor=1e-6):
    edges = np.unique(np.percentile(expected, np.linspace(0, 100, buckets + 1)))
    at = lambda v: np.where(v == edges[0], 1, np.searchsorted(edges, v, side="left"))
    def share(v):
        bins = at(np.array(v))
        inside = bins[(bins >= 1) & (bins < len(edges))]
        counts = np.bincount(inside, minlength=len(edges))[1:]
        return np.maximum(counts / counts.sum(), floor)
    a, e = share(actual), share(expected)
    return float(((a - e) * np.log(a / e)).sum())


@pytest.fixture(scope="module")
def scores():
    rng = random.Random(2)
    draw = lambda shift, n: [round(min(1.0, max(0.0, rng.gauss(0.4 + shift, 0.2))), 2) for _ in range(n)]
    return {JAN: draw(0, 700), FEB: draw(0.1, 600), MAR: draw(-0.1, 500), MAY: draw(0, 300)}


@pytest.fixture(scope="module")
def df(spark, scores):
    return spark.createDataFrame([("m", d, v) for d, vs in scores.items() for v in vs], "model string, snapshot_date date, p double")


def test_psi(df, scores):
    got = {r["snapshot_date"]: r for r in psi(df, "p", ["model"]).collect()}
    assert got[FEB]["psi"] == pytest.approx(formula(scores[JAN], scores[FEB]), abs=1e-12)
    assert got[MAR]["psi"] == pytest.approx(formula(scores[FEB], scores[MAR]), abs=1e-12)
    assert [got[d]["psi_status"] for d in (JAN, FEB, MAR, MAY)] == [
        "no previous snapshot", "ok", "ok", "no previous snapshot"]
    assert got[MAY]["psi"] is None


def test_psi_of_a_month_with_itself_is_zero(df):
    january = df.where(F.col("snapshot_date") == JAN)
    twice = january.unionAll(january.withColumn("snapshot_date", F.lit(FEB)))
    assert {r["snapshot_date"]: r["psi"] for r in psi(twice, "p").collect()}[FEB] == 0


def test_psi_with_an_empty_bin_and_junk_is_finite(spark):
    rows = [(JAN, str(v)) for v in range(100)] + [(FEB, str(v)) for v in range(50)] + [(FEB, "n/a"), (FEB, "1000")]
    got = {r["snapshot_date"]: r["psi"] for r in psi(spark.createDataFrame(rows, "snapshot_date date, p string"), "p").collect()}
    assert got[FEB] == pytest.approx(formula(range(100), [*range(50), 1000]), abs=1e-12)


def test_few_distinct_values_have_no_index(spark):
    rows = [(d, float(i == 7)) for d in (JAN, FEB) for i in range(20)]
    df = spark.createDataFrame(rows, "snapshot_date date, p double")
    assert {r["snapshot_date"]: r["psi_status"] for r in psi(df, "p").collect()}[FEB] == "too few distinct values"
    assert bin_shares(df, "p").count() == 0


def test_shares_sum_to_one(df):
    for r in bin_shares(df, "p", ["model"]).groupBy("snapshot_date").agg(F.sum("actual"), F.sum("expected")).collect():
        assert r[1] == pytest.approx(1, abs=1e-4) and r[2] == pytest.approx(1, abs=1e-4)


def test_histogram_counts_every_row(df, scores):
    got = histogram(df, ["p"], ["snapshot_date"], 20).groupBy("snapshot_date").agg(F.sum("n")).collect()
    assert {r[0]: r[1] for r in got} == {d: len(v) for d, v in scores.items()}


def test_density_follows_the_kernel_of_all_rows(df, scores):
    got = [r for r in density(df, ["p"], ["snapshot_date"], points=50, bins=2000).collect() if r["snapshot_date"] == JAN]
    v = np.array(scores[JAN])
    h = v.std(ddof=1) * len(v) ** -0.2
    for r in got:
        exact = np.exp(-(((r["x"] - v) / h) ** 2) / 2).sum() / (len(v) * h * np.sqrt(2 * np.pi))
        assert r["density"] == pytest.approx(exact, abs=0.01)
    width = got[1]["x"] - got[0]["x"]
    assert sum(r["density"] for r in got) * abs(width) == pytest.approx(1, abs=0.02)


def test_statuses(spark):
    rows = spark.createDataFrame([(0, 0.3, 0.6), (1, 0.25, 0.65), (2, None, None)], "i int, psi double, auc double")
    got = rows.orderBy("i").select(drift_status(F.col("psi")), performance_status(F.col("auc"))).collect()
    assert [tuple(r) for r in got] == [
        ("major shift", "retraining needed"), ("within range", "performance ok"), (None, "labels not available")]


def test_bad_rate_curve(spark):
    rows = spark.createDataFrame([(1, 40), (1, 0), (2, None), (2, 30)], "mob int, dpd int")
    assert [tuple(r) for r in bad_rate_curve(rows, 30).collect()] == [(1, 2, 0.5), (2, 2, 0.5)]
