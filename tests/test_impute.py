"""Fills and medians against plain Python."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import impute as im
from tallyhouse.operators.ranks import lower_medians

SCHEMA = "k string, t date, a int, s string"


def day(m):
    return dt.date(2024, 1 + m, 1)


def sample(seed=1, keys=12, hot=300):
    """Unique (key, snapshot) rows with gaps; one key holds a third of all rows once copies are added."""
    rng = random.Random(seed)
    pick = lambda: rng.choice([None, None, rng.randint(0, 99)])
    return [(f"k{i}", day(m), pick(), rng.choice([None, "x", "y"])) for i in range(keys) for m in range(12)
            if rng.random() < 0.9] + [(None, day(m), pick(), None) for m in range(3)]


def brute(rows, kind):
    out = []
    for k, t, a, s in rows:
        past = [(u, b) for q, u, b, _ in rows if q == k and u <= t and b is not None]
        ahead = [(u, b) for q, u, b, _ in rows if q == k and u >= t and b is not None]
        every = [(u, b) for q, u, b, _ in rows if q == k and b is not None]
        fwd = max(past)[1] if past else None
        bwd = min(ahead)[1] if ahead else None
        newest = max(ahead)[1] if ahead else None
        value = {
            "forward": fwd, "backward": bwd, "both": fwd if fwd is not None else bwd, "latest": newest,
            "earliest": min(every)[1] if every else None}[kind]
        out.append((k, t, value if kind == "earliest" or a is None else a, s))
    return out


def key(r):
    return tuple((x is None, str(x)) for x in r)


@pytest.mark.parametrize("kind", ["forward", "backward", "both", "latest", "earliest"])
def test_fill_equals_brute_force(spark, kind):
    rows = sample()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = im.fill_history(df, {"a": kind}, ["k"], "t").collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute(rows, kind), key=key)


def test_copies_of_a_key_and_snapshot_take_a_peers_value(spark):
    rng = random.Random(3)
    rows = [("hot", day(rng.randint(0, 3)), rng.choice([None, 1, 2, 3]), None) for _ in range(400)]
    rows += [(f"k{i}", day(i % 12), i, None) for i in range(800)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    for kind in ("forward", "both", "backward"):
        got = im.fill_history(df, {"a": kind}, ["k"], "t").collect()
        assert sorted(map(tuple, got), key=key) == sorted(brute(rows, kind), key=key)


def test_no_task_holds_the_rows_of_a_hot_key(spark):
    """A key with a third of all rows goes into the windows as one row per snapshot, and its join is split."""
    df = spark.range(300_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id) END AS k", "add_months(date'2024-01-01', cast(id % 6 as int)) AS t",
        "CASE WHEN id % 2 = 0 THEN id END AS a", "concat(sha2(cast(id AS string), 512), sha2(cast(-id AS string), 512)) AS s")
    history = im._history(df, {"a": "forward"}, ["k"], "t")
    assert history.where("known_k = 'hot'").count() <= 6
    kept = {n: spark.conf.get(n) for n in (
        "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        for name, value in zip(kept, ("256k", "256k", "1", "-1")):
            spark.conf.set(name, value)
        out = im.ffill(df, ["a"], ["k"], "t").withColumn("task", F.spark_partition_id())
        # the long column is asked for, so that it is shuffled
        sizes = [r["n"] for r in out.where("k = 'hot'").groupBy("task").agg(F.count(F.lit(1)).alias("n"), F.max("s")).collect()]
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 100_000 and len(sizes) > 6 and max(sizes) < 50_000


def test_forward_fill_is_idempotent(spark):
    once = im.ffill(spark.createDataFrame(sample(), SCHEMA), ["a", "s"], ["k"], "t")
    twice = im.ffill(once, ["a", "s"], ["k"], "t")
    assert once.exceptAll(twice).count() == 0


def test_unknown_fill_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown fill"):
        im.fill_history(spark.createDataFrame(sample(), SCHEMA), {"a": "sideways"}, ["k"], "t")


def test_latest_name_looks_no_further_back(spark):
    rows = [("c", day(0), None, "a"), ("c", day(1), None, None), ("c", day(2), None, "b"), ("c", day(3), None, None)]
    got = im.fill_latest(spark.createDataFrame(rows, SCHEMA), "s", ["k"], "t").orderBy("t").collect()
    assert [r["s"] for r in got] == ["a", "b", "b", "Unknown"]


def test_latest_per_key(spark):
    rows = sample()
    got = {r["k"]: r["t"] for r in im.latest_per_key(spark.createDataFrame(rows, SCHEMA), ["k"], "t").collect()}
    assert got == {k: max(t for q, t, *_ in rows if q == k) for k in {r[0] for r in rows}}


@pytest.mark.parametrize("exact", [True, False])
def test_medians(spark, exact):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), rng.choice([None, rng.randint(0, 50), 7]), rng.random()) for _ in range(501)]
    df = spark.createDataFrame(rows, "g string, i int, x double").repartition(4)

    def low_median(values):
        known = sorted(v for v in values if v is not None)
        return known[(len(known) + 1) // 2 - 1]

    f = im.medians if exact else im.approximate_medians
    for r in f(df, ["i", "x"], ["g"]).collect():
        mine = [q for q in rows if q[0] == r["g"]]
        assert r["median_i"] == low_median(q[1] for q in mine) and r["median_x"] == low_median(q[2] for q in mine)
    filled = im.fill_median(df, ["i"])
    assert filled.schema["i"].dataType.simpleString() == "int"
    assert filled.where("i IS NULL").count() == 0
    counts = im.null_counts(df).first()
    assert counts["i"] == sum(r[1] is None for r in rows) and counts["x"] == 0


def test_medians_are_exact_with_many_distinct_values(spark):
    """More distinct values than a sketch of 10,000 entries keeps, in groups of odd and even size."""
    n = 60_001
    df = spark.range(2 * n + 1).selectExpr("id % 2 AS g", "CAST(pmod(id * 7919, 1000003) AS DOUBLE) / 7 AS x")
    values = {0: [], 1: []}
    for i in range(2 * n + 1):
        values[i % 2].append((i * 7919 % 1000003) / 7)
    want = {g: sorted(v)[(len(v) + 1) // 2 - 1] for g, v in values.items()}
    assert {r["g"]: r["median_x"] for r in im.medians(df, ["x"], ["g"]).collect()} == want
    assert {r["g"]: r["median_x"] for r in im.approximate_medians(df, ["x"], ["g"]).collect()} != want


@pytest.mark.parametrize("few, inner, targets", [(1 << 22, 1 << 22, 200_000), (5, 4, 200_000), (1, 2, 0)])
def test_selection_equals_sorting_at_any_depth(spark, few, inner, targets):
    """Rounds of counting that narrow to a few rows, with bounds sent to the tasks or joined, in odd groups of odd values."""
    rng = random.Random(9)
    inf = float("inf")
    odd = [0.0, -0.0, inf, -inf, 5e-324, -1e308, 1e308, float("nan"), None]
    rows = [(rng.choice(["a", "b", None]), rng.choice([rng.gauss(0, 1), rng.gauss(0, 1e-9) + 1, rng.choice(odd)]), rng.choice([None, rng.randint(-10**12, 10**12)])) for _ in range(900)]
    rows += [("one", 3.5, None), ("none", None, None)]
    df = spark.createDataFrame(rows, "g string, x double, n long").repartition(5)
    found = lower_medians(df, ["x", "n"], ["g"], few, inner, targets)
    order = lambda v: (v != v, v)
    want = {}
    for g in {r[0] for r in rows}:
        for i, name in ((1, "x"), (2, "n")):
            known = sorted((float(r[i]) for r in rows if r[0] == g and r[i] is not None), key=order)
            if known:
                want[g, name] = known[(len(known) + 1) // 2 - 1]
    got = {(r.g, r.feature): r.value for r in found.values.collect()}
    assert got == want and found.targets == len(want)
    assert lower_medians(df.limit(0), ["x"], ["g"]).values.collect() == []


def test_a_hot_group_leaves_the_tasks_as_cells(spark):
    """Rows of one group are counted where they are: what is shuffled is bounded by the cells."""
    df = spark.range(200_000).selectExpr("1 AS g", "CAST(id % 500 AS double) AS x").repartition(8)
    assert [tuple(r) for r in im.medians(df, ["x"], ["g"]).collect()] == [(1, 249.0)]
    filled = im.fill_median(df.withColumn("x", F.when(F.col("x") != 7, F.col("x"))), ["x"], ["g"])
    assert "SortMergeJoin" not in filled._jdf.queryExecution().executedPlan().toString()


def test_fill_from_the_state_equals_the_full_fill(spark):
    rows = [r for r in sample(4, 30) if r[0] is not None] + [(None, day(1), 5, None), (None, day(11), None, "z")]
    df = spark.createDataFrame(rows, SCHEMA)
    full = im.ffill(df, ["a", "s"], ["k"], "t").collect()
    state, got = None, []
    for m in range(12):
        month = df.where(F.col("t") == F.lit(day(m)))
        got += (im.ffill(month, ["a", "s"], ["k"], "t") if state is None else im.ffill_from(state, month, ["a", "s"], ["k"], "t")).collect()
        state = spark.createDataFrame(im.last_known(month, ["a", "s"], ["k"], "t", state).collect(), "k string, a struct<at: date, value: int>, s struct<at: date, value: string>")
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, full), key=key)
    newest = {r.k: r.a and r.a.value for r in state.collect()}
    assert newest == {k: max(((u, b) for q, u, b, _ in rows if q == k and b is not None), default=(0, None))[1] for k in {r[0] for r in rows}}
