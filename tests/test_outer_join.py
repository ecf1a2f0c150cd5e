import datetime as dt

import pytest

from tallyhouse.operators.joins import outer_join

KEY = ["k", "t"]
DAY = dt.date(2024, 1, 1)


def frames(spark):
    a = spark.createDataFrame([("x", DAY, 1), ("y", DAY, None), (None, DAY, 3), (None, DAY, 4)], "k string, t date, a int")
    b = spark.createDataFrame([("x", DAY, "p"), ("z", DAY, "q"), (None, DAY, "r")], "k string, t date, b string")
    c = spark.createDataFrame([("x", DAY, [1.5]), ("w", None, [2.5])], "k string, t date, c array<double>")
    return [a, b, c]


def test_equals_chained_outer_joins_with_one_exchange(spark):
    a, b, c = frames(spark)
    got = outer_join([a, b, c], KEY)
    want = a.join(b, KEY, "outer").join(c, KEY, "outer")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert outer_join([a, b, c], KEY)._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert outer_join([a], KEY).count() == 4 and outer_join([a.limit(0), b.limit(0)], KEY).count() == 0


def test_a_repeated_key_is_an_error_and_no_task_holds_it(spark):
    """A hot key that repeats is one row a task when it is shuffled, and is reported."""
    a, b, _ = frames(spark)
    hot = spark.range(200_000).selectExpr("'x' AS k", "date'2024-01-01' AS t", "CAST(id AS int) AS a").repartition(8)
    with pytest.raises(Exception, match="repeats in a source: x, 2024-01-01"):
        outer_join([hot, b], KEY).collect()
    with pytest.raises(Exception, match="repeats"):
        outer_join([a.union(a), b], KEY).select("k").collect()
    with pytest.raises(ValueError, match="more than one source"):
        outer_join([a, a], KEY)
