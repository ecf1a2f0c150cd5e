import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import encode


@pytest.fixture(scope="module")
def df(spark):
    values = ["a"] * 3 + ["b c"] * 2 + ["d"] * 2 + [None]
    return spark.createDataFrame([(v, ["x-y", "not specified"] if v == "a" else ["z"]) for v in values], "v string, l array<string>")


def test_vocabulary_by_frequency_then_name(df):
    assert encode.vocabulary(df, "v") == ["a", "b c", "d"]
    assert encode.element_vocabulary(df, "l") == ["not specified", "x-y", "z"]


def test_too_many_categories_are_an_error(df):
    with pytest.raises(ValueError, match="more than 2"):
        encode.vocabulary(df, "v", most=2)


def test_each_flag_is_its_own_category(df):
    out = encode.encode_categories(df.withColumn("kept", F.col("v")), {"v": ["a", "b c", "d"]}, {"l": ["not specified", "x-y", "z"]})
    assert out.columns == ["kept", "v_b_c", "v_d", "x_y", "z"]
    for r in out.collect():
        assert (r["v_b_c"], r["v_d"]) == (int(r["kept"] == "b c"), int(r["kept"] == "d"))
        assert r["v_b_c"] + r["v_d"] <= 1 and r["x_y"] == int(r["kept"] == "a") and r["z"] == 1 - r["x_y"]


def test_string_index_has_no_bound_and_fits_on_other_rows(spark, df):
    got = {r["v"]: r["i"] for r in encode.index_strings(df, "v", "i").collect()}
    assert got == {"a": 0, "b c": 1, "d": 2, None: 3}
    fitted = encode.label_index(df.where("v <> 'd'"), "v")
    assert {r["v"]: r["i"] for r in encode.index_strings(df, "v", "i", fitted).collect()} == {"a": 0, "b c": 1, "d": 2, None: 2}
    many = spark.range(3000).selectExpr("concat('c', lpad(cast(id AS string), 4, '0')) AS v")
    many = many.unionAll(many.where("v < 'c0005'"))
    found = {r["v"]: r["i"] for r in encode.index_strings(many, "v", "i").collect()}
    assert found == {f"c{i:04d}": i for i in range(3000)}


def test_scale_uses_the_training_rows(spark):
    train = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "x double, same double")
    other = spark.createDataFrame([(4.0, 7.0)], "x double, same double")
    got = encode.scale(other, encode.scaler(train, ["x", "same"]), ["x", "same"]).first()
    assert got["x"] == pytest.approx((4 - 3) / np.std([1, 2, 6])) and got["same"] == 2.0


def test_no_task_ranks_all_categories_of_one_count(spark):
    """A million categories that occur once, and some that occur more often, in ranges of 50,000."""
    df = spark.range(1_000_000).selectExpr("concat('c', id) AS v").unionByName(spark.range(40).selectExpr("concat('c', id % 10) AS v"))
    index = encode.label_index(df, "v", cell_labels=50_000)
    rows = index.orderBy("label_index").collect()
    names = [r["v"] for r in rows]
    often = sorted(f"c{i}" for i in range(10))
    assert names[:10] == often and names[10:] == sorted(f"c{i}" for i in range(10, 1_000_000))
    assert [r["label_index"] for r in rows] == list(range(1_000_000))
    sizes = index.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert max(r["count"] for r in sizes) < 400_000


def test_vocabularies_of_several_columns_at_once(spark):
    df = spark.createDataFrame([("x", 1, ["b", "a"]), ("y", 1, None), ("y", None, ["b", None]), (None, 2, [])], "s string, n int, l array<string>")
    assert encode.vocabularies(df, ["s", "n"], ["l"]) == {"s": ["y", "x"], "n": ["1", "2"], "l": ["a", "b"]}
    assert encode.vocabularies(df, ["s"]) == {"s": encode.vocabulary(df, "s")} and encode.vocabularies(df, []) == {}
    with pytest.raises(ValueError, match="more than 1"):
        encode.vocabularies(df, ["s"], ["l"], most=1)
