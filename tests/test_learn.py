import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallyhouse.operators import learn, trees
from tallyhouse.operators.periods import training_periods
from tallyhouse.operators.trees import load_trees, save_trees
from tallyhouse.sources.models import load_model, save_model


@pytest.fixture(scope="module")
def rows(spark):
    """A label that follows one feature, over three snapshots."""
    base = spark.range(900).select(
        F.concat(F.lit("c"), F.col("id")).alias("Customer_ID"),
        F.add_months(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("snapshot_date"),
        (F.col("id") % 17).cast("double").alias("x"), (F.col("id") % 5).cast("double").alias("y"))
    return base.withColumn("label", (F.col("x") > 8).cast("int"))


KEY = ["Customer_ID", "snapshot_date"]


def test_split_is_stable_and_about_four_fifths(rows):
    split = learn.oot_split(rows, KEY)
    counts = {r["split"]: r["n"] for r in learn.split_stats(split).collect()}
    assert counts["oot"] == 300 and 0.74 < counts["train"] / (counts["train"] + counts["test"]) < 0.86
    again = learn.oot_split(rows.repartition(5), KEY)
    assert split.exceptAll(again).count() == 0


@pytest.mark.parametrize("ratio", [0, 0.5, 0.8, 1])
def test_split_is_stratified_and_exact(rows, ratio):
    split = learn.train_test_split(rows, KEY, ratio)
    assert split.count() == rows.count()
    for label in (0, 1):
        mine = split.where(f"label = {label}")
        assert mine.where("split = 'train'").count() == int(ratio * mine.count() + 0.5)
    near = learn.train_test_split(rows, KEY, ratio, label=None).where("split = 'train'").count() / 900
    assert near == ratio if ratio in (0, 1) else abs(near - ratio) < 0.06
    with pytest.raises(ValueError, match="ratio"):
        learn.train_test_split(rows, KEY, 1.2)


def test_parts_of_a_key_are_told_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "abc"), ("abc", None)], "x string, y string")
    assert df.select(learn.split_place(["x", "y"])).distinct().count() == 4


def test_periods(spark):
    at = training_periods(F.lit("2024-09-01").cast("date"))
    got = spark.range(1).select(*[e.cast("string").alias(n) for n, e in at.items()]).first().asDict()
    assert got == {
        "train_test_start_date": "2023-07-01", "train_test_end_date": "2024-06-30",
        "oot_start_date": "2024-07-01", "oot_end_date": "2024-08-31"}


def test_draws_are_distinct_and_repeatable():
    draws = learn.draw_params(learn.GRID_LARGE, 100)
    assert len(draws) == 100 == len({tuple(d.items()) for d in draws})
    assert draws == learn.draw_params(learn.GRID_LARGE, 100)
    assert len(learn.draw_params({"maxDepth": [2, 3]}, 100)) == 2


SMALL = {"n_estimators": [3, 6], "max_depth": [2, 3], "learning_rate": [0.1]}


def test_search_score_and_round_trip(spark, rows, tmp_path):
    model, record = learn.train_model(learn.oot_split(rows, KEY), ["x", "y"], KEY, grid=SMALL, draws=4, folds=2)
    made = record.first()
    assert made["auc_oot"] > 0.95 and made["gini_oot"] == pytest.approx(2 * made["auc_oot"] - 1, abs=1e-3)
    assert made["n_oot"] == 300 and made["model_version"] == "credit_model_2024_03_01"
    save_trees(spark, model, record, str(tmp_path / "bank"))
    loaded, read = load_trees(spark, str(tmp_path / "bank"))
    assert read.count() == 1 and loaded.inputs == model.inputs
    gaps = rows.withColumn("y", F.when(F.col("y") > 2, F.col("y")))
    scored = learn.score(gaps, loaded, "m")
    assert scored.count() == 900 and scored.where("model_predictions IS NULL").count() == 0
    assert scored.exceptAll(learn.score(gaps, model, "m")).count() == 0


def test_trees_of_a_pipeline(spark, rows, tmp_path):
    """Compiled trees, the pipeline itself and a walk in numpy agree on every row; saving changes nothing."""
    flipped = F.when(F.xxhash64("Customer_ID") % 8 == 0, 1 - F.col("label")).otherwise(F.col("label"))
    whole = rows.withColumns({"x": F.col("x").cast("int"), "label": flipped})
    model = learn.fit_boosted_trees(whole, ["x", "y"], maxIter=20, maxDepth=4)
    gaps = whole.withColumns({"x": F.when(F.col("x") != 9, F.col("x")), "y": F.when(F.col("y") > 2, F.col("y")).when(F.col("y") == 0, F.lit(float("nan")))})
    form = trees.of_pipeline(model, gaps)
    want = F.get(vector_to_array("probability"), F.lit(1)).alias("want")
    both = trees.with_probability(model.transform(gaps).select("x", "y", want), form, "got").toPandas()
    assert abs(both.want - both.got).max() < 1e-12 and both.want.nunique() > 5
    assert abs(form.walk(both[["x", "y"]].to_numpy(float)) - both.want).max() < 1e-12
    record = spark.range(1)
    save_model(model, record, str(tmp_path / "bank"))
    again = trees.of_pipeline(load_model(spark, str(tmp_path / "bank"))[0], gaps)
    assert learn.score(gaps, again, "m").exceptAll(learn.score(gaps, model, "m")).count() == 0
    areas = {r.split: r.auc for r in learn.split_auc(model, learn.oot_split(whole, KEY)).collect()}
    assert min(areas.values()) > 0.8


def test_fits_on_a_bounded_number_of_rows(spark, rows):
    assert learn.bounded_rows(rows, KEY, 900).count() == 900
    some = learn.bounded_rows(rows, KEY, 500)
    assert 300 < some.count() <= 500 and some.exceptAll(learn.bounded_rows(rows.repartition(7), KEY, 500)).count() == 0
    model = learn.fit_trees(rows, ["x", "y"], KEY, most_rows=500, n_estimators=5)
    assert len(model.trees) == 5
    with pytest.raises(ValueError, match="both labels"):
        learn.fit_trees(rows.where("label = 0"), ["x", "y"], KEY)
    with pytest.raises(ValueError, match="both labels"):
        learn.random_search(rows.limit(0), ["x", "y"], KEY, grid=SMALL)


def test_search_table_has_every_draw(spark, rows):
    noisy = rows.withColumn("label", F.when(F.col("y") == 4, 1 - F.col("label")).otherwise(F.col("label")))
    table = learn.search_table(noisy, ["x", "y"], KEY, grid=SMALL, draws=4, folds=2).collect()
    _, params, area = learn.random_search(noisy, ["x", "y"], KEY, grid=SMALL, draws=4, folds=2)
    best = max(table, key=lambda r: r.auc_cv)
    assert len(table) == 4 and best.auc_cv == area and best.n_estimators == params["n_estimators"]


def test_ceiling_of_a_month_is_that_of_a_search_up_to_it(spark, rows):
    noisy = rows.withColumn("label", F.when(F.xxhash64("Customer_ID") % 4 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    got = {str(r.snapshot_date): r for r in learn.performance_ceiling(noisy, ["x", "y"], KEY, grid=SMALL, draws=4, folds=2).collect()}
    assert list(got) == ["2024-01-01", "2024-02-01", "2024-03-01"] and got["2024-01-01"].auc_train is None
    for month in ("2024-02-01", "2024-03-01"):
        up_to = learn.oot_split(noisy.where(F.col("snapshot_date") <= month), KEY)
        record = learn.train_model(up_to, ["x", "y"], KEY, grid=SMALL, draws=4, folds=2)[1].first()
        for part in learn.PARTS:
            assert got[month][f"auc_{part}"] == pytest.approx(record[f"auc_{part}"], abs=1e-9)


def test_months_that_are_missing_are_not_made(spark, rows):
    gap = rows.where("snapshot_date <> '2024-02-01'")
    days = {str(r.as_of) for r in learn.rows_as_of(gap, KEY).collect()}
    assert days == {"2024-01-01", "2024-03-01"}
