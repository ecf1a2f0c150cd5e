"""Fits of all rows that stay in the tasks, against fits of the same rows in one process."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import boosting, learn, spread as spreads
from tallyhouse.operators.boosting import Fit, Sample, area, bin_features, fit_one
from tallyhouse.operators.spread import areas_of, bin_edges, run_spread, spread

KEY = ["id"]
FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def noisy():
    """Rows in which nearly every feature value of one column is its own, others are missing or come often."""
    r = np.random.default_rng(4)
    n = 1500
    x = np.column_stack([r.normal(size=n), r.integers(0, 9, n), r.normal(size=n).round(1)])
    label = (x[:, 0] + 0.2 * x[:, 1] + r.normal(size=n) > 1.5).astype(int)
    x[r.random(n) < 0.2, 1] = np.nan
    x[r.random(n) < 0.6, 2] = np.nan
    return x, label, r.integers(0, 3, n), r.integers(0, 2, n)


def staged(spark, noisy, tasks=5):
    rows = [(int(p), i * 977, int(y), int(f), [None if np.isnan(v) else float(v) for v in v]) for i, (v, y, f, p) in enumerate(zip(*noisy))]
    df = spark.createDataFrame(rows, "part int, place long, label int, fold int, x array<double>")
    return spread(df.repartition(tasks))


def samples(noisy):
    x, label, fold, part = noisy
    return [Sample(x[part == p], label[part == p], fold[part == p]) for p in (0, 1)]


def test_bins_are_those_of_the_same_rows_in_one_process(spark, noisy):
    missing, edges = bin_edges(staged(spark, noisy), 3, [-1, 0, 2])
    for p, s in enumerate(samples(noisy)):
        for i, f in enumerate((-1, 0, 2)):
            want = bin_features(s.x, s.fold != f)
            assert missing[p, i].tolist() == want.missing.tolist()
            assert [e.tolist() for e in edges[p, i]] == [e.tolist() for e in want.edges]


def test_fits_are_those_of_the_same_rows_in_one_process(spark, noisy, monkeypatch):
    """Every row counts: models, areas at each stage and parts are as if all rows were at hand. Gradients are rounded alike on both
    sides: of splits that part the same rows, rounding would else choose."""
    grow, scale = boosting._grow, 1 << 40
    monkeypatch.setattr(boosting, "_grow", lambda bins, g, h, *more: grow(bins, np.rint(g * scale) / scale, np.rint(h * scale) / scale, *more))
    small = {"n_estimators": 4, "max_depth": 4, "reg_alpha": 0.1, "gamma": 0.1}
    fits = [Fit(p, f, small | extra, (2, 4) if f >= 0 else ()) for p in (0, 1) for f in (1, -1) for extra in ({}, {"max_depth": 2, "n_estimators": 3, "min_child_weight": 5})]
    fits = [f._replace(stages=(2, 3)) if f.stages and f.params["n_estimators"] == 3 else f for f in fits]
    areas, models = run_spread(staged(spark, noisy), fits, FEATURES, 5)
    for fit, found, model in zip(fits, areas, models):
        s = samples(noisy)[fit.part]
        want, alone = fit_one(s, fit, FEATURES, None, 5)
        assert found == pytest.approx(want, abs=1e-5) and (model is None) == (alone is None)
        if model:
            assert [t.feature.tolist() for t in model.trees] == [t.feature.tolist() for t in alone.trees]
            assert np.abs(model.walk(s.x) - alone.walk(s.x)).max() < 1e-5


def test_trees_do_not_hang_on_the_cut_of_the_rows(spark, noisy):
    fits = [Fit(1, f, {"n_estimators": 3, "max_depth": 3, "subsample": 0.6, "colsample_bytree": 0.6}, (3,) if f >= 0 else ()) for f in (0, -1)]
    one, many = (run_spread(staged(spark, noisy, n), fits, FEATURES, 5) for n in (1, 7))
    assert one[0] == many[0] and np.array_equal(one[1][1].walk(noisy[0]), many[1][1].walk(noisy[0]))
    assert run_spread(staged(spark, noisy, 2), [Fit(0, 0, {}, (1,))._replace(params={"n_estimators": 1})], FEATURES, 5)[1] == [None]


def test_fits_take_turns_where_they_are_many(spark, noisy, monkeypatch):
    at = staged(spark, noisy)
    fits = [Fit(p, f, {"n_estimators": 2, "max_depth": 2}, (1, 2) if f >= 0 else ()) for p in (0, 1) for f in (0, 1, -1)]
    once = run_spread(at, fits, FEATURES)
    monkeypatch.setattr(spreads, "SIDE", 2)
    turns = run_spread(at, fits, FEATURES)
    assert all(a == pytest.approx(b, abs=1e-6) for a, b in zip(once[0], turns[0])) and [m is None for m in once[1]] == [m is None for m in turns[1]]
    for a, b in zip(once[1], turns[1]):
        assert a is None or np.abs(a.walk(noisy[0]) - b.walk(noisy[0])).max() < 1e-6


def test_a_part_of_one_label_has_no_model(spark, noisy):
    x, label, fold, part = noisy
    at = staged(spark, (x, np.where(part == 0, 1, label), fold, part))
    areas, models = run_spread(at, [Fit(0, 1, {"n_estimators": 1}, (1,)), Fit(0, -1, {"n_estimators": 1}, ())], FEATURES)
    assert np.isnan(areas[0][0]) and models == [None, None]


def test_area_of_spread_scores_counts_pairs(spark):
    from tallyhouse.operators.spread import Block

    r = np.random.default_rng(0)
    score, label = r.integers(-9, 9, 4000).astype(np.float32) / 8, r.integers(0, 2, 4000)
    score[:1000] = r.normal(size=1000)
    fold = r.integers(0, 2, 4000)
    cut = np.array_split(np.arange(4000), 3)
    state = spark.sparkContext.parallelize([Block(0, None, label[c], fold[c], [], {3: score[c], 5: -score[c]}) for c in cut], 3)
    got = areas_of(state, {3: 1, 5: 0}, 4)
    assert got == {3: area(label[fold == 1], score[fold == 1]), 5: area(label[fold == 0], -score[fold == 0])}


@pytest.fixture(scope="module")
def frame(spark, noisy):
    rows = [(i, *[None if np.isnan(v) else float(v) for v in v], int(y)) for i, (v, y) in enumerate(zip(noisy[0], noisy[1]))]
    return spark.createDataFrame(rows, "id int, a double, b double, c double, label int")


GRID = {"n_estimators": [2, 4], "max_depth": [2, 3], "learning_rate": [0.1]}


def test_l4_random_search_is_on_all_rows(spark, frame):
    """with more rows than `most_rows` the winner was chosen by a sample of them, and fitted on it."""
    model, params, cv = learn.random_search(frame, FEATURES, KEY, grid=GRID, draws=4, folds=2, most_rows=300)
    whole, same, cv_whole = learn.random_search(frame, FEATURES, KEY, grid=GRID, draws=4, folds=2)
    x = np.array([[np.nan if v is None else v for v in r] for r in frame.select(*FEATURES).collect()], float)
    assert params == same and cv == pytest.approx(cv_whole, abs=1e-5) and model.base == pytest.approx(whole.base)
    assert np.abs(model.walk(x) - whole.walk(x)).max() < 1e-5


def test_the_ceiling_of_each_month_is_on_all_its_rows(spark, frame):
    """It shares the rows of F1."""
    dated = frame.withColumn("snapshot_date", F.add_months(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")))
    few, whole = (learn.performance_ceiling(
        dated, FEATURES, [*KEY, "snapshot_date"], grid=GRID | {"max_depth": [2]}, draws=2, folds=2, most_rows=n).collect() for n in (300, 9000))
    assert [r.snapshot_date for r in few] == [r.snapshot_date for r in whole]
    for a, b in zip(few, whole):
        assert [a.auc_train is None, a.auc_oot is None] == [b.auc_train is None, b.auc_oot is None]
        assert a.auc_train is None or (a.auc_train, a.auc_test, a.auc_oot) == pytest.approx((b.auc_train, b.auc_test, b.auc_oot), abs=1e-5)


def test_l4_search_draws_are_on_all_rows(spark, frame):
    """every draw was judged on a sample."""
    few, whole = (learn.search_table(frame, FEATURES, KEY, grid=GRID, draws=4, folds=2, most_rows=n).collect() for n in (300, 5000))
    assert [r[:-1] for r in few] == [r[:-1] for r in whole]
    assert [r.auc_cv for r in few] == pytest.approx([r.auc_cv for r in whole], abs=1e-5)


def test_l4_search_record_is_of_a_model_of_all_rows(spark, frame):
    """the areas in the record were those of a model of a sample."""
    dated = frame.withColumn("snapshot_date", F.lit("2024-01-01").cast("date"))
    rows = learn.train_test_split(dated, KEY, 0.6)
    few, whole = (learn.train_model(rows, FEATURES, KEY, grid=GRID, draws=2, folds=2, most_rows=n)[1].first() for n in (300, 5000))
    for name in ("auc_cv", "auc_train", "auc_test"):
        assert few[name] == pytest.approx(whole[name], abs=1e-5)
    assert few.hp_params == whole.hp_params and (few.n_train, few.n_test) == (whole.n_train, whole.n_test)


def test_l6_batch_scores_are_of_a_model_of_all_rows(spark, frame):
    """the trees that score came from a sample."""
    dated = frame.select(F.col("id").cast("string").alias("Customer_ID"), F.lit("2024-01-01").cast("date").alias("snapshot_date"), *FEATURES)
    few, whole = (
        {r.Customer_ID: r.model_predictions for r in learn.score(dated, learn.fit_trees(frame, FEATURES, KEY, most_rows=n, n_estimators=3, max_depth=3), "m").collect()}
        for n in (300, 5000))
    assert len(few) == 1500 and few == pytest.approx(whole, abs=1e-5)


def test_t11_predictions_have_thresholds_of_all_rows(spark, frame):
    """thresholds and the share of bad labels came from a sample."""
    model, whole = (learn.fit_trees(frame, FEATURES, KEY, most_rows=n, n_estimators=3) for n in (300, 5000))
    for t, w in zip(model.trees, whole.trees):
        assert t.feature.tolist() == w.feature.tolist() and t.threshold.tolist() == w.threshold.tolist()
    assert 1 / (1 + np.exp(-model.base)) == pytest.approx(frame.agg(F.avg("label")).first()[0])
