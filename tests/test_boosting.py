"""Trees grown from histograms, against plain sums over rows."""

import numpy as np
import pytest

from tallyhouse.operators.boosting import DEFAULTS, Fit, Sample, area, bin_features, boost, edges_of, fit_one, run_fits
from tallyhouse.operators.trees import Input, Model, Tree, with_probability


def data(n=400, seed=1):
    r = np.random.default_rng(seed)
    x = np.column_stack([r.integers(0, 9, n), r.normal(size=n).round(2), r.integers(0, 2, n)]).astype(float)
    label = (x[:, 0] + 2 * x[:, 1] + r.normal(size=n) > 4).astype(int)
    return Sample(x, label, r.integers(0, 3, n))


def test_area_counts_pairs():
    r = np.random.default_rng(0)
    label, score = r.integers(0, 2, 60), r.integers(0, 8, 60) / 8
    pairs = [(a > b) + 0.5 * (a == b) for a in score[label == 1] for b in score[label == 0]]
    assert area(label, score) == pytest.approx(np.mean(pairs), abs=1e-12)
    assert np.isnan(area(np.ones(3, int), np.ones(3))) and np.isnan(area(np.zeros(0, int), np.zeros(0)))


def test_bins_keep_the_order_of_values():
    x = data().x[:, 1]
    edges = edges_of(x)
    place = np.searchsorted(edges, x, "left")
    assert len(edges) <= 63 and all((x <= e).tolist() == (place <= k).tolist() for k, e in enumerate(edges))
    assert len(edges_of(np.zeros(0))) == 0 and edges_of(np.full(5, 2.0)).tolist() == [2.0]


@pytest.mark.parametrize("extra", [{}, {"reg_alpha": 1.0, "reg_lambda": 3.0}, {"min_child_weight": 12}, {"gamma": 9.0}])
def test_first_split_is_the_best_of_all(extra):
    s = data()
    p = DEFAULTS | {"n_estimators": 1, "max_depth": 1} | extra
    train = np.ones(len(s.label), bool)
    tree, margin = next(iter(boost(bin_features(s.x, train), s.label, train, p, 7)))
    share = s.label.mean()
    g, h = share - s.label, np.full(len(s.label), share * (1 - share))
    soft = lambda v: np.sign(v) * max(abs(v) - p["reg_alpha"], 0)
    score = lambda m: soft(g[m].sum()) ** 2 / (h[m].sum() + p["reg_lambda"])
    best = (max(p["gamma"], 1e-12), None)
    for j in range(3):
        for e in edges_of(s.x[:, j]):
            low = s.x[:, j] <= e
            if low.any() and not low.all() and min(h[low].sum(), h[~low].sum()) >= p["min_child_weight"]:
                gain = score(low) + score(~low) - score(train)
                if gain > best[0] + 1e-9:
                    best = (gain, (j, e))
    if best[1] is None:
        assert tree.feature.tolist() == [-1]
        return
    low = s.x[:, best[1][0]] <= best[1][1]
    leaf = lambda m: -soft(g[m].sum()) / (h[m].sum() + p["reg_lambda"]) * p["learning_rate"]
    want = np.where(low, leaf(low), leaf(~low)) + np.log(share / (1 - share))
    assert np.allclose(margin, want)


def test_stages_of_one_fit_are_separate_fits():
    s = data()
    long = Fit(0, 1, {"n_estimators": 30, "max_depth": 3, "subsample": 0.6, "colsample_bytree": 0.6}, (5, 12, 30))
    got, _ = fit_one(s, long, "abc", None, 3)
    for stage, found in zip(long.stages, got):
        alone = Fit(0, 1, long.params | {"n_estimators": stage}, (stage,))
        assert fit_one(s, alone, "abc", None, 3)[0] == [found]
    assert got[-1] > 0.85


def test_fits_on_the_cluster_are_those_of_one_process(spark):
    samples = [data(), data(300, 2), Sample(np.zeros((4, 3)), np.zeros(4, int), np.zeros(4, int))]
    p = {"n_estimators": 8, "max_depth": 4}
    fits = [Fit(k, f, p, (4, 8) if f >= 0 else ()) for k in range(3) for f in (0, 1, 2, -1)]
    areas, models = run_fits(spark, samples, fits, ["a", "b", "c"], 5)
    for fit, found, model in zip(fits, areas, models):
        want, alone = fit_one(samples[fit.part], fit, ["a", "b", "c"], None, 5)
        assert np.array_equal(found, want, equal_nan=True) and (model is None) == (alone is None)
        if model:
            assert np.array_equal(model.walk(samples[0].x), alone.walk(samples[0].x))
    assert models[-1] is None and all(np.isnan(a) for a in areas[8])
    assert run_fits(spark, [], [], []) == ([], [])


def test_missing_values_take_the_median_and_compiled_trees_walk_alike(spark):
    s = data()
    x = s.x.copy()
    x[::7, 0] = np.nan
    x[::5, 1] = np.nan
    sample = Sample(x, s.label, s.fold)
    model = fit_one(sample, Fit(0, -1, {"n_estimators": 40, "max_depth": 7}, ()), ["a", "b", "c"], None, 1)[1]
    assert [i.missing for i in model.inputs] == [np.quantile(v[~np.isnan(v)], 0.5, method="lower") for v in x.T]
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], 1) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double, probability int")
    got = {r.id: r.probability for r in with_probability(df, model).collect()}
    assert np.abs(np.array([got[i] for i in range(len(x))]) - model.walk(x)).max() < 1e-12


def test_a_model_without_splits_and_names_in_the_way(spark):
    leaf = Tree(np.array([-1]), np.array([0.0]), np.array([-1]), np.array([-1]), np.array([0.5]))
    model = Model([Input("a", 0.0)], -0.5, [leaf])
    df = spark.createDataFrame([(1.0,)], "a double")
    assert with_probability(df, model).first().probability == 0.5 and model.walk(np.zeros((2, 1))).tolist() == [0.5, 0.5]
    split = Tree(np.array([0, -1, -1]), np.zeros(3), np.array([1, -1, -1]), np.array([2, -1, -1]), np.array([0.0, 1.0, 2.0]))
    with pytest.raises(ValueError, match="in the way"):
        with_probability(df.withColumnRenamed("a", "_input_0"), model._replace(trees=[split]))
    with pytest.raises(ValueError, match="compiled"):
        with_probability(df, model._replace(base=float("inf")))
