"""Every registered query against its SQL in DuckDB, on whole tables."""

import pytest

import __spark_entry__ as contract
from tallyhouse.plans import catalog
from tests.compare import differences, duck
from tests.conftest import SF

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()
MODELS = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    assert differences(QUERIES[name](spark, sf), ORACLES[name], con) == []


def test_what_has_no_sql_are_figures_of_models():
    assert MODELS == [
        "l3_boosted_trees", "l4_random_search", "l4_search_draws", "l6_batch_score", "l6_batch_score_clicks",
        "l7_performance_ceiling", "t11_predictions"]


def test_scores_are_figures_and_tell_labels_apart(spark, sf):
    scores = {(r.Customer_ID, r.snapshot_date): r.model_predictions for r in QUERIES["l6_batch_score"](spark, sf).collect()}
    assert len(set(scores.values())) > 50 and all(0 < p < 1 for p in scores.values())
    record = QUERIES["l4_random_search"](spark, sf).first()
    assert record.auc_train > 0.7 and record.auc_cv > 0.6


def test_training_rows_without_look_ahead_exist(spark, sf):
    assert QUERIES["t10_training_set_no_look_ahead"](spark, sf).count() > 0


def test_entry(spark):
    assert contract.entry(spark).columns == ["mob", "n", "bad_rate"]
    assert contract.entry(spark).count() > 0
