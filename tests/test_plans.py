"""Shapes of physical plans: no Python in the data path, no shuffle that is not needed, filters at the scan."""

import re

import pytest

from tallyhouse.plans.catalog import entries
from tallyhouse.plans.catalog.base import Tables
from tallyhouse.plans.features import engagement, financials_silver
from tallyhouse.plans.loans import label_store
from tallyhouse.operators.drift import psi
from tallyhouse.operators.impute import complete_rows, ffill, latest_per_key
from tallyhouse.operators.joins import training_rows
from tallyhouse.plans.model import training_set


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    """The raw views as tables, as they would lie in the store."""
    root = tmp_path_factory.mktemp("raw")
    t = Tables(spark, sf)
    for name in ("loan_daily", "clickstream_raw", "attributes_raw", "financials_raw"):
        t(name).write.parquet(str(root / name))
    return lambda name: spark.read.parquet(str(root / name))


NO_PYTHON = [n for n in entries() if n.startswith(("f", "a", "m", "w", "i", "j", "g", "e", "t")) and n not in (
    "t11_predictions", "t3_wide_silver", "t4_wide_gold")]


@pytest.mark.parametrize("name", NO_PYTHON)
def test_no_python_in_the_plan(spark, sf, name):
    text = plan(entries()[name][0](Tables(spark, sf)))
    assert not re.search(r"PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas|CartesianProduct", text)


def test_label_store_has_no_shuffle_and_a_pushed_filter(stored):
    text = plan(label_store(stored("loan_daily")))
    assert "Exchange" not in text and "PushedFilters: [" in text and "installment_num" in text
    assert "paid_amt" not in text.split("ReadSchema")[1]


def test_silver_is_one_projection(stored):
    assert "Exchange" not in plan(financials_silver(stored("financials_raw")))


def test_engagement_is_one_shuffle_of_three_columns(stored):
    text = plan(engagement(stored("clickstream_raw")))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "ReadSchema: struct<Customer_ID:string,snapshot_date:date,fe_1:int>" in text


def test_fill_combines_before_it_shuffles_and_forces_no_broadcast(stored):
    df = stored("financials_raw")
    text = plan(ffill(df, ["Credit_Mix", "Type_of_Loan"], ["Customer_ID"], "snapshot_date"))
    assert "partial_max" in text and "Window [" in text
    # to the aggregate, to the window over histories, and the two sides of the join
    assert len(re.findall(r"Exchange hashpartitioning", text)) <= 4
    assert "GlobalLimit" not in text


def test_latest_row_is_an_aggregate(stored):
    text = plan(latest_per_key(stored("attributes_raw"), ["Customer_ID"], "snapshot_date"))
    assert "Window" not in text and "partial_max" in text


def test_training_set_looks_back_only_unless_asked(spark, sf):
    t = Tables(spark, sf)
    ahead = training_set(t("loan_labels"), t.engagement, t.risk, "2024-01-01", "2024-12-01", backward=True)
    back = training_set(t("loan_labels"), t.engagement, t.risk, "2024-01-01", "2024-12-01")
    assert back.count() <= ahead.count() and back.select("loan_id").exceptAll(ahead.select("loan_id")).count() == 0


def test_complete_rows_make_the_join_inner(stored):
    labels = stored("loan_daily").select("loan_id", "Customer_ID", "snapshot_date").distinct()
    rows = complete_rows(training_rows(labels, stored("clickstream_raw")))
    assert "Inner" in plan(rows) and "LeftOuter" not in plan(rows)


def test_scan_of_the_stability_index_is_shared(spark, sf):
    df = psi(Tables(spark, sf)("scores"), "model_predictions", ["model_name"])
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert final.count("FileScan") == 1
