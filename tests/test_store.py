import datetime as dt

import pytest

from tallyhouse.functions.schema import KEY, LOAN_TYPES, struct_of
from tallyhouse.operators.joins import assert_unique
from tallyhouse.operators.periods import month_spine
from tallyhouse.sources import tables as store
from tallyhouse.sources.views import view


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store") / "loan_daily")
    store.write_snapshots(view(spark, sf, "loan_daily"), path, key=("loan_id", "installment_num"))
    return path


def test_rerun_changes_nothing(spark, sf, stored):
    before = store.scan_table(spark, stored).count()
    store.write_snapshots(store.at_snapshot(view(spark, sf, "loan_daily"), "1998-03-01"), stored)
    assert store.scan_table(spark, stored).count() == before == view(spark, sf, "loan_daily").count()


def test_snapshot_scan_prunes_partitions(spark, stored):
    plan = store.scan_snapshot(spark, stored, "1998-03-01").select("loan_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "ReadSchema: struct<loan_id:string>" in plan


def test_small_snapshots_are_one_file(stored):
    import glob
    assert len(glob.glob(f"{stored}/snapshot_date=1998-03-01/*.parquet")) == 1


def test_missing_table_is_empty_only_with_a_schema(spark, tmp_path):
    path = str(tmp_path / "nothing")
    assert store.is_empty(store.scan_range(spark, path, "2024-01-01", "2024-02-01", struct_of(LOAN_TYPES)))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        store.scan_table(spark, path)
    with pytest.raises(ValueError, match="no rows in labels"):
        store.require_rows(spark.range(0), "labels")


def test_repeated_key_is_an_error(spark):
    df = spark.createDataFrame([("c", 1), ("c", 1)], "Customer_ID string, snapshot_date int")
    with pytest.raises(ValueError, match="repeats"):
        assert_unique(df)


def test_csv_reads_by_schema(spark, sf, tmp_path):
    path = str(tmp_path / "csv")
    store.write_csv(view(spark, sf, "loan_daily"), path)
    rows = store.scan_csv(spark, path, struct_of(LOAN_TYPES), "1998-03-01")
    assert rows.schema == struct_of(LOAN_TYPES)
    assert {r[0] for r in rows.select("snapshot_date").distinct().collect()} == {dt.date(1998, 3, 1)}


def test_month_spine_floors_the_start(spark):
    got = [r[0] for r in month_spine(spark, "2023-11-15", "2024-02-01").collect()]
    assert got == [dt.date(2023, 11, 1), dt.date(2023, 12, 1), dt.date(2024, 1, 1), dt.date(2024, 2, 1)]


def test_profile(spark):
    row = store.profile(spark.range(5), ["id"]).first()
    assert (row["n_rows"], row["min_id"], row["max_id"]) == (5, 0, 4)


def test_profile_is_taken_while_writing(spark, sf, tmp_path):
    rows = view(spark, sf, "loan_daily")
    cols = ["snapshot_date", "installment_num", "due_amt"]
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "")
    seen = store.write_snapshots(rows, str(tmp_path / "t"), observed=cols)
    first = len(jobs.getJobIdsForGroup("observed"))
    spark.sparkContext.setJobGroup("plain", "")
    store.write_snapshots(rows, str(tmp_path / "u"))
    assert first == len(jobs.getJobIdsForGroup("plain"))
    assert seen.schema == store.profile(rows, cols).schema and seen.collect() == store.profile(rows, cols).collect()
    empty = store.write_snapshots(rows.limit(0), str(tmp_path / "v"), observed=cols)
    assert empty.collect() == store.profile(rows.limit(0), cols).collect()


def test_buckets_are_joined_without_an_exchange(spark, sf, tmp_path):
    labels = store.write_bucketed(view(spark, sf, "loan_labels"), "labels_by_customer", KEY, 4, str(tmp_path / "l"))
    fin = store.write_bucketed(view(spark, sf, "financials_raw"), "financials_by_customer", KEY, 4, str(tmp_path / "f"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = labels.join(fin, ["Customer_ID", "snapshot_date"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        newest = fin.groupBy(*KEY).agg({"Monthly_Balance": "max"})
        grouped = newest._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Exchange" not in grouped
    assert joined.count() == view(spark, sf, "loan_labels").join(view(spark, sf, "financials_raw"), ["Customer_ID", "snapshot_date"]).count()
    import glob
    assert len(glob.glob(str(tmp_path / "l" / "*.parquet"))) <= 4
    spark.sql("DROP TABLE labels_by_customer")
    spark.sql("DROP TABLE financials_by_customer")
    with pytest.raises(ValueError, match="bucket"):
        store.write_bucketed(labels, "none", KEY, 0)


def test_a_month_of_engagement_reads_the_six_before_it(spark, sf, tmp_path):
    from pyspark.sql import functions as F

    from tallyhouse.operators.joins import lagged_pivot

    months = spark.range(20).selectExpr("explode(array('a', 'b')) AS Customer_ID", "add_months(date'2024-01-01', cast(id AS int)) AS snapshot_date", "cast(id AS int) AS fe_1")
    store.write_snapshots(months, str(tmp_path / "clicks"))
    scan = store.scan_table(spark, str(tmp_path / "clicks"))
    one = lagged_pivot(scan, "fe_1", "click", 6, "2024-10-01", "2024-10-01")
    full = lagged_pivot(scan, "fe_1", "click", 6).where("snapshot_date = '2024-10-01'")
    assert one.exceptAll(full).count() == 0 == full.exceptAll(one).count()
    read = scan.where((F.col("snapshot_date") >= "2024-04-01") & (F.col("snapshot_date") < "2024-10-01"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "(snapshot_date" in plan.split("PartitionFilters: ")[1].split("]")[0] and ">= 2024-04-01" in plan and "< 2024-10-01" in plan
    assert read.select("snapshot_date").distinct().count() == 6
