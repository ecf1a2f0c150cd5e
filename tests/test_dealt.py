"""What is made of a small file is not small: how rows are dealt to tasks, read back and joined."""

import glob
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyhouse.plans.catalog import entries
from tallyhouse.plans.catalog.base import Tables
from tallyhouse.session import INITIAL_PARTITIONS, cut_lineage, dealt, shuffle_parts, tune
from tallyhouse.sources.views import view

CUSTOMERS = 300_000


@pytest.fixture(scope="module")
def many(sf, tmp_path_factory):
    """The tables with many customers in one row group of a small file."""
    home = tmp_path_factory.mktemp("many")
    for n in os.listdir(sf):
        os.symlink(f"{sf}/{n}", home / n)
    given = pq.read_table(f"{sf}/customer.parquet")
    rows = given.take(np.arange(CUSTOMERS) % len(given))
    rows = rows.set_column(0, "c_custkey", pa.array(np.arange(CUSTOMERS), pa.int64()))
    os.unlink(home / "customer.parquet")
    pq.write_table(rows, home / "customer.parquet")
    assert os.path.getsize(home / "customer.parquet") < 10 << 20 and pq.ParquetFile(home / "customer.parquet").num_row_groups == 1
    return str(home)


def test_labels_of_a_small_file_are_not_broadcast(spark, many):
    """8 MB of customers were sent through the driver as 604 MB of labels."""
    tune(spark)
    plan = entries()["j4_training_rows"][0](Tables(spark, many))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_rows_as_of_reads_its_rows_once(spark, sf):
    """the rows are staged, so that their joins are not planned and run again for each of the reads."""
    plan = entries()["l7_rows_as_of"][0](Tables(tune(spark), sf))._jdf.queryExecution().optimizedPlan().toString()
    assert "c_custkey" not in plan and "user_id" not in plan


def test_rows_made_of_a_row_group_are_dealt_out(spark, many):
    """F3 to F19: one task made all rows of a row group and held them in its aggregate and its sorts."""
    rows = view(tune(spark), many, "financials_raw").select("Customer_ID", "snapshot_date")
    sizes = [r["n"] for r in rows.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 6 * CUSTOMERS and len(sizes) >= 12 and max(sizes) < 200_000


@pytest.mark.parametrize("name", ["w1_forward_fill", "t10_training_set"])
def test_shuffles_of_dealt_rows_start_with_as_many_partitions(spark, many, name):
    """F13 to F19: with the session's few shuffle partitions what a task holds grew with the input."""
    spark = tune(spark.newSession())
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    plan = entries()[name][0](Tables(spark, many))._jdf.queryExecution().executedPlan().toString()
    parts = [int(n) for n in re.findall(r"hashpartitioning\(.*, (\d+)\)", plan)]
    assert parts and min(parts) >= CUSTOMERS // 25_000


def test_shuffle_partitions_are_only_raised(spark):
    spark = spark.newSession()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    seen = []
    for parts in (0, 3, 20, 9):
        shuffle_parts(spark, parts)
        seen.append(spark.conf.get(INITIAL_PARTITIONS, None))
    assert seen == [None, None, "20", "20"]


def test_a_file_of_staged_rows_is_bounded(spark):
    """F3 to F19: a scan packs files by their bytes, so rows that compress well all came back to one task."""
    staged = cut_lineage(spark.range(0, 300_000, 1, 1).selectExpr("id", "1 AS x"), "few-bytes")
    files = glob.glob(staged._staged_at.removeprefix("file:") + "/*.parquet")
    assert max(pq.ParquetFile(f).metadata.num_rows for f in files) <= 65_536 and staged.count() == 300_000


def test_a_small_table_is_left_as_it_is(spark):
    few = spark.range(25_000)
    assert dealt(few, ["id"]) is few
    odd = spark.range(60_001).selectExpr("id AS `a b`", "CASE WHEN id % 3 > 0 THEN id END AS k")
    out = dealt(odd, ["a b"])
    assert out.rdd.getNumPartitions() == 3 and out.exceptAll(odd).count() == 0 == odd.exceptAll(out).count()
