"""Scans and sinks of the store: one dataset per table, partitioned by snapshot.

A scan of one snapshot or of a range reads only the partitions it names. A write replaces the snapshots
it brings and leaves the others alone, so any month can be rerun.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tallyhouse.functions.schema import SNAPSHOT
from tallyhouse.operators.joins import assert_unique, lagged
from tallyhouse.operators.periods import at_snapshot, in_period


def scan_csv(spark: SparkSession, path: str, schema: StructType, snapshot: str | None = None) -> DataFrame:
    """CSV with a header and a given schema (nothing is inferred); one snapshot or all of them."""
    rows = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return rows if snapshot is None else at_snapshot(rows, snapshot)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, for exchange with other tools."""
    df.write.mode("overwrite").option("header", True).csv(path)


def scan_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All snapshots of a table. With ``schema``, a table that was never written reads as empty."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as missing:
        if schema is not None and missing.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def scan_snapshot(spark: SparkSession, path: str, snapshot: str, schema: StructType | None = None) -> DataFrame:
    """One snapshot of a table."""
    return at_snapshot(scan_table(spark, path, schema), snapshot)


def scan_range(
    spark: SparkSession, path: str, low: str, high: str, schema: StructType | None = None,
) -> DataFrame:
    """The snapshots between two dates; months that are missing are simply not there."""
    return in_period(scan_table(spark, path, schema), low, high)


def lagged_scan(spark: SparkSession, path: str, as_of: str, months: int = 6) -> DataFrame:
    """The ``months`` snapshots before a date, tagged ``months_ago``."""
    return lagged(scan_table(spark, path), F.lit(as_of).cast("date"), months)


def write_snapshots(
    df: DataFrame, path: str, partition_by: Sequence[str] = (SNAPSHOT,), key: Sequence[str] = (), observed: Sequence[str] = (),
) -> DataFrame | None:
    """Write a table by snapshot, replacing the snapshots that ``df`` brings.

    Rows are rebalanced on the partition columns: small snapshots end in one file, a large one is split
    over as many tasks as its size asks for. With ``key``, a repeated key is an error.
    With ``observed``, the ``profile`` of those columns comes back, taken while the rows are written, without a job of its own.
    """
    if key:
        assert_unique(df, key)
    out = df.hint("rebalance", *[F.col(c) for c in partition_by])
    # after the exchange, in the tasks that write: each of those counts once, also where an earlier one is run again
    seen = Observation() if observed else None
    if seen is not None:
        out = out.observe(seen, *_profile_columns(observed))
    (
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path)
    )
    if seen is None:
        return None
    schema = df.limit(0).agg(*_profile_columns(observed)).schema
    return df.sparkSession.createDataFrame([tuple(seen.get[f.name] for f in schema)], schema)


def write_bucketed(df: DataFrame, name: str, by: Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Write a table bucketed and sorted by columns under a name of the catalog, and read it back.

    Tables with equal buckets of the same columns are joined on those, and grouped by them, without an exchange. It replaces
    the whole table: a table that is rerun by month is partitioned by snapshot instead (``write_snapshots``). Rows of one key
    fill one bucket, so ``by`` is a unique key, as customer and snapshot, and no part of it. Rows are dealt to their buckets
    before the write, so that a bucket is one file.
    """
    if buckets < 1:
        raise ValueError("a table needs a bucket at least")
    writer = df.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by)
    (writer if path is None else writer.option("path", path)).saveAsTable(name)
    return df.sparkSession.table(name)


def write_predictions(df: DataFrame, path: str) -> None:
    """Prediction store: by model and snapshot."""
    write_snapshots(df, path, ("model_name", SNAPSHOT))


def write_metrics(df: DataFrame, path: str) -> None:
    """Metric store: one row per model and snapshot."""
    write_snapshots(df, path, ("model_name", SNAPSHOT))


def _profile_columns(cols: Sequence[str]) -> list[Column]:
    ranges = [f(c).alias(f"{name}_{c}") for c in cols for name, f in (("min", F.min), ("max", F.max))]
    return [F.count(F.lit(1)).alias("n_rows"), *ranges]


def profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Row count and the range of some columns, in one pass on demand."""
    return df.agg(*_profile_columns(cols))


def is_empty(df: DataFrame) -> bool:
    """Whether there is no row; stops at the first one."""
    return df.isEmpty()


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame itself; raises when an input has no rows."""
    if is_empty(df):
        raise ValueError(f"no rows in {what}")
    return df


def constants(df: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Typed constant columns, such as a model name or a snapshot date."""
    return df.withColumns(values)
