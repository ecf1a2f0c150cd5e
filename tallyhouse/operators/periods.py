"""Month spine, training periods and lagged dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyhouse.functions.schema import SNAPSHOT

TRAIN_MONTHS, OOT_MONTHS = 12, 2


def months_from(bounds: DataFrame, low: str, high: str) -> DataFrame:
    """First-of-month dates from the month of ``low`` up to ``high``, for each row of ``bounds``."""
    first = F.trunc(F.col(low), "month")
    return bounds.select(
        F.explode(F.sequence(first, F.col(high), F.expr("interval 1 month"))).alias(SNAPSHOT))


def month_spine(spark: SparkSession, low: str, high: str) -> DataFrame:
    """First-of-month dates between two dates, both ends included."""
    bounds = spark.range(1).select(F.lit(low).cast("date").alias("low"), F.lit(high).cast("date").alias("high"))
    return months_from(bounds, "low", "high")


def snapshot_spine(df: DataFrame) -> DataFrame:
    """Every month from the first to the last snapshot of a table, gaps included."""
    return months_from(df.agg(F.min(SNAPSHOT).alias("low"), F.max(SNAPSHOT).alias("high")), "low", "high")


def training_periods(
    train_date: Column, train_months: int = TRAIN_MONTHS, oot_months: int = OOT_MONTHS,
) -> dict[str, Column]:
    """Bounds of the train/test period and of the out-of-time period before a training date."""
    oot_start = F.add_months(train_date, -oot_months)
    return {
        "train_test_start_date": F.add_months(oot_start, -train_months),
        "train_test_end_date": F.date_sub(oot_start, 1),
        "oot_start_date": oot_start,
        "oot_end_date": F.date_sub(train_date, 1),
    }


def prev_snapshot(c: Column) -> Column:
    """The snapshot one calendar month earlier."""
    return F.add_months(c, -1)


def max_snapshot(df: DataFrame) -> DataFrame:
    """The latest snapshot of a table, one row."""
    return df.agg(F.max(SNAPSHOT).alias(SNAPSHOT))


def at_snapshot(df: DataFrame, day: str) -> DataFrame:
    return df.where(F.col(SNAPSHOT) == F.lit(day).cast("date"))


def in_period(df: DataFrame, low: str, high: str) -> DataFrame:
    return df.where(F.col(SNAPSHOT).between(F.lit(low).cast("date"), F.lit(high).cast("date")))


def at_mob(df: DataFrame, mob: int) -> DataFrame:
    return df.where(F.col("mob") == mob)


def matured(df: DataFrame, before: str, installment: int | None = None) -> DataFrame:
    """Loans that started before a date; optionally their rows at one instalment."""
    rows = df.where(F.col("loan_start_date") < F.lit(before).cast("date"))
    return rows if installment is None else rows.where(F.col("installment_num") == installment)
