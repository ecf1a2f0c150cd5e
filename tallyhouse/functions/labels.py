"""Days past due and the default label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions.schema import numeric_columns

DPD, MOB = 30, 6


def installments_missed(overdue: Column, due: Column) -> Column:
    """Whole instalments behind; 0 when nothing is due or an amount is missing."""
    ratio = F.try_divide(overdue.cast("double"), due.cast("double"))
    return F.coalesce(F.ceil(ratio).try_cast("int"), F.lit(0))


def first_missed_date(snapshot: Column, missed: Column) -> Column:
    """Month in which the first open instalment fell due; null when none is open."""
    return F.when(missed > 0, F.add_months(snapshot, -missed))


def days_past_due(snapshot: Column, first_missed: Column, overdue: Column) -> Column:
    """Days since the first missed date if an amount is overdue, else 0."""
    return F.when(overdue > 0, F.datediff(snapshot, first_missed)).otherwise(F.lit(0))


def default_flag(dpd: Column, days: int = DPD) -> Column:
    """1 from ``days`` past due on; unknown days count as 0."""
    return F.when(dpd >= days, 1).otherwise(0)


def with_days_past_due(loans: DataFrame) -> DataFrame:
    """Adds mob, installments_missed, first_missed_date and dpd; null numbers of the table become 0 first."""
    missed = installments_missed(F.col("overdue_amt"), F.col("due_amt"))
    return (
        loans.withColumns({"mob": F.col("installment_num").try_cast("int"), "installments_missed": missed})
        .na.fill(0, subset=numeric_columns(loans) + ["mob"])
        .withColumn("first_missed_date", first_missed_date(F.col("snapshot_date"), F.col("installments_missed")))
        .withColumn("dpd", days_past_due(F.col("snapshot_date"), F.col("first_missed_date"), F.col("overdue_amt")))
    )
