"""Label store: loans to days past due to labels. Narrow throughout, no shuffle for any number of months."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.labels import DPD, MOB, default_flag, with_days_past_due
from tallyhouse.functions.schema import LOAN_TYPES, enforce
from tallyhouse.operators.periods import at_mob


def loan_silver(loans: DataFrame) -> DataFrame:
    """Typed loans with month on book and days past due."""
    return with_days_past_due(enforce(loans, LOAN_TYPES))


def label_store(loans: DataFrame, dpd: int = DPD, mob: int = MOB) -> DataFrame:
    """One label per loan at a given month on book."""
    return at_mob(loan_silver(loans), mob).select(
        "loan_id", "Customer_ID", default_flag(F.col("dpd"), dpd).alias("label"),
        F.lit(f"{dpd}dpd_{mob}mob").alias("label_def"), "snapshot_date")
