"""Second feature store: one silver table per source, and the engagement and risk tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions import cleaning as clean
from tallyhouse.functions.ratios import risk_features
from tallyhouse.functions.schema import CLICK_COLUMNS, CLICK_TYPES, KEY, enforce
from tallyhouse.operators.joins import lagged_pivot

# Which cleaning each financial column takes, and the columns of the risk table.
AMOUNTS = [
    "Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt",
    "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
]
COUNTS = [
    "Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan", "Delay_from_due_date",
    "Num_of_Delayed_Payment", "Num_Credit_Inquiries", "Interest_Rate",
]
RATES = ["Changed_Credit_Limit", "Credit_Utilization_Ratio"]
CLICK_FEATURES = [f"click_{k}m" for k in range(1, 7)]
RISK_FEATURES = [
    "Credit_History_Age", "Num_Fin_Pdts", "EMI_to_Salary", "Debt_to_Salary", "Repayment_Ability",
    "Loans_per_Credit_Item", "Loan_Extent", "Outstanding_Debt", "Interest_Rate", "Delay_from_due_date",
    "Changed_Credit_Limit",
]
MODEL_FEATURES = CLICK_FEATURES + RISK_FEATURES


def clickstream_silver(clicks: DataFrame) -> DataFrame:
    """Typed click counts, negative ones to 0."""
    present = [n for n in CLICK_COLUMNS if n in clicks.columns]
    return enforce(clicks, CLICK_TYPES, strict=False).withColumns(
        {n: clean.clamp_negative(F.col(n)) for n in present})


def attributes_silver(attributes: DataFrame) -> DataFrame:
    """Cleaned personal attributes."""
    c = F.col
    return attributes.withColumns({
        "Name": clean.person_name(c("Name")),
        "Age": clean.age_in_range(c("Age")),
        "SSN": clean.social_security(c("SSN")),
        "Occupation": clean.occupation_plain(c("Occupation"))})


def financial_columns(signed: bool = False) -> dict[str, Column]:
    """Cleaned financial columns. ``signed`` reads the minus, which is otherwise dropped."""
    c = F.col
    counts = {n: clean.digit_count(c(n), signed) for n in COUNTS}
    return {
        **{n: clean.money(c(n), 3, signed) for n in AMOUNTS},
        **{n: clean.cap(e, clean.OUTLIER_CAPS[n]) if n in clean.OUTLIER_CAPS else e for n, e in counts.items()},
        **{n: clean.money(c(n), None, signed) for n in RATES},
        "Credit_History_Age": clean.history_months(c("Credit_History_Age")),
        "Credit_Mix": clean.ordinal(c("Credit_Mix"), clean.CREDIT_MIX_ORDER),
        "Payment_of_Min_Amount": clean.yes_no_flag(c("Payment_of_Min_Amount")),
        "Payment_Behaviour": clean.ordinal(c("Payment_Behaviour"), clean.PAYMENT_BEHAVIOUR_ORDER),
    }


def financials_silver(financials: DataFrame, signed: bool = False) -> DataFrame:
    """Cleaned, capped and encoded financials with the derived risk features."""
    return financials.withColumns(financial_columns(signed)).withColumns(risk_features())


def engagement(clicks: DataFrame, low: str | None = None, high: str | None = None) -> DataFrame:
    """Clicks of the six months before each snapshot, for all snapshots at once."""
    return lagged_pivot(clicks, "fe_1", "click", 6, low, high)


def risk(financials: DataFrame) -> DataFrame:
    """The features of the risk table."""
    return financials.select(*KEY, *RISK_FEATURES)
