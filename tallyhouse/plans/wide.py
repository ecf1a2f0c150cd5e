"""First feature store: one wide cleaned table (silver) and its encoded form (gold)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.functions import cleaning as clean
from tallyhouse.functions.ratios import wide_features
from tallyhouse.functions.schema import CLICK_COLUMNS, CUSTOMER, SNAPSHOT, WIDE_TYPES, enforce
from tallyhouse.operators.encode import encode_categories, vocabularies
from tallyhouse.operators.impute import FORWARD, LATEST, fill_const, fill_history, fill_median
from tallyhouse.operators.joins import join_sources
from tallyhouse.session import cut_lineage

# Which cleaning each column of the wide table takes.
MONEY = [
    "Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt", "Credit_Utilization_Ratio",
    "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
]
PLAIN_COUNTS = ["Num_Bank_Accounts", "Delay_from_due_date", "Num_Credit_Inquiries"]
SIGNED_COUNTS = ["Num_of_Loan", "Num_of_Delayed_Payment"]
WHOLE = ["Num_Credit_Card", "Interest_Rate"]
NUMBERS = MONEY + PLAIN_COUNTS + SIGNED_COUNTS + WHOLE + ["Changed_Credit_Limit", "Credit_History_Age"]
CATEGORIES = ["Occupation", "Credit_Mix", "Payment_Behaviour", "Payment_of_Min_Amount"]


def cleaned(behaviours: Sequence[str] = tuple(clean.PAYMENT_BEHAVIOUR_V1)) -> dict[str, Column]:
    """Cleaned columns of the joined sources, as one map."""
    c = F.col
    return {
        "Age": clean.first_number(c("Age")),
        "SSN": clean.social_security(c("SSN")),
        "Occupation": clean.occupation_title(c("Occupation")),
        "Changed_Credit_Limit": clean.signed_decimal(c("Changed_Credit_Limit")),
        "Credit_History_Age": clean.history_years(c("Credit_History_Age")),
        "Credit_Mix": clean.credit_mix_title(c("Credit_Mix")),
        "Payment_of_Min_Amount": clean.yes_no_text(c("Payment_of_Min_Amount")),
        "Payment_Behaviour": clean.allowed(c("Payment_Behaviour"), behaviours),
        **{n: clean.money(c(n)) for n in MONEY},
        **{n: clean.plain_count(c(n)) for n in PLAIN_COUNTS},
        **{n: clean.signed_count(c(n)) for n in SIGNED_COUNTS},
        **{n: clean.whole(c(n)) for n in WHOLE},
    }


def wide_silver(
    clicks: DataFrame, attributes: DataFrame, financials: DataFrame, median_by: Sequence[str] = (SNAPSHOT,),
) -> DataFrame:
    """Joined, cleaned, forward filled, median filled and typed features of all snapshots.

    Fills look back over a customer's history and never ahead, but for names. Medians are taken per
    snapshot, so that a month does not change when a later one arrives; ``median_by=()`` takes them
    over all rows. Sources are joined and cleaned once: fills and medians read the staged result twice.
    """
    joined = cut_lineage(join_sources(clicks, attributes, financials).withColumns(cleaned()), "wide-joined")
    fills = {n: FORWARD for n in [
        "Age", "SSN", "Occupation", "Type_of_Loan", "Credit_Mix", "Payment_Behaviour", *NUMBERS]}
    filled = fill_history(joined, fills | {"Name": LATEST}, [CUSTOMER], SNAPSHOT)
    named = fill_const(filled, {n: clean.UNKNOWN for n in ["SSN", "Name", *CATEGORIES]})
    loans = clean.loan_list_text(clean.loan_text(F.col("Type_of_Loan")))
    listed = named.withColumns({
        "Type_of_Loan": clean.loan_text(F.col("Type_of_Loan")),
        "cleaned_loans": loans,
        "loan_array": clean.split_trim(loans)})
    present = [n for n in CLICK_COLUMNS if n in clicks.columns]
    return enforce(
        fill_median(cut_lineage(listed, "wide-filled"), ["Age", *NUMBERS, *present], median_by), WIDE_TYPES, strict=False)


def fit_vocabularies(silver: DataFrame) -> tuple[dict[str, list[str]], dict[str, list[str]]]:
    """Category and loan-type vocabularies of a wide table, to be kept for all later snapshots.

    The placeholder comes first, so it is the category without a column of its own.
    """
    arrays = [n for n in ("loan_array",) if n in silver.columns]
    found = vocabularies(silver, CATEGORIES, arrays)
    lists = {n: found.pop(n) for n in arrays}
    return {n: [clean.UNKNOWN, *[v for v in vs if v != clean.UNKNOWN]] for n, vs in found.items()}, lists


def wide_gold(
    silver: DataFrame, vocabs: Mapping[str, Sequence[str]], array_vocabs: Mapping[str, Sequence[str]],
) -> DataFrame:
    """Categories and loan lists as 0/1 columns, plus the derived features."""
    encoded = encode_categories(silver, vocabs, array_vocabs)
    return encoded.drop("cleaned_loans", "Type_of_Loan").withColumns(wide_features())
