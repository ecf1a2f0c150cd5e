"""Registered queries: text cleaning, arrays, labels and ratios."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, functions as F

from tallyhouse.functions import cleaning as clean, labels
from tallyhouse.functions.ratios import wide_features
from tallyhouse.functions.schema import KEY
from tallyhouse.operators.encode import element_vocabulary, elements
from tallyhouse.plans.catalog import sql as q
from tallyhouse.plans.catalog.base import Tables
from tallyhouse.plans.wide import MONEY, PLAIN_COUNTS, SIGNED_COUNTS, WHOLE, cleaned

c = F.col
ENTRIES: dict = {}


def _columns(name: str, view: str, made: Callable[[], dict[str, Column]], said: dict[str, str], keep=tuple(KEY)) -> None:
    """A query that keeps the key and computes columns of a raw view."""
    def run(t: Tables):
        return t(view).select(*keep, *[e.alias(n) for n, e in made().items()])

    ENTRIES[name] = run, f"SELECT {q.named(said, ', '.join(keep))} FROM {view}"


# --- text cleaning ---
ATTR, FIN = "attributes_raw", "financials_raw"
_columns("f1_age_first_number", ATTR, lambda: {"Age": clean.first_number(c("Age"))}, {"Age": q.FIRST_NUMBER})
_columns("f2_age_in_range", ATTR, lambda: {"Age": clean.age_in_range(c("Age"))}, {"Age": q.AGE_IN_RANGE})
_columns("f3_social_security", ATTR, lambda: {"SSN": clean.social_security(c("SSN"))}, {"SSN": q.SSN})
_columns("f4_occupation_title", ATTR, lambda: {"Occupation": clean.occupation_title(c("Occupation"))},
         {"Occupation": q.OCCUPATION_TITLE})
_columns("f5_occupation_plain", ATTR, lambda: {"Occupation": clean.occupation_plain(c("Occupation"))},
         {"Occupation": q.OCCUPATION_PLAIN})
_columns("f6_person_name", ATTR, lambda: {"Name": clean.person_name(c("Name"))}, {"Name": q.NAME})
_columns("f7_money", FIN, lambda: {n: clean.money(c(n)) for n in MONEY}, {n: q.money(n) for n in MONEY})
_columns("f8_money_three_decimals", FIN, lambda: {n: clean.money(c(n), 3) for n in q.AMOUNTS},
         {n: q.money(n, 3) for n in q.AMOUNTS})
_columns("f9_signed_decimal", FIN, lambda: {"Changed_Credit_Limit": clean.signed_decimal(c("Changed_Credit_Limit"))},
         {"Changed_Credit_Limit": q.signed_decimal("Changed_Credit_Limit")})
_columns("f10_signed_count", FIN, lambda: {n: clean.signed_count(c(n)) for n in SIGNED_COUNTS},
         {n: q.signed_count(n) for n in SIGNED_COUNTS})
_columns("f11_plain_count", FIN, lambda: {n: clean.plain_count(c(n)) for n in PLAIN_COUNTS},
         {n: q.not_negative(q.whole(n)) for n in PLAIN_COUNTS})
_columns("f12_digit_count", FIN, lambda: {n: clean.digit_count(c(n)) for n in q.COUNTS},
         {n: q.digit_count(n) for n in q.COUNTS})
_RATES = ["Changed_Credit_Limit", "Credit_Utilization_Ratio"]
_columns("f13_rate", FIN, lambda: {n: clean.money(c(n), None) for n in _RATES}, {n: q.money(n, None) for n in _RATES})
_columns("f14_history_years", FIN, lambda: {"Credit_History_Age": clean.history_years(c("Credit_History_Age"))},
         {"Credit_History_Age": q.HISTORY_YEARS})
_columns("f15_history_months", FIN, lambda: {"Credit_History_Age": clean.history_months(c("Credit_History_Age"))},
         {"Credit_History_Age": q.HISTORY_MONTHS})
_columns("f16_credit_mix_title", FIN, lambda: {"Credit_Mix": clean.credit_mix_title(c("Credit_Mix"))},
         {"Credit_Mix": q.MIX_TITLE})
_columns("f17_credit_mix_ordinal", FIN, lambda: {"Credit_Mix": clean.ordinal(c("Credit_Mix"), clean.CREDIT_MIX_ORDER)},
         {"Credit_Mix": q.MIX_ORDINAL})
_columns("f18_min_payment_text", FIN, lambda: {"Payment_of_Min_Amount": clean.yes_no_text(c("Payment_of_Min_Amount"))},
         {"Payment_of_Min_Amount": q.YES_NO_TEXT})
_columns("f19_min_payment_flag", FIN, lambda: {"Payment_of_Min_Amount": clean.yes_no_flag(c("Payment_of_Min_Amount"))},
         {"Payment_of_Min_Amount": q.YES_NO_FLAG})
_columns("f20_behaviour_allowed", FIN,
         lambda: {"Payment_Behaviour": clean.allowed(c("Payment_Behaviour"), clean.PAYMENT_BEHAVIOUR_V1)},
         {"Payment_Behaviour": q.BEHAVIOUR_ALLOWED})
_columns("f21_behaviour_ordinal", FIN,
         lambda: {"Payment_Behaviour": clean.ordinal(c("Payment_Behaviour"), clean.PAYMENT_BEHAVIOUR_ORDER)},
         {"Payment_Behaviour": q.BEHAVIOUR_ORDINAL})
_columns("f22_loan_list_text", FIN, lambda: {"cleaned_loans": clean.loan_list_text(c("Type_of_Loan"))},
         {"cleaned_loans": q.loan_list("Type_of_Loan")})
_columns("f23_loan_text", FIN, lambda: {"Type_of_Loan": clean.loan_text(c("Type_of_Loan"))}, {"Type_of_Loan": q.LOAN_TEXT})


def _column_labels(t: Tables):
    """Column-name form of every loan type, from the flags that a fitted vocabulary makes."""
    loans = clean.split_trim(clean.loan_list_text(clean.loan_text(c("Type_of_Loan"))))
    found = elements(t(FIN).select(loans.alias("loans")), "loans")
    names = {v: clean.column_label(v) for v in element_vocabulary(t(FIN).select(loans.alias("loans")), "loans")}
    return found.withColumn("column_name", F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[c("element")])


ENTRIES["f24_column_label"] = _column_labels, f"""
SELECT DISTINCT element, replace(replace(element, ' ', '_'), '-', '_') AS column_name
FROM (SELECT unnest({q.loan_array(q.LOAN_TEXT)}) AS element FROM financials_raw)"""

# --- arrays ---


def _loan_array() -> Column:
    return clean.split_trim(clean.loan_list_text(clean.loan_text(c("Type_of_Loan"))))


_SQL_LOANS = q.loan_array(q.LOAN_TEXT)
_columns("a1_split_trim", FIN, lambda: {"loan_count": F.size(_loan_array()), "loans": F.array_join(_loan_array(), "|")},
         {"loan_count": f"CAST(len({_SQL_LOANS}) AS INT)", "loans": f"array_to_string({_SQL_LOANS}, '|')"})
ENTRIES["a2_distinct_elements"] = (
    lambda t: elements(t(FIN).select(_loan_array().alias("loans")), "loans"),
    f"SELECT DISTINCT unnest({_SQL_LOANS}) AS element FROM financials_raw")
_LOAN_TYPES = ["auto loan", "credit-builder loan", "home equity loan", "mortgage loan", "payday loan"]
_columns("a3_membership", FIN,
         lambda: {f"has_{clean.column_label(v)}": F.array_contains(_loan_array(), v).cast("int") for v in _LOAN_TYPES},
         {f"has_{clean.column_label(v)}": f"CAST(list_contains({_SQL_LOANS}, '{v}') AS INT)" for v in _LOAN_TYPES})


def _vector_elements(t: Tables):
    counts = t(FIN).select(*KEY, *[clean.whole(c(n)).cast("double").alias(n) for n in WHOLE])
    vectors = VectorAssembler(inputCols=WHOLE, outputCol="v", handleInvalid="keep").transform(counts)
    at = vector_to_array("v")
    return vectors.select(*KEY, F.get(at, F.lit(0)).alias("first"), F.get(at, F.lit(1)).alias("second"),
                          F.get(at, F.lit(9)).alias("tenth"))


ENTRIES["a4_vector_elements"] = _vector_elements, f"""
SELECT {q.KEY}, TRY_CAST({WHOLE[0]} AS DOUBLE) AS first, TRY_CAST({WHOLE[1]} AS DOUBLE) AS second,
  CAST(NULL AS DOUBLE) AS tenth FROM financials_raw"""

# --- labels ---
_LOAN = ["loan_id", "installment_num", "snapshot_date"]


def _loans(name: str, cols: list[str], source: str = "loan_silver") -> None:
    kept = ", ".join(dict.fromkeys(_LOAN + cols))
    ENTRIES[name] = (
        lambda t: t.loan_silver.select(*dict.fromkeys(_LOAN + cols)), f"SELECT {kept} FROM {source}")


_loans("m1_month_on_book", ["mob"])
_loans("m2_installments_missed", ["installments_missed"])
_loans("m3_first_missed_date", ["installments_missed", "first_missed_date"])
_loans("m4_days_past_due", ["overdue_amt", "dpd"])
ENTRIES["m5_default_label"] = (
    lambda t: t.loan_silver.select(
        *_LOAN, labels.default_flag(c("dpd"), 30).alias("label"), F.lit("30dpd_6mob").alias("label_def")),
    f"SELECT {', '.join(_LOAN)}, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, '30dpd_6mob' AS label_def FROM loan_silver")
ENTRIES["m6_dpd_flag"] = (
    lambda t: t.loan_silver.select(*_LOAN, "mob", labels.default_flag(c("dpd"), 60).alias("dpd_flag")),
    f"SELECT {', '.join(_LOAN)}, mob, CASE WHEN dpd >= 60 THEN 1 ELSE 0 END AS dpd_flag FROM loan_silver")

# --- ratios ---
_WIDE_IDS = {
    "m7_recent_delays": "Recent_Delays", "m8_income_to_debt": "Income_to_Debt_Ratio",
    "m9_emi_to_income": "EMI_to_Income_Ratio", "m10_monthly_saving": "Monthly_Saving",
    "m11_multi_borrower": "Is_Multi_Borrower", "m12_interest_across_loans": "Int_across_loans",
    "m13_delinquency": "Delinquency_Score",
}
for _name, _col in _WIDE_IDS.items():
    ENTRIES[_name] = (
        lambda t, n=_col: t(FIN).withColumns({k: v for k, v in cleaned().items() if k in q.V1_FINANCIAL})
        .select(*KEY, wide_features()[n].alias(n)),
        f"SELECT {q.KEY}, {q.WIDE_FEATURES[_col]} AS {_col} FROM financials_v1")
_RISK_IDS = {
    "m14_product_count": ["Num_Fin_Pdts"], "m15_loans_per_credit_item": ["Loans_per_Credit_Item"],
    "m16_debt_to_salary": ["Debt_to_Salary", "EMI_to_Salary"], "m17_repayment_ability": ["Repayment_Ability"],
    "m18_loan_extent": ["Loan_Extent"],
}
for _name, _cols in _RISK_IDS.items():
    ENTRIES[_name] = (
        lambda t, ns=_cols: t.financials.select(*KEY, *ns),
        f"SELECT {q.KEY}, {', '.join(_cols)} FROM financials_silver")
_columns("m19_cap_outliers", FIN,
         lambda: {n: clean.cap(clean.digit_count(c(n)), top) for n, top in clean.OUTLIER_CAPS.items()},
         {n: q.capped(n) for n in clean.OUTLIER_CAPS})
_columns("m20_clamp_negative", "clickstream_raw", lambda: {n: clean.clamp_negative(c(n)) for n in q.CLICKS},
         {n: f"CASE WHEN {n} < 0 THEN 0 ELSE {n} END" for n in q.CLICKS})
