"""Edge values of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import cleaning as clean
from tallyhouse.functions.labels import with_days_past_due
from tallyhouse.functions.schema import LOAN_TYPES, WIDE_TYPES, enforce, numeric_columns, struct_of

CASES = {
    "first_number": (clean.first_number, ["-5", "23_", "", None], [5, 23, None, None]),
    "age_in_range": (clean.age_in_range, ["-5", "2_3", "130", "", None], [5, 23, None, None, None]),
    "social_security": (clean.social_security, ["123-45-6789", "#F%$D@*&8", None], ["123-45-6789", None, None]),
    "occupation_title": (clean.occupation_title, ["_______", "  ", "Media_Manager", None], [None, None, "Media Manager", None]),
    "occupation_plain": (clean.occupation_plain, ["_______", "Media_Manager", "Lawyer"], [None, "Media Manager", "Lawyer"]),
    "person_name": (clean.person_name, [" O'Neil-Smith#1 ", None], ["O'Neil-Smith", None]),
    "money": (clean.money, ["1.2.3", "_", "-12.5_", "3.456"], [None, None, 12.5, 3.46]),
    "money_signed": (lambda c: clean.money(c, 2, True), ["-12.5_", "12.5_"], [None, 12.5]),
    "signed_decimal": (clean.signed_decimal, ["-1.255x", "_"], [-1.26, None]),
    "signed_count": (clean.signed_count, ["-4", "3_", ""], [None, 3, None]),
    "plain_count": (clean.plain_count, ["12.7", "-1", "", "x"], [12, None, None, None]),
    "digit_count": (clean.digit_count, ["-4", "3.0", "_"], [4, 30, None]),
    "digit_count_signed": (lambda c: clean.digit_count(c, True), ["-4", "3_"], [None, 3]),
    "history_years": (clean.history_years, ["2 Years and 6 Months", "NA"], [2.5, None]),
    "history_months": (clean.history_months, ["2 Years and 6 Months", "x 2 Years and 6 Months"], [30, None]),
    "credit_mix_title": (clean.credit_mix_title, [" standard", "_", None], ["Standard", None, None]),
    "ordinal": (lambda c: clean.ordinal(c, clean.CREDIT_MIX_ORDER), ["Good", " Good", None], [2, None, None]),
    "yes_no_text": (clean.yes_no_text, [" YES", "no", "NM", None], ["Yes", "No", None, None]),
    "yes_no_flag": (clean.yes_no_flag, ["Yes", "No", "yes", None], [True, False, None, None]),
    "loan_text": (clean.loan_text, [None, " ", "Auto Loan"], ["Not Specified", "Not Specified", "Auto Loan"]),
    "loan_array": (
        lambda c: clean.split_trim(clean.loan_list_text(c)),
        ["Auto Loan, Credit-Builder Loan, and Home Equity Loan", "Payday Loan and Mortgage Loan"],
        [["auto loan", "credit-builder loan", "home equity loan"], ["payday loan", "mortgage loan"]]),
}


@pytest.mark.parametrize("name", CASES)
def test_text(spark, name):
    f, given, expected = CASES[name]
    rows = spark.createDataFrame(list(enumerate(given)), "i int, v string")
    assert [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()] == expected


def test_cap_and_clamp_keep_null(spark):
    rows = spark.createDataFrame([(0, 12), (1, -3), (2, None)], "i int, v int").orderBy("i")
    got = rows.select(clean.cap(F.col("v"), 10), clean.clamp_negative(F.col("v"))).collect()
    assert [tuple(r) for r in got] == [(10, 12), (-3, 0), (None, None)]


def test_days_past_due(spark):
    march = dt.date(2024, 3, 1)
    rows = spark.createDataFrame(
        [(0, 6, 10.0, 0.0, march), (1, 6, 5.0, 10.0, march), (2, 6, None, 10.0, march), (3, None, 0.0, 10.0, march)],
        "i int, installment_num int, overdue_amt float, due_amt float, snapshot_date date")
    got = with_days_past_due(rows).orderBy("i").select(
        "mob", "installments_missed", "first_missed_date", "dpd", "overdue_amt").collect()
    assert [tuple(r) for r in got] == [
        (6, 0, None, None, 10.0), (6, 1, dt.date(2024, 2, 1), 29, 5.0), (6, 0, None, 0, 0.0), (0, 0, None, 0, 0.0)]


def test_enforce(spark):
    rows = spark.createDataFrame([("c1", "12.7", "x")], "customer_id string, Age string, other string")
    out = enforce(rows, WIDE_TYPES, strict=False)
    assert out.columns == ["Customer_ID", "Age", "other"] and out.first()["Age"] == 12
    assert numeric_columns(out) == ["Age"]
    with pytest.raises(ValueError, match="columns missing"):
        enforce(rows, LOAN_TYPES)
    assert struct_of(LOAN_TYPES).names == list(LOAN_TYPES)
