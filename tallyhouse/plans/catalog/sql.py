"""DuckDB SQL for the comparison: expressions of the cleaning steps and the shared views."""

from __future__ import annotations

import re

from tallyhouse.functions.cleaning import OUTLIER_CAPS, PAYMENT_BEHAVIOUR_V1
from tallyhouse.sources.views import VIEWS, view_sql

KEY = "Customer_ID, snapshot_date"
# Characters that each kind of number keeps.
NUMBER, SIGNED_NUMBER, SIGNED_DIGITS, DIGITS = r"\d.", r"\d.-", r"\d-", r"\d"
HISTORY = "PARTITION BY Customer_ID ORDER BY snapshot_date"


def half_up(x: str, n: int) -> str:
    """Rounding of the decimal text, as Spark rounds doubles."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {n}) AS DOUBLE)"


def only(c: str, kept: str) -> str:
    return f"regexp_replace({c}, '[^{kept}]', '', 'g')"


def money(c: str, n: int | None = 2) -> str:
    value = f"TRY_CAST({only(c, NUMBER)} AS DOUBLE)"
    return value if n is None else half_up(value, n)


def signed_decimal(c: str) -> str:
    return half_up(f"TRY_CAST({only(c, SIGNED_NUMBER)} AS DOUBLE)", 2)


def not_negative(x: str) -> str:
    return f"CASE WHEN {x} >= 0 THEN {x} END"


def signed_count(c: str) -> str:
    return not_negative(f"TRY_CAST({only(c, SIGNED_DIGITS)} AS INT)")


def digit_count(c: str) -> str:
    return f"TRY_CAST({only(c, DIGITS)} AS INT)"


def whole(c: str) -> str:
    return f"CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS INT)"


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split({x}, ' '), "
            "lambda w: concat(upper(substr(w, 1, 1)), lower(substr(w, 2)))), ' ')")


FIRST_NUMBER = r"TRY_CAST(regexp_extract(Age, '(\d+)', 1) AS INT)"
AGE_DIGITS = digit_count("Age")
AGE_IN_RANGE = f"CASE WHEN {AGE_DIGITS} BETWEEN 0 AND 100 THEN {AGE_DIGITS} END"
SSN = r"CASE WHEN regexp_matches(SSN, '^\d{3}-\d{2}-\d{4}$') THEN SSN END"
OCCUPATION_TITLE = (
    "CASE WHEN trim(Occupation) <> '' AND Occupation <> '_______' THEN "
    + initcap("replace(Occupation, '_', ' ')") + " END")
OCCUPATION_PLAIN = (
    "CASE WHEN Occupation = 'Media_Manager' THEN 'Media Manager' "
    "WHEN Occupation <> '_______' THEN Occupation END")
NAME = "trim(regexp_replace(Name, '[^A-Za-z .''-]', '', 'g'))"
HISTORY_YEARS = half_up(
    r"(TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s+Years', 1) AS INT)"
    r" + TRY_CAST(regexp_extract(Credit_History_Age, '(\d+)\s+Months', 1) AS INT) / 12.0E0)", 2)
HISTORY_MONTHS = (
    r"TRY_CAST(regexp_extract(Credit_History_Age, '^(\d+) Years and (\d+) Months', 1) AS INT) * 12"
    r" + TRY_CAST(regexp_extract(Credit_History_Age, '^(\d+) Years and (\d+) Months', 2) AS INT)")
MIX_TITLE = f"CASE WHEN trim(Credit_Mix) <> '_' THEN {initcap('trim(Credit_Mix)')} END"
MIX_ORDINAL = "CASE Credit_Mix WHEN 'Bad' THEN 0 WHEN 'Standard' THEN 1 WHEN 'Good' THEN 2 END"
YES_NO_TEXT = (
    "CASE lower(trim(Payment_of_Min_Amount)) WHEN 'yes' THEN 'Yes' WHEN 'no' THEN 'No' END")
YES_NO_FLAG = "CASE Payment_of_Min_Amount WHEN 'Yes' THEN TRUE WHEN 'No' THEN FALSE END"
BEHAVIOUR_ALLOWED = (
    "CASE WHEN Payment_Behaviour IN (" + ", ".join(f"'{v}'" for v in PAYMENT_BEHAVIOUR_V1)
    + ") THEN Payment_Behaviour END")
BEHAVIOUR_ORDINAL = (
    "CASE Payment_Behaviour WHEN 'Low_spent_Small_value_payments' THEN 0 "
    "WHEN 'Low_spent_Medium_value_payments' THEN 1 WHEN 'Low_spent_Large_value_payments' THEN 2 "
    "WHEN 'High_spent_Small_value_payments' THEN 3 WHEN 'High_spent_Medium_value_payments' THEN 4 "
    "WHEN 'High_spent_Large_value_payments' THEN 5 END")
LOAN_TEXT = "CASE WHEN trim(Type_of_Loan) <> '' THEN Type_of_Loan ELSE 'Not Specified' END"


def loan_list(x: str) -> str:
    return rf"regexp_replace(lower({x}), '\s+and\s+|,\s+and\s+|,\s*', ',', 'g')"


def loan_array(x: str) -> str:
    return f"list_transform(string_split({loan_list(x)}, ','), lambda e: trim(e))"


MONEY = ["Annual_Income", "Monthly_Inhand_Salary", "Outstanding_Debt", "Credit_Utilization_Ratio",
         "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance"]
PLAIN_COUNTS = ["Num_Bank_Accounts", "Delay_from_due_date", "Num_Credit_Inquiries"]
SIGNED_COUNTS = ["Num_of_Loan", "Num_of_Delayed_Payment"]
WHOLE = ["Num_Credit_Card", "Interest_Rate"]
V1_FINANCIAL = {
    **{c: money(c) for c in MONEY},
    **{c: not_negative(whole(c)) for c in PLAIN_COUNTS},
    **{c: signed_count(c) for c in SIGNED_COUNTS},
    **{c: whole(c) for c in WHOLE},
    "Changed_Credit_Limit": signed_decimal("Changed_Credit_Limit"),
    "Credit_History_Age": HISTORY_YEARS,
    "Credit_Mix": MIX_TITLE,
    "Payment_of_Min_Amount": YES_NO_TEXT,
    "Payment_Behaviour": BEHAVIOUR_ALLOWED,
    "Type_of_Loan": "Type_of_Loan",
}
V1_NUMBERS = MONEY + PLAIN_COUNTS + SIGNED_COUNTS + WHOLE + ["Changed_Credit_Limit", "Credit_History_Age"]
V1_ATTRIBUTES = {"Name": "Name", "Age": FIRST_NUMBER, "SSN": SSN, "Occupation": OCCUPATION_TITLE}
CLICKS = [f"fe_{i}" for i in range(1, 21)]

AMOUNTS = [c for c in MONEY if c != "Credit_Utilization_Ratio"]
COUNTS = ["Num_Bank_Accounts", "Num_Credit_Card", "Num_of_Loan", "Delay_from_due_date",
          "Num_of_Delayed_Payment", "Num_Credit_Inquiries", "Interest_Rate"]
def capped(c: str) -> str:
    return f"CASE WHEN {digit_count(c)} > {OUTLIER_CAPS[c]} THEN {OUTLIER_CAPS[c]} ELSE {digit_count(c)} END"


V2_FINANCIAL = {
    **{c: money(c, 3) for c in AMOUNTS},
    **{c: capped(c) if c in OUTLIER_CAPS else digit_count(c) for c in COUNTS},
    **{c: money(c, None) for c in ("Changed_Credit_Limit", "Credit_Utilization_Ratio")},
    "Type_of_Loan": "Type_of_Loan",
    "Credit_History_Age": HISTORY_MONTHS,
    "Credit_Mix": MIX_ORDINAL,
    "Payment_of_Min_Amount": YES_NO_FLAG,
    "Payment_Behaviour": BEHAVIOUR_ORDINAL,
}
RISK_FEATURES = {
    "Num_Fin_Pdts": "Num_Bank_Accounts + Num_Credit_Card + Num_of_Loan",
    "Loans_per_Credit_Item": "CAST(Num_of_Loan AS DOUBLE) / NULLIF(Num_Bank_Accounts + Num_Credit_Card + 1, 0)",
    "Debt_to_Salary": "Outstanding_Debt / NULLIF(Monthly_Inhand_Salary + 1, 0)",
    "EMI_to_Salary": "Total_EMI_per_month / NULLIF(Monthly_Inhand_Salary + 1, 0)",
    "Repayment_Ability": "Monthly_Inhand_Salary - Total_EMI_per_month",
    "Loan_Extent": "Delay_from_due_date * Num_of_Loan",
}
RISK_COLUMNS = ["Credit_History_Age", "Num_Fin_Pdts", "EMI_to_Salary", "Debt_to_Salary", "Repayment_Ability",
                "Loans_per_Credit_Item", "Loan_Extent", "Outstanding_Debt", "Interest_Rate",
                "Delay_from_due_date", "Changed_Credit_Limit"]
CLICK_FEATURES = [f"click_{k}m" for k in range(1, 7)]


def ratio(top: str, bottom: str) -> str:
    return half_up(f"({top} / NULLIF({bottom}, 0))", 2)


WIDE_FEATURES = {
    "Recent_Delays": "CASE WHEN Delay_from_due_date > 10 THEN 1 ELSE 0 END",
    "Income_to_Debt_Ratio": ratio("Annual_Income", "Outstanding_Debt"),
    "EMI_to_Income_Ratio": ratio("Total_EMI_per_month", "(Annual_Income / 12)"),
    "Monthly_Saving": half_up("(Monthly_Inhand_Salary - Total_EMI_per_month - Amount_invested_monthly)", 2),
    "Is_Multi_Borrower": "CASE WHEN Num_Bank_Accounts + Num_Credit_Card > 6 THEN 1 ELSE 0 END",
    "Int_across_loans": ratio("CAST(Interest_Rate AS DOUBLE)", "Num_of_Loan"),
    "Delinquency_Score": ratio("CAST(Num_of_Delayed_Payment AS DOUBLE)", "Num_Credit_Card + Num_of_Loan"),
}


def named(exprs: dict[str, str], keep: str = KEY) -> str:
    return ", ".join(([keep] if keep else []) + [f"{e} AS {c}" for c, e in exprs.items()])


def ffilled(c: str) -> str:
    return f"last_value({c} IGNORE NULLS) OVER ({HISTORY} ROWS UNBOUNDED PRECEDING)"


def both_filled(c: str) -> str:
    ahead = f"first_value({c} IGNORE NULLS) OVER ({HISTORY} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    return f"coalesce({ffilled(c)}, {ahead})"


LATEST_NAME = (
    "coalesce(Name, first_value(Name IGNORE NULLS) OVER (PARTITION BY Customer_ID ORDER BY snapshot_date DESC "
    "ROWS UNBOUNDED PRECEDING), 'Unknown')")
FLOATS = ["loan_amt", "due_amt", "paid_amt", "overdue_amt", "balance"]
WIDE_MEDIANS = ["Age", *V1_NUMBERS, *CLICKS]
FILLED_V1 = ["Age", "SSN", "Occupation", "Type_of_Loan", "Credit_Mix", "Payment_Behaviour", *V1_NUMBERS]

# Shared views, each over the given views or earlier ones.
SHARED: dict[str, str] = {
    "loan_typed": "SELECT loan_id, Customer_ID, loan_start_date, tenure, CAST(installment_num AS INT) AS installment_num, "
    + ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in FLOATS) + ", snapshot_date FROM loan_daily",
    "loan_missed": "SELECT *, installment_num AS mob, coalesce(CAST(ceil(CAST(overdue_amt AS DOUBLE) / "
    "NULLIF(CAST(due_amt AS DOUBLE), 0)) AS INT), 0) AS installments_missed FROM loan_typed",
    "loan_first_missed": "SELECT *, CASE WHEN installments_missed > 0 THEN "
    "CAST(snapshot_date - to_months(installments_missed) AS DATE) END AS first_missed_date FROM loan_missed",
    "loan_silver": "SELECT *, CASE WHEN overdue_amt > 0 THEN CAST(snapshot_date - first_missed_date AS INT) "
    "ELSE 0 END AS dpd FROM loan_first_missed",
    "label_store": "SELECT loan_id, Customer_ID, CASE WHEN dpd >= 30 THEN 1 ELSE 0 END AS label, "
    "'30dpd_6mob' AS label_def, snapshot_date FROM loan_silver WHERE mob = 6",
    "clickstream_silver": "SELECT Customer_ID, snapshot_date, "
    + ", ".join(f"CASE WHEN {c} < 0 THEN 0 ELSE {c} END AS {c}" for c in CLICKS) + " FROM clickstream_raw",
    "financials_v1": f"SELECT {named(V1_FINANCIAL)} FROM financials_raw",
    "financials_v2": f"SELECT {named(V2_FINANCIAL)} FROM financials_raw",
    "financials_silver": f"SELECT *, {named(RISK_FEATURES, '')} FROM financials_v2",
    "risk": f"SELECT {KEY}, {', '.join(RISK_COLUMNS)} FROM financials_silver",
    "engagement": "SELECT Customer_ID, CAST(snapshot_date + to_months(k) AS DATE) AS snapshot_date, "
    + ", ".join(f"max(CASE WHEN k = {k} THEN fe_1 END) AS click_{k}m" for k in range(1, 7))
    + " FROM clickstream_silver CROSS JOIN (VALUES (1), (2), (3), (4), (5), (6)) AS lags(k) GROUP BY 1, 2",
    "wide_joined": "SELECT * FROM clickstream_raw FULL JOIN attributes_raw USING (Customer_ID, snapshot_date) "
    "FULL JOIN financials_raw USING (Customer_ID, snapshot_date)",
    "wide_cleaned": f"SELECT {named({c: c for c in CLICKS} | V1_ATTRIBUTES | V1_FINANCIAL)} FROM wide_joined",
    "wide_filled": f"SELECT {named({c: c for c in CLICKS} | {'Name': LATEST_NAME} | {c: ffilled(c) for c in FILLED_V1} | {'Payment_of_Min_Amount': 'Payment_of_Min_Amount'})} FROM wide_cleaned",
    "wide_medians": "SELECT snapshot_date, " + ", ".join(
        f"quantile_disc({c}, 0.5) AS median_{c}" for c in WIDE_MEDIANS) + " FROM wide_filled GROUP BY snapshot_date",
    "wide_silver": f"SELECT f.Customer_ID, f.snapshot_date, Name, "
    + ", ".join(f"CAST(coalesce({c}, median_{c}) AS {'DOUBLE' if c in CLICKS else 'INT' if c in ['Age', *PLAIN_COUNTS, *SIGNED_COUNTS, *WHOLE] else 'DOUBLE'}) AS {c}" for c in WIDE_MEDIANS)
    + ", " + ", ".join(f"coalesce({c}, 'Unknown') AS {c}" for c in (
        "SSN", "Occupation", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"))
    + f", {LOAN_TEXT} AS Type_of_Loan, {loan_list(LOAN_TEXT)} AS cleaned_loans, {loan_array(LOAN_TEXT)} AS loan_array"
    + " FROM wide_filled f LEFT JOIN wide_medians m ON f.snapshot_date = m.snapshot_date",
    "feature_set": "SELECT * FROM engagement FULL JOIN risk USING (Customer_ID, snapshot_date)",
    "scored_labels": "SELECT l.label, s.* FROM loan_labels l JOIN scores s "
    "ON l.Customer_ID = s.Customer_ID AND l.snapshot_date = s.snapshot_date WHERE s.model_predictions IS NOT NULL",
}


def quantile(values: str, p: str) -> str:
    """Linear interpolation in a list of all values, measured from the nearer neighbour."""
    ordered, place = f"list_sort(list({values}))", f"((count({values}) - 1) * ({p}))"
    low, high = f"{ordered}[CAST(floor({place}) AS INT) + 1]", f"{ordered}[CAST(ceil({place}) AS INT) + 1]"
    part = f"({place} - floor({place}))"
    return (f"CASE WHEN {part} < 0.5 THEN {low} + ({high} - {low}) * {part} "
            f"ELSE {high} - ({high} - {low}) * (1 - {part}) END")


def area(source: str, label: str, score: str, by: str = "") -> str:
    """AUC by pairs: each positive against the negatives below it, ties by half."""
    part = f"PARTITION BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return (
        f"SELECT {lead}CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives, "
        "CAST(sum(pos * (2 * below + neg)) AS DOUBLE) / NULLIF(CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) * 2, 0) AS auc "
        f"FROM (SELECT *, coalesce(sum(neg) OVER ({part} ORDER BY {score} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below "
        f"FROM (SELECT {lead}{score}, CAST(sum({label}) AS HUGEINT) AS pos, CAST(sum(1 - {label}) AS HUGEINT) AS neg FROM {source} "
        f"WHERE {label} IS NOT NULL AND {score} IS NOT NULL GROUP BY {lead}{score})) {group}")


def stability(source: str, value: str, by: str = "model_name") -> str:
    """PSI of each snapshot against the month before."""
    tenths = "[" + ", ".join(quantile("v", f"{i}/10.0E0") for i in range(11)) + "]"
    return f"""
WITH clean AS (SELECT {by}, snapshot_date, TRY_CAST({value} AS DOUBLE) AS v FROM {source} WHERE TRY_CAST({value} AS DOUBLE) IS NOT NULL),
edges AS (SELECT {by}, CAST(snapshot_date + INTERVAL 1 MONTH AS DATE) AS snapshot_date,
  list_sort(list_distinct({tenths})) AS edges FROM clean GROUP BY {by}, snapshot_date),
sides AS (SELECT {by}, snapshot_date, v, 1 AS a, 0 AS e FROM clean UNION ALL
  SELECT {by}, CAST(snapshot_date + INTERVAL 1 MONTH AS DATE), v, 0, 1 FROM clean),
placed AS (SELECT s.{by}, s.snapshot_date, len(edges) - 1 AS bins, a, e,
  CASE WHEN v = edges[1] THEN 1 WHEN v > edges[1] AND v <= edges[len(edges)] THEN len(list_filter(edges, lambda x: x < v)) END AS bin
  FROM sides s JOIN edges g ON s.{by} = g.{by} AND s.snapshot_date = g.snapshot_date),
counted AS (SELECT {by}, snapshot_date, bin, max(bins) AS bins, sum(a) AS a, sum(e) AS e FROM placed WHERE bin IS NOT NULL GROUP BY ALL),
totals AS (SELECT {by}, snapshot_date, max(bins) AS bins, sum(a) AS ta, sum(e) AS te FROM counted GROUP BY ALL),
spine AS (SELECT *, unnest(generate_series(1, bins)) AS bin FROM totals WHERE ta > 0 AND te > 0 AND bins >= 2),
shares AS (SELECT p.{by}, p.snapshot_date, p.bin, greatest(coalesce(CAST(a AS DOUBLE), 0) / ta, 1e-6) AS actual,
  greatest(coalesce(CAST(e AS DOUBLE), 0) / te, 1e-6) AS expected
  FROM spine p LEFT JOIN counted c ON p.{by} = c.{by} AND p.snapshot_date = c.snapshot_date AND p.bin = c.bin),
found AS (SELECT {by}, snapshot_date, round(sum((actual - expected) * ln(actual / expected)), 9) AS psi FROM shares GROUP BY ALL),
months AS (SELECT DISTINCT {by}, snapshot_date FROM clean)
SELECT m.{by}, m.snapshot_date, f.psi, CASE WHEN g.edges IS NULL THEN 'no previous snapshot'
  WHEN len(g.edges) <= 2 THEN 'too few distinct values' WHEN f.psi IS NULL THEN 'no value within the bins' ELSE 'ok' END AS psi_status
FROM months m LEFT JOIN found f ON m.{by} = f.{by} AND m.snapshot_date = f.snapshot_date
LEFT JOIN edges g ON m.{by} = g.{by} AND m.snapshot_date = g.snapshot_date"""


def split_place(key: list[str]) -> str:
    """48 bits of a row's key as a number, the same as in the split itself."""
    text = ", '|', ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in key)
    return f"('0x' || substr(md5(concat({text}, '|88')), 1, 12))::BIGINT"


def stratified(source: str, key: list[str], label: str = "label") -> str:
    """Of each label the four fifths with the smallest places."""
    return (
        f"SELECT * EXCLUDE (place), CASE WHEN rank() OVER (PARTITION BY {label} ORDER BY place) - 1 < "
        f"round(0.8 * count(*) OVER (PARTITION BY {label})) THEN 'train' ELSE 'test' END AS split "
        f"FROM (SELECT *, {split_place(key)} AS place FROM {source})")


def oot_split(source: str, key: tuple[str, ...] = ("loan_id", "snapshot_date"), first: str = "") -> str:
    """The last snapshots (the last one, or those from a date on) out of time, the rest stratified."""
    first = first or f"(SELECT max(snapshot_date) FROM {source})"
    return (
        stratified(f"(SELECT * FROM {source} WHERE snapshot_date < {first})", list(key))
        + f" UNION ALL SELECT *, 'oot' FROM {source} WHERE snapshot_date >= {first}")


def _names(text: str) -> list[str]:
    known = [*VIEWS, *SHARED]
    return [n for n in known if re.search(rf"\b{n}\b", text)]


def with_views(sql: str) -> str:
    """The statement with the views it needs put in front."""
    parts: dict[str, str] = {}

    def need(text: str) -> None:
        for name in _names(text):
            if name not in parts:
                body = view_sql(name) if name in VIEWS else SHARED[name]
                parts[name] = ""
                need(body)
                del parts[name]
                parts[name] = body

    need(sql)
    if not parts:
        return sql
    views = ",\n".join(f"{n} AS ({body})" for n, body in parts.items())
    sql = sql.strip()
    if sql.startswith("WITH "):
        return f"WITH {views},\n{sql[5:]}"
    return f"WITH {views}\n{sql}"
