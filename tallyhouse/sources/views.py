"""Views that shape the test tables like the inputs of the pipeline, dirt included.

One text per view serves Spark and DuckDB alike: table names and the month list stand in braces.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.session import dealt

VIEWS: dict[str, str] = {
    "loan_daily": """
SELECT concat('L', CAST(l_orderkey AS STRING)) AS loan_id,
       concat('CUS_', CAST(o_custkey AS STRING)) AS Customer_ID,
       CAST(o_orderdate AS DATE) AS loan_start_date,
       7 AS tenure, l_linenumber AS installment_num,
       MAX(l_extendedprice) AS loan_amt,
       CASE WHEN MAX(l_quantity) < 3 THEN 0.0E0 ELSE MAX(l_extendedprice) END AS due_amt,
       MIN(l_extendedprice) AS paid_amt,
       CASE WHEN MAX(l_discount) >= 0.04E0 THEN MAX(l_extendedprice) * MAX(l_discount) * 37 ELSE 0.0E0 END AS overdue_amt,
       MAX(l_extendedprice) AS balance,
       CAST(date_trunc('month', MAX(l_shipdate)) AS DATE) AS snapshot_date
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey
GROUP BY l_orderkey, o_custkey, o_orderdate, l_linenumber""",
    "clickstream_raw": """
SELECT concat('CUS_', CAST(user_id AS STRING)) AS Customer_ID,
       make_date(2024, CAST(floor((day(ts) - 1) / 5) AS INT) + 1, 1) AS snapshot_date,
       CAST(SUM(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) - 1 AS INT) AS fe_1,
       CAST(NULLIF(SUM(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END), 0) AS INT) AS fe_2,
       CAST(SUM(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) - 2 AS INT) AS fe_3,
       CAST(SUM(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS INT) AS fe_4,
       CAST(NULLIF(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END), 1) AS INT) AS fe_5,
       {clicks}
FROM {events}
GROUP BY user_id, make_date(2024, CAST(floor((day(ts) - 1) / 5) AS INT) + 1, 1)""",
    "attributes_raw": """
SELECT concat('CUS_', CAST(c_custkey AS STRING)) AS Customer_ID,
       make_date(2024, m, 1) AS snapshot_date,
       CASE WHEN (c_custkey + m) % 4 = 0 THEN NULL ELSE concat(c_name, ' O''Neil-Smith ') END AS Name,
       CASE WHEN (c_custkey + m) % 17 = 0 THEN concat('-', CAST(c_custkey % 90 AS STRING))
            WHEN (c_custkey + m) % 19 = 0 THEN ''
            WHEN (c_custkey + m) % 7 = 0 THEN concat(CAST(c_custkey % 130 AS STRING), '_')
            ELSE CAST(c_custkey % 130 AS STRING) END AS Age,
       CASE WHEN (c_custkey + m) % 11 = 0 THEN '#F%$D@*&8'
            ELSE concat(lpad(CAST(c_custkey % 1000 AS STRING), 3, '0'), '-', lpad(CAST(c_nationkey AS STRING), 2, '0'), '-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0')) END AS SSN,
       CASE WHEN (c_custkey + m) % 13 = 0 THEN '_______'
            WHEN c_custkey % 5 = 0 THEN 'Media_Manager' ELSE c_mktsegment END AS Occupation
FROM {customer} {months}
WHERE c_custkey % 10 <> m""",
    "financials_raw": """
SELECT concat('CUS_', CAST(c_custkey AS STRING)) AS Customer_ID,
       make_date(2024, m, 1) AS snapshot_date,
       concat(CAST(c_acctbal AS STRING), CASE WHEN (c_custkey + m) % 9 = 0 THEN '_' ELSE '' END) AS Annual_Income,
       CASE WHEN (c_custkey * 7 + m) % 5 = 0 THEN NULL ELSE CAST(c_acctbal AS STRING) END AS Monthly_Inhand_Salary,
       CAST((c_custkey * 5 + m) % 14 - 1 AS STRING) AS Num_Bank_Accounts,
       CAST((c_custkey * 3 + m) % 12 AS STRING) AS Num_Credit_Card,
       CAST((c_custkey + m) % 40 AS STRING) AS Interest_Rate,
       concat(CAST((c_custkey * 3 + m) % 12 - 1 AS STRING), CASE WHEN (c_custkey + m) % 6 = 0 THEN '_' ELSE '' END) AS Num_of_Loan,
       CASE (c_custkey + m) % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Auto Loan, Credit-Builder Loan, and Home Equity Loan'
            WHEN 3 THEN 'Payday Loan and Mortgage Loan' ELSE 'Not Specified' END AS Type_of_Loan,
       CAST((c_custkey * 11 + m) % 60 - 5 AS STRING) AS Delay_from_due_date,
       concat(CAST((c_custkey * 13 + m) % 60 - 3 AS STRING), CASE WHEN (c_custkey + m) % 8 = 0 THEN '_' ELSE '' END) AS Num_of_Delayed_Payment,
       CASE WHEN (c_custkey + m) % 10 = 0 THEN '_' ELSE CAST((c_custkey % 300 - 50) / 10.0E0 AS STRING) END AS Changed_Credit_Limit,
       CAST((c_custkey * 2 + m) % 35 AS STRING) AS Num_Credit_Inquiries,
       CASE (c_custkey + m) % 4 WHEN 0 THEN '_' WHEN 1 THEN 'Good' WHEN 2 THEN ' standard' ELSE 'Bad' END AS Credit_Mix,
       concat(CAST(c_acctbal AS STRING), CASE WHEN (c_custkey + m) % 15 = 0 THEN '_' ELSE '' END) AS Outstanding_Debt,
       CAST((c_custkey % 500) / 10.0E0 AS STRING) AS Credit_Utilization_Ratio,
       CASE WHEN (c_custkey + m) % 9 = 0 THEN 'NA' ELSE concat(CAST(c_custkey % 30 AS STRING), ' Years and ', CAST((c_custkey + m) % 12 AS STRING), ' Months') END AS Credit_History_Age,
       CASE (c_custkey + m) % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'NM' END AS Payment_of_Min_Amount,
       CAST((c_custkey % 700) / 4.0E0 AS STRING) AS Total_EMI_per_month,
       CASE WHEN (c_custkey + m) % 14 = 0 THEN '__10000__' ELSE CAST((c_custkey % 900) / 8.0E0 AS STRING) END AS Amount_invested_monthly,
       CASE (c_custkey + m) % 7 WHEN 0 THEN 'High_spent_Small_value_payments' WHEN 1 THEN 'High_spent_Medium_value_payments'
            WHEN 2 THEN 'High_spent_Large_value_payments' WHEN 3 THEN 'Low_spent_Small_value_payments'
            WHEN 4 THEN 'Low_spent_Medium_value_payments' WHEN 5 THEN 'Low_spent_Large_value_payments' ELSE '!@9#%8' END AS Payment_Behaviour,
       CAST((c_custkey % 1000) / 2.0E0 AS STRING) AS Monthly_Balance
FROM {customer} {months}""",
    "loan_labels": """
SELECT concat('LN_', CAST(c_custkey AS STRING), '_', CAST(m AS STRING)) AS loan_id,
       concat('CUS_', CAST(c_custkey AS STRING)) AS Customer_ID,
       CASE WHEN c_acctbal < 1000 OR (c_custkey * 7 + m) % 11 = 0 THEN 1 ELSE 0 END AS label,
       '30dpd_6mob' AS label_def,
       CAST(make_date(2024, CAST(m AS INT), 1) AS DATE) AS snapshot_date
FROM {customer} {year}
WHERE c_custkey % 3 = m % 3""",
    "scores": """
SELECT concat('CUS_', CAST(event_id AS STRING)) AS Customer_ID,
       make_date(2024, CAST(floor((day(ts) - 1) / 5) AS INT) + 1, 1) AS snapshot_date,
       'credit_model_2024_09_01' AS model_name,
       round(value / (value + 50.0E0), 2) AS model_predictions
FROM {events}""",
    "doc_scores": """
SELECT l.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS score
FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id""",
}

# The other click counts: events of one hour class each, some below zero.
CLICKS = ",\n       ".join(
    f"CAST(SUM(CASE WHEN hour(ts) % 15 = {i - 6} THEN {1 + i % 3} ELSE 0 END) - {i % 4} AS INT) AS fe_{i}" for i in range(6, 21))

# The six months as a row generator of each engine; in Spark it stays inside code generation.
SPARK_MONTHS = "LATERAL VIEW explode(sequence(1, 6)) p AS m"
SPARK_YEAR = "LATERAL VIEW explode(sequence(1, 12)) p AS m"
DUCKDB_YEAR = "CROSS JOIN range(1, 13) AS p(m)"
DUCKDB_MONTHS = "CROSS JOIN (VALUES (1), (2), (3), (4), (5), (6)) AS p(m)"


# Tables of which a view makes several wide rows a row, and the key by which they are dealt out first.
DEALT_BY = {"customer": "c_custkey"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shaped views.

    A table in `DEALT_BY` is small as a file, down to one row group of a million rows, but not as the rows that are made of it:
    its rows are dealt out before, so that a task makes a bounded number of them however the file is cut.
    """
    text = VIEWS[name].replace("{months}", SPARK_MONTHS).replace("{year}", SPARK_YEAR).replace("{clicks}", CLICKS)
    tables = {t: table(spark, sf_dir, t) for t in set(re.findall(r"{(\w+)}", text))}
    tables = {t: dealt(df, [DEALT_BY[t]]) if t in DEALT_BY else df for t, df in tables.items()}
    return spark.sql(text, **tables)


def view_sql(name: str) -> str:
    """The view as SQL over the table names."""
    return re.sub(r"{(\w+)}", r"\1", VIEWS[name].replace("{months}", DUCKDB_MONTHS).replace("{year}", DUCKDB_YEAR).replace("{clicks}", CLICKS)).strip()
