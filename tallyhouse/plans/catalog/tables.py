"""Registered queries: scans and sinks, periods, schema, fills, joins, aggregates, encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.functions import cleaning as clean
from tallyhouse.functions.schema import (
    CUSTOMER, KEY, LOAN_TYPES, SNAPSHOT, WIDE_TYPES, columns_with_prefix, enforce,
    numeric_columns, struct_of,
)
from tallyhouse.operators import encode, impute, joins, periods
from tallyhouse.operators.drift import bad_rate_curve
from tallyhouse.operators.learn import oot_split, split_stats
from tallyhouse.operators.ranks import deciles
from tallyhouse.plans.catalog import sql as q
from tallyhouse.plans.catalog.base import Tables
from tallyhouse.plans.features import MODEL_FEATURES, RISK_FEATURES, clickstream_silver, engagement
from tallyhouse.plans.loans import label_store
from tallyhouse.plans.wide import CATEGORIES, cleaned, fit_vocabularies
from tallyhouse.session import cut_lineage
from tallyhouse.sources import tables as store

c = F.col
ENTRIES: dict = {}
LOAN_COLUMNS = ", ".join(LOAN_TYPES)
FIN_V1 = [n for n in q.V1_FINANCIAL]


def _stored(t: Tables, view: str = "loan_daily") -> str:
    """A view written to the store by snapshot; returns its path."""
    path = t.scratch(view)
    store.write_snapshots(t(view), path)
    return path


# --- scans and sinks ---
def _csv_scan(t: Tables):
    path = t.scratch("loan_csv")
    store.write_csv(t("loan_daily"), path)
    return store.scan_csv(t.spark, path, struct_of(LOAN_TYPES))


def _csv_snapshot(t: Tables):
    path = t.scratch("loan_csv")
    store.write_csv(t("loan_daily"), path)
    return store.scan_csv(t.spark, path, struct_of(LOAN_TYPES), "1998-03-01")


_LOAN_FLOATS = f"SELECT {LOAN_COLUMNS} FROM loan_typed"
ENTRIES["s1_csv_scan"] = _csv_scan, _LOAN_FLOATS
ENTRIES["s1_csv_scan_snapshot"] = _csv_snapshot, _LOAN_FLOATS + " WHERE snapshot_date = DATE '1998-03-01'"
ENTRIES["s2_snapshot_scan"] = (
    lambda t: store.scan_snapshot(t.spark, _stored(t), "1998-03-01"),
    "SELECT * FROM loan_daily WHERE snapshot_date = DATE '1998-03-01'")
ENTRIES["s3_table_scan"] = lambda t: store.scan_table(t.spark, _stored(t)), "SELECT * FROM loan_daily"
ENTRIES["s4_range_scan"] = (
    lambda t: store.scan_range(t.spark, _stored(t, "scores"), "2023-11-01", "2024-03-01"),
    "SELECT * FROM scores WHERE snapshot_date BETWEEN DATE '2023-11-01' AND DATE '2024-03-01'")
ENTRIES["s5_lagged_scan"] = (
    lambda t: store.lagged_scan(t.spark, _stored(t, "clickstream_raw"), "2024-06-01", 6),
    "SELECT *, CAST(6 - month(snapshot_date) AS INT) AS months_ago FROM clickstream_raw "
    "WHERE snapshot_date < DATE '2024-06-01'")
ENTRIES["s6_bronze_sink"] = (
    lambda t: store.scan_table(t.spark, _stored(t)).groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("n")),
    "SELECT snapshot_date, count(*) AS n FROM loan_daily GROUP BY snapshot_date")


def _rerun_one_month(t: Tables):
    """Write all months, then one of them again with other amounts: the others stay."""
    path = t.scratch("loan_silver")
    store.write_snapshots(t.loan_silver, path, key=("loan_id", "installment_num"))
    month = cut_lineage(store.scan_snapshot(t.spark, path, "1998-03-01").withColumn("dpd", F.lit(-1)), "month")
    store.write_snapshots(month, path)
    return store.scan_table(t.spark, path).select(*t.loan_silver.columns)


ENTRIES["s7_rerun_one_month"] = _rerun_one_month, (
    "SELECT * REPLACE (CASE WHEN snapshot_date = DATE '1998-03-01' THEN -1 ELSE dpd END AS dpd) FROM loan_silver")


def _bucketed_labels(t: Tables):
    """Labels and features in buckets of the key, joined bucket by bucket."""
    name = t.scratch("bucketed").rsplit("-", 1)[1]
    labels = store.write_bucketed(t("loan_labels"), f"labels_{name}", KEY, 8, t.scratch("labels"))
    features = store.write_bucketed(t.risk, f"risk_{name}", KEY, 8, t.scratch("risk"))
    return labels.join(features, [CUSTOMER, SNAPSHOT])


ENTRIES["s7_bucketed_join"] = _bucketed_labels, (
    "SELECT l.*, " + ", ".join(q.RISK_COLUMNS) + " FROM loan_labels l JOIN risk r ON l.Customer_ID = r.Customer_ID "
    "AND l.snapshot_date = r.snapshot_date")


# --- periods ---
ENTRIES["d1_month_spine"] = (
    lambda t: periods.snapshot_spine(t("loan_daily")),
    "SELECT CAST(unnest(generate_series(min(snapshot_date), max(snapshot_date), INTERVAL 1 MONTH)) AS DATE) "
    "AS snapshot_date FROM loan_daily")
ENTRIES["d2_training_periods"] = (
    lambda t: t("loan_daily").select(SNAPSHOT).distinct().select(
        SNAPSHOT, *[e.alias(n) for n, e in periods.training_periods(c(SNAPSHOT)).items()]),
    "SELECT DISTINCT snapshot_date, CAST(snapshot_date - INTERVAL 14 MONTH AS DATE) AS train_test_start_date, "
    "CAST(CAST(snapshot_date - INTERVAL 2 MONTH AS DATE) - 1 AS DATE) AS train_test_end_date, "
    "CAST(snapshot_date - INTERVAL 2 MONTH AS DATE) AS oot_start_date, "
    "CAST(snapshot_date - 1 AS DATE) AS oot_end_date FROM loan_daily")
ENTRIES["d3_prev_snapshot"] = (
    lambda t: t("scores").select(CUSTOMER, SNAPSHOT, periods.prev_snapshot(c(SNAPSHOT)).alias("previous")),
    "SELECT Customer_ID, snapshot_date, CAST(snapshot_date - INTERVAL 1 MONTH AS DATE) AS previous FROM scores")
ENTRIES["d4_backfill"] = (
    lambda t: label_store(t("loan_daily")).groupBy(SNAPSHOT).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("bad")),
    "SELECT snapshot_date, count(*) AS n, CAST(sum(label) AS BIGINT) AS bad FROM label_store GROUP BY snapshot_date")

# --- filters, schema ---
ENTRIES["p1_at_snapshot"] = (
    lambda t: periods.at_snapshot(t("loan_daily"), "1998-03-01"),
    "SELECT * FROM loan_daily WHERE snapshot_date = DATE '1998-03-01'")
ENTRIES["p2_at_mob"] = lambda t: periods.at_mob(t.loan_silver, 6), "SELECT * FROM loan_silver WHERE mob = 6"
ENTRIES["p3_in_period"] = (
    lambda t: periods.in_period(t("loan_daily"), "1996-01-01", "1997-12-31"),
    "SELECT * FROM loan_daily WHERE snapshot_date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'")
ENTRIES["p4_matured"] = (
    lambda t: periods.matured(t("loan_daily"), "1997-01-01", 3),
    "SELECT * FROM loan_daily WHERE loan_start_date < DATE '1997-01-01' AND installment_num = 3")
ENTRIES["p5_enforce"] = (
    lambda t: enforce(t("loan_daily"), LOAN_TYPES), f"SELECT {LOAN_COLUMNS} FROM loan_typed")
ENTRIES["p6_enforce_tolerant"] = (
    lambda t: enforce(t("financials_raw"), WIDE_TYPES, strict=False),
    "SELECT Customer_ID, snapshot_date, Type_of_Loan, Credit_Mix, Payment_of_Min_Amount, Payment_Behaviour, "
    + ", ".join(f"TRY_CAST({n} AS DOUBLE) AS {n}" for n in [
        *q.MONEY, "Changed_Credit_Limit", "Credit_History_Age"]) + ", "
    + ", ".join(f"{q.whole(n)} AS {n}" for n in [*q.PLAIN_COUNTS, *q.SIGNED_COUNTS, *q.WHOLE])
    + " FROM financials_raw")
ENTRIES["p7_project"] = (
    lambda t: t.risk, f"SELECT {q.KEY}, {', '.join(q.RISK_COLUMNS)} FROM financials_silver")
ENTRIES["p8_drop_rename"] = (
    lambda t: t("attributes_raw").drop("SSN", "Age").withColumnRenamed("Name", "Full_Name"),
    "SELECT Customer_ID, snapshot_date, Name AS Full_Name, Occupation FROM attributes_raw")


def _numeric_only(t: Tables):
    silver = t.financials
    return silver.select(*KEY, *numeric_columns(silver))


ENTRIES["p9_numeric_columns"] = _numeric_only, (
    "SELECT * EXCLUDE (Type_of_Loan, Payment_of_Min_Amount) FROM financials_silver")
ENTRIES["p10_columns_with_prefix"] = (
    lambda t: t("clickstream_raw").select(*KEY, *columns_with_prefix(t("clickstream_raw"), "fe_")),
    f"SELECT {q.KEY}, {', '.join(q.CLICKS)} FROM clickstream_raw")
ENTRIES["p11_complete_rows"] = (
    lambda t: impute.complete_rows(joins.training_rows(t("loan_labels"), t.risk)),
    "SELECT l.*, " + ", ".join(q.RISK_COLUMNS) + " FROM loan_labels l JOIN risk r ON l.Customer_ID = r.Customer_ID "
    "AND l.snapshot_date = r.snapshot_date WHERE " + " AND ".join(f"{n} IS NOT NULL" for n in q.RISK_COLUMNS))
ENTRIES["p12_constants"] = (
    lambda t: store.constants(
        t("loan_daily").select("loan_id", "installment_num"),
        {"label_def": F.lit("30dpd_6mob"), "as_of": F.lit("2001-12-01").cast("date")}),
    "SELECT loan_id, installment_num, '30dpd_6mob' AS label_def, DATE '2001-12-01' AS as_of FROM loan_daily")


def _empty_check(t: Tables):
    future = c(SNAPSHOT) >= F.lit("2030-01-01").cast("date")
    return t("scores").agg((F.count(F.lit(1)) == 0).alias("scores"), (F.count_if(future) == 0).alias("future"))


ENTRIES["p13_empty_check"] = _empty_check, (
    "SELECT NOT EXISTS (SELECT 1 FROM scores) AS scores, "
    "NOT EXISTS (SELECT 1 FROM scores WHERE snapshot_date >= DATE '2030-01-01') AS future")
ENTRIES["p14_reorder"] = (
    lambda t: t("clickstream_raw").select(SNAPSHOT, CUSTOMER, *reversed(q.CLICKS)),
    f"SELECT {q.KEY}, {', '.join(reversed(q.CLICKS))} FROM clickstream_raw")
ENTRIES["s12_profile"] = (
    lambda t: store.profile(t("loan_daily"), [SNAPSHOT, "installment_num", "due_amt"]),
    "SELECT count(*) AS n_rows, " + ", ".join(
        f"{f}({n}) AS {f}_{n}" for n in (SNAPSHOT, "installment_num", "due_amt") for f in ("min", "max"))
    + " FROM loan_daily")
ENTRIES["s12_profile_of_a_write"] = (
    lambda t: store.write_snapshots(
        t("loan_daily"), t.scratch("loan_daily"), observed=[SNAPSHOT, "installment_num", "due_amt"]),
    ENTRIES["s12_profile"][1])


# --- fills and medians ---
def _financials_v1(t: Tables):
    made = {k: v for k, v in cleaned().items() if k in q.V1_FINANCIAL}
    return t("financials_raw").withColumns(made)


def _staged_v1(t: Tables, *cols: str):
    rows = _financials_v1(t)
    return cut_lineage(rows.select(*cols) if cols else rows, "financials")  # fills and medians read it again


_W1 = ["Type_of_Loan", "Credit_Mix", "Payment_Behaviour", *q.V1_NUMBERS]
ENTRIES["w1_forward_fill"] = (
    lambda t: impute.ffill(_staged_v1(t), _W1, [CUSTOMER], SNAPSHOT),
    f"SELECT {q.named({n: q.ffilled(n) for n in _W1} | {'Payment_of_Min_Amount': 'Payment_of_Min_Amount'})} "
    "FROM financials_v1")


def _fill_by_month(t: Tables):
    """The last snapshot filled from the state that the ones before it leave, next to their own fill."""
    rows = _staged_v1(t)
    last = rows.agg(F.max(SNAPSHOT)).first()[0]
    early, late = rows.where(c(SNAPSHOT) < F.lit(last)), rows.where(c(SNAPSHOT) == F.lit(last))
    state = cut_lineage(impute.last_known(early, _W1, [CUSTOMER], SNAPSHOT), "fill-state")
    return impute.ffill(early, _W1, [CUSTOMER], SNAPSHOT).unionByName(impute.ffill_from(state, late, _W1, [CUSTOMER], SNAPSHOT))


ENTRIES["w1_forward_fill_by_month"] = _fill_by_month, ENTRIES["w1_forward_fill"][1]
ENTRIES["w2_forward_backward_fill"] = (
    lambda t: impute.ffill_bfill(cut_lineage(t.risk, "risk"), RISK_FEATURES, [CUSTOMER], SNAPSHOT),
    f"SELECT {q.named({n: q.both_filled(n) for n in q.RISK_COLUMNS})} FROM risk")
ENTRIES["w3_latest_name"] = (
    lambda t: impute.fill_latest(t("attributes_raw").select(*KEY, "Name"), "Name", [CUSTOMER], SNAPSHOT),
    f"SELECT {q.KEY}, {q.LATEST_NAME} AS Name FROM attributes_raw")
ENTRIES["w4_fill_from_group"] = (
    lambda t: impute.fill_from_group(
        t("attributes_raw").select(*KEY, clean.first_number(c("Age")).alias("Age")), "Age", [CUSTOMER], SNAPSHOT),
    f"""
WITH ages AS (SELECT {q.KEY}, first_value(age_found IGNORE NULLS) OVER (PARTITION BY Customer_ID ORDER BY snapshot_date
  ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS Age
  FROM (SELECT {q.KEY}, {q.FIRST_NUMBER} AS age_found FROM attributes_raw))
SELECT {q.KEY}, coalesce(Age, (SELECT quantile_disc(Age, 0.5) FROM ages)) AS Age FROM ages""")
ENTRIES["w5_latest_per_key"] = (
    lambda t: impute.latest_per_key(t("attributes_raw"), [CUSTOMER], SNAPSHOT),
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY Customer_ID ORDER BY snapshot_date DESC) AS rn "
    "FROM attributes_raw) WHERE rn = 1")
ENTRIES["i1_median_fill"] = (
    lambda t: impute.fill_median(_staged_v1(t, *KEY, *q.V1_NUMBERS), q.V1_NUMBERS),
    f"SELECT {q.named({n: f'coalesce({n}, median_{n})' for n in q.V1_NUMBERS})} FROM financials_v1 CROSS JOIN (SELECT "
    + ", ".join(f"quantile_disc({n}, 0.5) AS median_{n}" for n in q.V1_NUMBERS) + " FROM financials_v1)")
ENTRIES["i1_median_fill_by_snapshot"] = (
    lambda t: impute.fill_median(_staged_v1(t, *KEY, *q.V1_NUMBERS), q.V1_NUMBERS, [SNAPSHOT]),
    "SELECT f.Customer_ID, f.snapshot_date, " + ", ".join(f"coalesce({n}, median_{n}) AS {n}" for n in q.V1_NUMBERS)
    + " FROM financials_v1 f JOIN (SELECT snapshot_date, "
    + ", ".join(f"quantile_disc({n}, 0.5) AS median_{n}" for n in q.V1_NUMBERS)
    + " FROM financials_v1 GROUP BY snapshot_date) m ON f.snapshot_date = m.snapshot_date")
ENTRIES["i2_constant_fill"] = (
    lambda t: impute.fill_zero(impute.fill_const(
        t("attributes_raw").join(t("clickstream_raw"), KEY, "left").select(*KEY, "Name", "fe_1", "fe_2"),
        {"Name": clean.UNKNOWN})),
    "SELECT a.Customer_ID, a.snapshot_date, coalesce(Name, 'Unknown') AS Name, coalesce(fe_1, 0) AS fe_1, "
    "coalesce(fe_2, 0) AS fe_2 FROM attributes_raw a LEFT JOIN clickstream_raw k "
    "ON a.Customer_ID = k.Customer_ID AND a.snapshot_date = k.snapshot_date")
ENTRIES["i3_null_counts"] = (
    lambda t: impute.null_counts(_financials_v1(t)),
    "SELECT " + ", ".join(f"CAST(count_if({n} IS NULL) AS BIGINT) AS {n}" for n in [*KEY, *FIN_V1]) + " FROM financials_v1")

# --- joins ---
ENTRIES["j1_join_sources"] = lambda t: joins.join_sources(*t.raw), "SELECT * FROM wide_joined"
ENTRIES["j2_feature_set"] = (
    lambda t: joins.feature_set(t.engagement, t.risk), "SELECT * FROM feature_set")
ENTRIES["j3_scoring_set"] = (
    lambda t: joins.scoring_set(t.risk, t.engagement),
    "SELECT r.*, " + ", ".join(q.CLICK_FEATURES) + " FROM risk r LEFT JOIN engagement e "
    "ON r.Customer_ID = e.Customer_ID AND r.snapshot_date = e.snapshot_date")
ENTRIES["j4_training_rows"] = (
    lambda t: joins.training_rows(t("loan_labels"), t.risk),
    "SELECT l.*, " + ", ".join(q.RISK_COLUMNS) + " FROM loan_labels l LEFT JOIN risk r "
    "ON l.Customer_ID = r.Customer_ID AND l.snapshot_date = r.snapshot_date")
ENTRIES["j5_label_predictions"] = (
    lambda t: joins.label_predictions(t("loan_labels"), t("scores")).select(
        "loan_id", *KEY, "label", "label_def", "model_name", "model_predictions"),
    "SELECT l.*, model_name, model_predictions FROM loan_labels l JOIN scores s "
    "ON l.Customer_ID = s.Customer_ID AND l.snapshot_date = s.snapshot_date WHERE model_predictions IS NOT NULL")

# --- aggregates ---
ENTRIES["g1_lagged_pivot"] = lambda t: t.engagement, f"SELECT {q.KEY}, {', '.join(q.CLICK_FEATURES)} FROM engagement"


def _engagement_of_a_month(t: Tables):
    """One month built anew from the six partitions before it."""
    return engagement(clickstream_silver(store.scan_table(t.spark, _stored(t, "clickstream_raw"))), "2024-05-01", "2024-05-01")


ENTRIES["g1_lagged_pivot_of_a_month"] = _engagement_of_a_month, (
    f"SELECT {q.KEY}, {', '.join(q.CLICK_FEATURES)} FROM engagement WHERE snapshot_date = DATE '2024-05-01'")
ENTRIES["g2_bad_rate_curve"] = (
    lambda t: bad_rate_curve(t.loan_silver, 30),
    "SELECT mob, count(*) AS n, avg(CASE WHEN dpd >= 30 THEN 1 ELSE 0 END) AS bad_rate FROM loan_silver GROUP BY mob ORDER BY mob")
ENTRIES["g3_split_stats"] = (
    lambda t: split_stats(oot_split(t("loan_labels"), ["loan_id", SNAPSHOT])),
    f"SELECT split, count(*) AS n, {q.half_up('avg(label)', 2)} AS bad_share FROM "
    f"({q.oot_split('loan_labels')}) GROUP BY split")
ENTRIES["g5_max_snapshot"] = (
    lambda t: periods.max_snapshot(t("loan_daily")), "SELECT max(snapshot_date) AS snapshot_date FROM loan_daily")


def _deciles(t: Tables):
    edges = deciles(t("scores"), "model_predictions", [SNAPSHOT])
    return edges.select(SNAPSHOT, *[F.get("edges", F.lit(i)).alias(f"p{i * 10}") for i in range(11)])


ENTRIES["g6_deciles"] = _deciles, (
    "SELECT snapshot_date, " + ", ".join(f"{q.quantile('model_predictions', f'{i}/10.0E0')} AS p{i * 10}" for i in range(11))
    + " FROM scores GROUP BY snapshot_date")
ENTRIES["g7_category_counts"] = (
    lambda t: encode.category_counts(t("attributes_raw"), "Occupation"),
    "SELECT Occupation, count(*) AS n FROM attributes_raw WHERE Occupation IS NOT NULL GROUP BY Occupation")
ENTRIES["u1_union_months"] = (
    lambda t: joins.lagged(t.clicks, F.lit("2024-05-01").cast("date"), 3).select(CUSTOMER, "fe_1", "months_ago"),
    " UNION ALL ".join(
        f"SELECT Customer_ID, fe_1, {k} AS months_ago FROM clickstream_silver WHERE snapshot_date = DATE '2024-0{5 - k}-01'"
        for k in (1, 2, 3)))
ENTRIES["u2_distinct"] = (
    lambda t: t("attributes_raw").select("Occupation").distinct(), "SELECT DISTINCT Occupation FROM attributes_raw")
ENTRIES["o1_sorted"] = (
    lambda t: t("loan_daily").groupBy(SNAPSHOT).agg(F.count(F.lit(1)).alias("n")).orderBy(SNAPSHOT),
    "SELECT snapshot_date, count(*) AS n FROM loan_daily GROUP BY snapshot_date ORDER BY snapshot_date")
ENTRIES["o2_first_rows"] = (
    lambda t: t("loan_daily").orderBy("loan_id", "installment_num").limit(20),
    "SELECT * FROM loan_daily ORDER BY loan_id, installment_num LIMIT 20")

# --- encoders ---
OCCUPATIONS = ["Automobile", "Building", "Furniture", "Household", "Machinery", "Media Manager"]
LOANS = ["auto loan", "credit-builder loan", "home equity loan", "mortgage loan", "not specified", "payday loan"]


def _string_index(t: Tables):
    titled = t("attributes_raw").select(*KEY, clean.occupation_title(c("Occupation")).alias("Occupation"))
    return encode.index_strings(titled, "Occupation", "Occupation_Indexed")


ENTRIES["e1_string_index"] = _string_index, f"""
WITH titled AS (SELECT {q.KEY}, {q.OCCUPATION_TITLE} AS Occupation FROM attributes_raw),
ranked AS (SELECT Occupation, CAST(row_number() OVER (ORDER BY count(*) DESC, Occupation) - 1 AS INT) AS i
  FROM titled WHERE Occupation IS NOT NULL GROUP BY Occupation)
SELECT t.*, coalesce(i, (SELECT CAST(count(*) AS INT) FROM ranked)) AS Occupation_Indexed
FROM titled t LEFT JOIN ranked r ON t.Occupation = r.Occupation"""
def _one_hot(t: Tables):
    """All four category columns of the wide table, by vocabularies fitted on it."""
    rows = t("attributes_raw").join(t("financials_raw"), KEY).withColumns(cleaned()).fillna(clean.UNKNOWN, CATEGORIES)
    rows = rows.select(*KEY, *CATEGORIES)
    return encode.encode_categories(rows, fit_vocabularies(rows)[0])


VOCABS = {
    "Occupation": [clean.UNKNOWN, *OCCUPATIONS], "Credit_Mix": [clean.UNKNOWN, *clean.CREDIT_MIX_ORDER],
    "Payment_Behaviour": [clean.UNKNOWN, *clean.PAYMENT_BEHAVIOUR_V1], "Payment_of_Min_Amount": [clean.UNKNOWN, "No", "Yes"],
}
ENTRIES["e2_one_hot"] = _one_hot, (
    "SELECT a.Customer_ID, a.snapshot_date, " + ", ".join(
        f"coalesce(CAST({e} = '{v}' AS INT), 0) AS {n}_{clean.column_label(v)}"
        for n, e in (("Occupation", q.OCCUPATION_TITLE), ("Credit_Mix", q.MIX_TITLE), ("Payment_Behaviour", q.BEHAVIOUR_ALLOWED),
                     ("Payment_of_Min_Amount", q.YES_NO_TEXT)) for v in VOCABS[n][1:])
    + " FROM attributes_raw a JOIN financials_raw f ON a.Customer_ID = f.Customer_ID AND a.snapshot_date = f.snapshot_date")
ENTRIES["e3_multi_hot"] = (
    lambda t: encode.encode_categories(
        t("financials_raw").select(
            *KEY, clean.split_trim(clean.loan_list_text(clean.loan_text(c("Type_of_Loan")))).alias("loan_array")),
        {}, {"loan_array": LOANS}),
    f"SELECT {q.KEY}, " + ", ".join(
        f"CAST(list_contains({q.loan_array(q.LOAN_TEXT)}, '{v}') AS INT) AS {clean.column_label(v)}"
        for v in LOANS if v != "not specified") + " FROM financials_raw")
ENTRIES["e4_ordinal"] = (
    lambda t: t.financials.select(*KEY, "Credit_Mix", "Payment_Behaviour"),
    f"SELECT {q.KEY}, Credit_Mix, Payment_Behaviour FROM financials_silver")
_SCALED = MODEL_FEATURES


def _scaled(t: Tables):
    rows = oot_split(joins.feature_set(t.engagement, t.risk).select(*KEY, *_SCALED), KEY, label=None)
    fitted = encode.scaler(rows.where(c("split") == "train"), _SCALED)
    out = encode.scale(rows, fitted, _SCALED)
    return out.select(*KEY, "split", *[F.round(n, 6).alias(n) for n in _SCALED])


ENTRIES["e5_scale"] = _scaled, f"""
WITH parts AS (SELECT {q.KEY}, {', '.join(_SCALED)}, CASE WHEN snapshot_date = (SELECT max(snapshot_date) FROM feature_set) THEN 'oot'
  WHEN {q.split_place(['Customer_ID', 'snapshot_date'])} < 0.8 * 281474976710656 THEN 'train' ELSE 'test' END AS split FROM feature_set),
fitted AS (SELECT {', '.join(f'avg({n}) AS mean_{n}, stddev_pop({n}) AS std_{n}' for n in _SCALED)} FROM parts WHERE split = 'train')
SELECT {q.KEY}, split, {', '.join(q.half_up(f'(({n} - mean_{n}) / (CASE WHEN std_{n} = 0 THEN 1 ELSE std_{n} END))', 6) + f' AS {n}' for n in _SCALED)}
FROM parts CROSS JOIN fitted"""
