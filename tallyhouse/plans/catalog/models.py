"""Registered queries: learning, monitoring and the gold tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.functions import cleaning as clean
from tallyhouse.functions.schema import SNAPSHOT, columns_with_prefix
from tallyhouse.operators import drift, joins, learn
from tallyhouse.operators.ranks import auc, five_numbers, gini
from tallyhouse.operators.trees import load_trees, save_trees, with_probability
from tallyhouse.plans.catalog import sql as q
from tallyhouse.plans.catalog.base import Tables
from tallyhouse.plans.catalog.tables import LOANS, VOCABS
from tallyhouse.plans.features import CLICK_FEATURES, MODEL_FEATURES, RISK_FEATURES, attributes_silver
from tallyhouse.plans.loans import label_store
from tallyhouse.plans.model import filled_features, monitoring, predictions, training_set
from tallyhouse.plans.wide import fit_vocabularies, wide_gold, wide_silver
from tallyhouse.session import cut_lineage
from tallyhouse.sources import tables as store

c = F.col
ENTRIES: dict = {}
LOAN_KEY = ["loan_id", SNAPSHOT]


# --- splits ---
ENTRIES["l1_oot_split"] = lambda t: learn.oot_split(t("loan_labels"), LOAN_KEY), q.oot_split("loan_labels")
ENTRIES["l1_period_split"] = (
    lambda t: learn.period_split(t("loan_labels"), "2024-06-01", LOAN_KEY, train_months=2, oot_months=2),
    q.oot_split(
        "(SELECT * FROM loan_labels WHERE snapshot_date BETWEEN DATE '2024-02-01' AND DATE '2024-05-31')",
        first="DATE '2024-04-01'"))
ENTRIES["l2_train_test_split"] = (
    lambda t: learn.train_test_split(t("loan_labels"), LOAN_KEY), q.stratified("loan_labels", LOAN_KEY))


# --- models. A fitted tree has no SQL form; what surrounds the figures (rows, splits, keys, months) has, in entries of its own ---
FEATURES = MODEL_FEATURES


def _training_rows(t: Tables):
    return training_set(t("loan_labels"), t.engagement, t.risk, backward=True)


def _rows(t: Tables):
    """Complete labelled rows of all features, filled both ways as for scoring, with their split."""
    return learn.oot_split(cut_lineage(_training_rows(t), "training-rows"), LOAN_KEY)  # read by both parts of the split


def _staged_rows(t: Tables):
    return cut_lineage(_rows(t), "split-rows")


def _training_sql(fill) -> str:
    cols = [*CLICK_FEATURES, *RISK_FEATURES]
    return (
        "WITH filled AS (SELECT " + q.named({n: fill(n) for n in cols}) + " FROM feature_set) "
        "SELECT l.*, " + ", ".join(cols) + " FROM loan_labels l JOIN filled f ON l.Customer_ID = f.Customer_ID "
        "AND l.snapshot_date = f.snapshot_date WHERE " + " AND ".join(f"{n} IS NOT NULL" for n in cols))


_SPLIT_ROWS = q.oot_split(f"({_training_sql(q.both_filled)})")


def _train(rows):
    return rows.where(c("split") == "train")


def _fit(rows):
    """The trees that score: as many and as deep as the library's defaults say."""
    return learn.fit_trees(_train(rows), FEATURES, LOAN_KEY)


def _trees(t: Tables):
    """Spark's boosted trees on all training rows, as many as the largest of the search grid."""
    rows = _staged_rows(t)
    return learn.split_auc(learn.fit_boosted_trees(_train(rows), FEATURES, maxIter=100), rows)


ENTRIES["l3_boosted_trees"] = _trees, None


def _split_sizes(t: Tables):
    rows = _staged_rows(t)
    return learn.split_auc(_fit(rows), rows).where(c("auc").between(0, 1)).select("split", "positives", "negatives")


ENTRIES["l3_split_sizes"] = _split_sizes, (
    "SELECT split, CAST(sum(label) AS BIGINT) AS positives, CAST(sum(1 - label) AS BIGINT) AS negatives "
    f"FROM ({_SPLIT_ROWS}) GROUP BY split")


def _search(t: Tables):
    """The whole search: 100 draws of the large grid, 3 folds, the winner judged on all splits."""
    rows = _staged_rows(t)
    return learn.train_model(rows, FEATURES, LOAN_KEY)[1]


ENTRIES["l4_random_search"] = lambda t: _search(t).withColumn("hp_params", F.to_json("hp_params")), None
ENTRIES["l4_search_draws"] = lambda t: learn.search_table(_train(_staged_rows(t)), FEATURES, LOAN_KEY), None


def _search_record(t: Tables):
    sound = [c(f"auc_{p}").between(0, 1) & (F.round(2 * c(f"auc_{p}") - 1, 3) == c(f"gini_{p}")) for p in learn.PARTS]
    record = _search(t).where(c("auc_cv").between(0.5, 1) & sound[0] & sound[1] & sound[2])
    return record.select(SNAPSHOT, "model_version", *[f"{n}_{p}" for n in ("n", "bad_share") for p in learn.PARTS])


ENTRIES["l4_search_record"] = _search_record, (
    "SELECT max(snapshot_date) AS snapshot_date, 'credit_model_' || replace(CAST(max(snapshot_date) AS VARCHAR), '-', '_') AS model_version, "
    + ", ".join(f"CAST(count_if(split = '{p}') AS BIGINT) AS n_{p}" for p in learn.PARTS) + ", "
    + ", ".join(q.half_up(f"avg(CASE WHEN split = '{p}' THEN label END)", 2) + f" AS bad_share_{p}" for p in learn.PARTS)
    + f" FROM ({_SPLIT_ROWS})")
ENTRIES["l5_auc"] = (
    lambda t: auc(t("doc_scores"), "label", "score").withColumn("gini", gini(c("auc"))),
    f"SELECT *, {q.half_up('(2 * auc - 1)', 3)} AS gini FROM ({q.area('doc_scores', 'label', 'score')})")
ENTRIES["l5_auc_by_snapshot"] = (
    lambda t: auc(joins.label_predictions(t("loan_labels"), t("scores")), "label", "model_predictions", [SNAPSHOT]),
    q.area("scored_labels", "label", "model_predictions", "snapshot_date"))
_SCORED = "SELECT Customer_ID, snapshot_date, 'credit_model_2024_{}' AS model_name FROM {}"


def _keys(scores):
    """What SQL can say of scores: whose they are. A score that is not strictly between 0 and 1 loses its row."""
    sound = (c("model_predictions") > 0) & (c("model_predictions") < 1)
    return cut_lineage(scores, "scores").where(sound).select("Customer_ID", SNAPSHOT, "model_name")


def _batch_scores(t: Tables):
    return learn.score(filled_features(t.engagement, t.risk, backward=True), _fit(_staged_rows(t)), "credit_model_2024_12_01")


def _click_scores(t: Tables):
    """Train on raw click counts in fixed periods before a date, score the click counts of all months."""
    clicks = t("clickstream_raw")
    features = columns_with_prefix(clicks, "fe_")
    rows = learn.period_split(
        joins.training_rows(t("loan_labels"), clicks), "2024-07-01", LOAN_KEY, train_months=4, oot_months=2)
    return learn.score(clicks, learn.fit_trees(_train(rows), features, LOAN_KEY), "credit_model_2024_07_01")


ENTRIES["l6_batch_score"] = _batch_scores, None
ENTRIES["l6_batch_score_keys"] = lambda t: _keys(_batch_scores(t)), _SCORED.format("12_01", "feature_set")
ENTRIES["l6_batch_score_clicks"] = _click_scores, None
ENTRIES["l6_batch_score_clicks_keys"] = lambda t: _keys(_click_scores(t)), _SCORED.format("07_01", "clickstream_raw")


ENTRIES["l7_performance_ceiling"] = lambda t: learn.performance_ceiling(_training_rows(t), FEATURES, LOAN_KEY), None
_DATED = f"""(SELECT m.as_of, r.* FROM ({_training_sql(q.both_filled)}) r JOIN
  (SELECT DISTINCT snapshot_date AS as_of FROM ({_training_sql(q.both_filled)})) m ON r.snapshot_date <= m.as_of)"""
ENTRIES["l7_rows_as_of"] = (
    lambda t: learn.rows_as_of(cut_lineage(_training_rows(t), "training-rows"), LOAN_KEY).groupBy("as_of", "split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("positives")),
    "SELECT as_of, split, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives FROM (SELECT as_of, label, 'oot' AS split "
    f"FROM {_DATED} WHERE snapshot_date = as_of UNION ALL SELECT as_of, label, split FROM ("
    + q.stratified(f"(SELECT * FROM {_DATED} WHERE snapshot_date < as_of)", LOAN_KEY, "as_of, label") + ")) GROUP BY as_of, split")


def _round_trip(t: Tables):
    """A model and its record saved and loaded: every row gets the score it had."""
    path, rows = t.scratch("model"), _staged_rows(t)
    record = t("loan_labels").agg(F.max(SNAPSHOT).alias(SNAPSHOT), F.count(F.lit(1)).alias("n_labels"))
    saved = _fit(rows)
    save_trees(t.spark, saved, record, path)
    loaded, read = load_trees(t.spark, path)
    scored = with_probability(cut_lineage(with_probability(rows, saved, "before"), "scored-rows"), loaded, "after")
    counts = scored.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(c("after") == c("before")).alias("n_same"))
    return counts.crossJoin(F.broadcast(read))  # one row each


ENTRIES["s11_model_round_trip"] = _round_trip, (
    f"SELECT n_rows, n_rows AS n_same, snapshot_date, n_labels FROM (SELECT count(*) AS n_rows FROM ({_SPLIT_ROWS})) "
    "CROSS JOIN (SELECT max(snapshot_date) AS snapshot_date, count(*) AS n_labels FROM loan_labels)")


# --- monitoring ---
def _psi(t: Tables, value):
    scores = t("scores").withColumn("model_predictions", value)
    return drift.psi(scores, "model_predictions", ["model_name"]).withColumn("psi", F.round("psi", 9))


_TEXT = "CASE WHEN Customer_ID LIKE '%7' THEN 'n/a' ELSE CAST(model_predictions AS STRING) END"
_FEW = "CASE WHEN model_predictions > 2 THEN 1.0E0 ELSE 0.0E0 END"
ENTRIES["mo1_stability_index"] = (
    lambda t: _psi(t, c("model_predictions")), q.stability("scores", "model_predictions"))
ENTRIES["mo2_numeric_coercion"] = lambda t: _psi(t, F.expr(_TEXT)), q.stability("scores", _TEXT)
ENTRIES["mo3_too_few_values"] = lambda t: _psi(t, F.expr(_FEW)), q.stability("scores", _FEW)
ENTRIES["mo4_drift_status"] = (
    lambda t: _psi(t, c("model_predictions")).select(
        "model_name", SNAPSHOT, drift.drift_status(c("psi")).alias("drift_status")),
    "SELECT model_name, snapshot_date, CASE WHEN psi > 0.25 THEN 'major shift' WHEN psi IS NOT NULL THEN "
    f"'within range' END AS drift_status FROM ({q.stability('scores', 'model_predictions')})")
_AREAS = q.area("scored_labels", "label", "model_predictions", "snapshot_date")
ENTRIES["mo5_performance_status"] = (
    lambda t: t("scores").select(SNAPSHOT).distinct().join(
        auc(joins.label_predictions(t("loan_labels"), t("scores")), "label", "model_predictions", [SNAPSHOT]),
        SNAPSHOT, "left").select(SNAPSHOT, "auc", drift.performance_status(c("auc")).alias("performance_status")),
    "SELECT s.snapshot_date, auc, CASE WHEN auc < 0.65 THEN 'retraining needed' WHEN auc IS NOT NULL THEN "
    "'performance ok' ELSE 'labels not available' END AS performance_status "
    f"FROM (SELECT DISTINCT snapshot_date FROM scores) s LEFT JOIN ({_AREAS}) a ON s.snapshot_date = a.snapshot_date")


def _bars(cols: list[str], source: str, bins: int) -> str:
    long = " UNION ALL ".join(
        f"SELECT snapshot_date, '{n}' AS feature, CAST({n} AS DOUBLE) AS v FROM {source} WHERE {n} IS NOT NULL" for n in cols)
    return f"""
WITH long AS ({long}),
extent AS (SELECT feature, min(v) AS low, (max(v) - min(v)) / {bins} AS width FROM long GROUP BY feature),
bars AS (SELECT snapshot_date, l.feature, CAST(coalesce(least(floor((v - low) / NULLIF(width, 0)), {bins - 1}), 0) AS INT) AS bin,
  low, width, count(*) AS n FROM long l JOIN extent x ON l.feature = x.feature GROUP BY ALL)"""


ENTRIES["mo6_histogram"] = (
    lambda t: drift.histogram(cut_lineage(t.risk, "risk"), RISK_FEATURES, [SNAPSHOT]),
    _bars(RISK_FEATURES, "risk", 500) + " SELECT * FROM bars")


def _density(df, cols):
    out = drift.density(df, cols, [SNAPSHOT])
    return out.select(SNAPSHOT, "feature", "point", F.round("x", 6).alias("x"), F.round("density", 6).alias("density"))


_KERNEL = """,
centred AS (SELECT *, low + (bin + 0.5) * width AS centre FROM bars),
sized AS (SELECT snapshot_date, feature, sum(n) AS n_rows, sum(n * centre) / sum(n) AS mean, min(centre) AS first, max(centre) AS last
  FROM centred GROUP BY ALL),
banded AS (SELECT z.*, sqrt(v / (n_rows - 1)) * pow(n_rows, -0.2) AS h FROM sized z JOIN (
  SELECT b.snapshot_date, b.feature, sum(n * pow(centre - mean, 2)) AS v FROM centred b JOIN sized z
    ON b.snapshot_date = z.snapshot_date AND b.feature = z.feature GROUP BY ALL) w
  ON z.snapshot_date = w.snapshot_date AND z.feature = w.feature WHERE n_rows > 1 AND v > 0),
grid AS (SELECT *, CAST(unnest(generate_series(0, 99)) AS INT) AS point FROM banded),
placed AS (SELECT *, (first - 3 * h) + ((last + 3 * h) - (first - 3 * h)) * point / 99 AS x FROM grid)
SELECT p.snapshot_date, p.feature, point, round(x, 6) AS x,
  round(sum(n * exp(-pow((x - centre) / h, 2) / 2)) / (n_rows * h * sqrt(2 * pi())), 6) AS density
FROM placed p JOIN centred b ON p.snapshot_date = b.snapshot_date AND p.feature = b.feature
GROUP BY p.snapshot_date, p.feature, point, x, n_rows, h"""
ENTRIES["mo6_density"] = (
    lambda t: _density(t.clicks, q.CLICKS), _bars(q.CLICKS, "clickstream_silver", 500) + _KERNEL)
ENTRIES["mo6_engagement_density"] = (
    lambda t: _density(t.engagement, CLICK_FEATURES), _bars(CLICK_FEATURES, "engagement", 500) + _KERNEL)
ENTRIES["mo6_prediction_density"] = (
    lambda t: _density(t("scores"), ["model_predictions"]), _bars(["model_predictions"], "scores", 500) + _KERNEL)
_BOXES = RISK_FEATURES
ENTRIES["mo7_five_numbers"] = (
    lambda t: five_numbers(joins.training_rows(t("loan_labels"), t.risk), _BOXES, ["label"]),
    "SELECT label, feature, min(v) AS minimum, "
    + ", ".join(f"{q.quantile('v', p)} AS {n}" for n, p in (
        ("lower_quartile", "0.25E0"), ("median", "0.5E0"), ("upper_quartile", "0.75E0")))
    + ", max(v) AS maximum FROM ("
    + " UNION ALL ".join(
        f"SELECT label, '{n}' AS feature, CAST({n} AS DOUBLE) AS v FROM loan_labels l JOIN risk r "
        "ON l.Customer_ID = r.Customer_ID AND l.snapshot_date = r.snapshot_date" for n in _BOXES)
    + ") WHERE v IS NOT NULL GROUP BY label, feature")


# --- stores of predictions and metrics ---
def _prediction_store(t: Tables):
    path = t.scratch("predictions")
    store.write_predictions(t("scores"), path)
    return store.scan_table(t.spark, path)


ENTRIES["s8_prediction_store"] = _prediction_store, "SELECT * FROM scores"


def _metric_store(t: Tables):
    path = t.scratch("metrics")
    store.write_metrics(_monitoring(t), path)
    return store.scan_table(t.spark, path)


def _monitoring(t: Tables):
    return monitoring(t("scores"), t("loan_labels")).withColumn("predict_psi", F.round("predict_psi", 9))


_MONITORING = f"""
SELECT p.model_name, p.snapshot_date, psi AS predict_psi, auc AS roc_auc,
  CASE WHEN psi > 0.25 THEN 'major shift' WHEN psi IS NOT NULL THEN 'within range' END AS drift_status,
  CASE WHEN auc < 0.65 THEN 'retraining needed' WHEN auc IS NOT NULL THEN 'performance ok' ELSE 'labels not available' END AS performance_status
FROM ({q.stability('scores', 'model_predictions')}) p LEFT JOIN ({_AREAS}) a ON p.snapshot_date = a.snapshot_date"""
ENTRIES["s9_metric_store"] = _metric_store, _MONITORING
ENTRIES["s10_metric_trend"] = (
    lambda t: drift.metric_trend(_metric_store(t)).select(SNAPSHOT, "predict_psi", "roc_auc"),
    f"SELECT snapshot_date, predict_psi, roc_auc FROM ({_MONITORING}) ORDER BY snapshot_date")

# --- gold tables ---
ENTRIES["t1_label_store"] = lambda t: label_store(t("loan_daily")), "SELECT * FROM label_store"
ENTRIES["t2_loan_silver"] = lambda t: t.loan_silver, "SELECT * FROM loan_silver"
ENTRIES["t3_wide_silver"] = (
    lambda t: wide_silver(*t.raw).withColumn("loan_array", F.array_join("loan_array", "|")),
    "SELECT * REPLACE (array_to_string(loan_array, '|') AS loan_array) FROM wide_silver")


def _wide_gold(t: Tables):
    silver = cut_lineage(wide_silver(*t.raw), "wide-silver")  # read by the fit and by the encoding
    return wide_gold(silver, *fit_vocabularies(silver))


ENTRIES["t4_wide_gold"] = (
    _wide_gold,
    f"SELECT * EXCLUDE ({', '.join(VOCABS)}, Type_of_Loan, cleaned_loans, loan_array), "
    + ", ".join(
        f"CAST({n} = '{v}' AS INT) AS {n}_{clean.column_label(v)}" for n, vs in VOCABS.items() for v in vs[1:]) + ", "
    + ", ".join(f"CAST(list_contains(loan_array, '{v}') AS INT) AS {clean.column_label(v)}"
                for v in LOANS if v != "not specified") + ", "
    + q.named(q.WIDE_FEATURES, "") + " FROM wide_silver")
ENTRIES["t5_clickstream_silver"] = lambda t: t.clicks, "SELECT * FROM clickstream_silver"
ENTRIES["t6_attributes_silver"] = (
    lambda t: attributes_silver(t("attributes_raw")),
    f"SELECT {q.KEY}, {q.NAME} AS Name, {q.AGE_IN_RANGE} AS Age, {q.SSN} AS SSN, {q.OCCUPATION_PLAIN} AS Occupation "
    "FROM attributes_raw")
ENTRIES["t7_financials_silver"] = lambda t: t.financials, "SELECT * FROM financials_silver"
ENTRIES["t8_engagement"] = lambda t: t.engagement, "SELECT * FROM engagement"
ENTRIES["t9_risk"] = lambda t: t.risk, "SELECT * FROM risk"


ENTRIES["t10_training_set"] = (
    lambda t: training_set(t("loan_labels"), t.engagement, t.risk, backward=True), _training_sql(q.both_filled))
ENTRIES["t10_training_set_no_look_ahead"] = (
    lambda t: training_set(t("loan_labels"), t.engagement, t.risk), _training_sql(q.ffilled))


def _predictions(t: Tables):
    """Train on the complete rows, score every customer with risk features, both filled alike."""
    return predictions(t.risk, t.engagement, _fit(_staged_rows(t)), "credit_model_2024_12_01", backward=True)


ENTRIES["t11_predictions"] = _predictions, None
ENTRIES["t11_prediction_keys"] = lambda t: _keys(_predictions(t)), _SCORED.format("12_01", "risk")
ENTRIES["t12_monitoring"] = _monitoring, _MONITORING
