"""Training set, predictions and monitoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tallyhouse.functions.schema import CUSTOMER, SNAPSHOT
from tallyhouse.operators.drift import drift_status, performance_status, psi
from tallyhouse.operators.impute import complete_rows, ffill_bfill
from tallyhouse.operators.joins import feature_set, label_predictions, scoring_set, training_rows
from tallyhouse.operators.learn import score
from tallyhouse.operators.periods import in_period
from tallyhouse.operators.ranks import auc
from tallyhouse.plans.features import MODEL_FEATURES


def filled_features(
    engagement: DataFrame, risk: DataFrame, backward: bool = False, features: Sequence[str] = tuple(MODEL_FEATURES),
) -> DataFrame:
    """Engagement and risk of all snapshots, gaps filled along each customer's history."""
    return ffill_bfill(feature_set(engagement, risk), features, [CUSTOMER], SNAPSHOT, backward)


def training_set(
    labels: DataFrame, engagement: DataFrame, risk: DataFrame, low: str | None = None, high: str | None = None,
    backward: bool = False, features: Sequence[str] = tuple(MODEL_FEATURES),
) -> DataFrame:
    """Complete labelled rows between two snapshots.

    ``backward`` also fills gaps from later snapshots. That looks ahead, so it is off unless asked for.
    """
    if low is not None and high is not None:
        labels, engagement, risk = (in_period(t, low, high) for t in (labels, engagement, risk))
    return complete_rows(training_rows(labels, filled_features(engagement, risk, backward, features)))


def predictions(
    risk: DataFrame, engagement: DataFrame, model: PipelineModel, model_name: str, backward: bool = False,
    features: Sequence[str] = tuple(MODEL_FEATURES),
) -> DataFrame:
    """Scores of all customers with risk features. ``backward`` is the one the model's training set was made with."""
    filled = ffill_bfill(scoring_set(risk, engagement), features, [CUSTOMER], SNAPSHOT, backward)
    return score(filled, model, model_name)


def monitoring(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """Per model and snapshot: stability of the predictions, AUC against the labels, and both alerts."""
    keys = ["model_name", SNAPSHOT]
    drift = psi(scores, "model_predictions", ["model_name"]).select(*keys, F.col("psi").alias("predict_psi"))
    areas = auc(label_predictions(labels, scores), "label", "model_predictions", keys).select(
        *keys, F.col("auc").alias("roc_auc"))
    return drift.join(areas, keys, "left").withColumns({
        "drift_status": drift_status(F.col("predict_psi")),
        "performance_status": performance_status(F.col("roc_auc"))})
