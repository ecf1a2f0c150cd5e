"""Model artefacts: the fitted pipeline and its one-row record, side by side."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_model(model: PipelineModel, record: DataFrame, path: str) -> None:
    """Replace the artefact at ``path``."""
    model.write().overwrite().save(f"{path}/pipeline")
    record.write.mode("overwrite").parquet(f"{path}/record")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, DataFrame]:
    """The pipeline and its record."""
    return PipelineModel.load(f"{path}/pipeline"), spark.read.parquet(f"{path}/record")
