"""Saving and loading fitted pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F


class ArtifactError(RuntimeError):
    """A saved model cannot be loaded."""


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a fitted pipeline; its output equals that of the model that was saved."""
    try:
        return PipelineModel.load(path)
    except Exception as error:
        raise ArtifactError("Failed to load prediction artifacts") from error


def artifact_present(spark: SparkSession, path: str) -> bool:
    """Is a saved pipeline readable at this path, on whatever file system it names?"""
    try:
        return not spark.read.text(f"{path.rstrip('/')}/metadata").isEmpty()
    except Exception:
        return False


def registry(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """Model registry: one row per disease with model, threshold, features, class map and readiness."""
    rows = [
        (
            e["disease"], e["model"], float(e["threshold"]), len(e["features"]), list(e["features"]),
            {str(k): v for k, v in e["labels"].items()}, artifact_present(spark, e["path"]),
        )
        for e in entries
    ]
    return spark.createDataFrame(
        rows,
        "disease string, model string, threshold double, feature_count int, features array<string>, "
        "class_mapping map<string,string>, model_loaded boolean",
    ).withColumn("status", F.when(F.col("model_loaded"), "ready").otherwise("unavailable"))


def readiness(models: DataFrame) -> DataFrame:
    """One row: are all registered models ready?"""
    return models.agg(
        F.when(F.bool_and("model_loaded"), "ready").otherwise("unavailable").alias("status"),
        F.count_if(F.col("model_loaded")).alias("n_ready"), F.count(F.lit(1)).alias("n_models"),
    )
