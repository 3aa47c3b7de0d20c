"""Persisted classifiers and their training history."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def save_model(model: PipelineModel, path: str) -> None:
    """Save the fitted stages. The labels travel inside the label indexer."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def write_history(history: DataFrame, path: str) -> None:
    """One row per epoch. The row count is the number of epochs, so one file is enough."""
    history.coalesce(1).write.mode("overwrite").parquet(path)
