"""Fitted pipelines on disk, all stages included."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str) -> None:
    """Overwrite the model stored at ``path``."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a model that scores raw feature rows."""
    return PipelineModel.load(path)
