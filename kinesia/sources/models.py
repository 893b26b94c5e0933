"""Saved model artifacts."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import StandardScalerModel


def load_pipeline(path: str) -> PipelineModel:
    """Load a saved ``PipelineModel`` (assembler, scaler, indexers, network, converter)."""
    return PipelineModel.load(path)


def load_scaler(path: str) -> StandardScalerModel:
    """Load the scaler that the training job saves beside the pipeline."""
    return StandardScalerModel.load(path)
