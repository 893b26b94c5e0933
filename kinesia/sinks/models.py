"""Model artifacts (K7, K8)."""

from __future__ import annotations

from pyspark.ml.util import MLWritable


def save_model(model: MLWritable, path: str) -> str:
    """Save a fitted model or pipeline, replacing what is there (K7, K8)."""
    model.write().overwrite().save(path)
    return path
