"""Classifier stages (M7, M8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import IndexToString


def mlp(
    num_features: int,
    num_classes: int,
    *,
    hidden: Sequence[int] = (8,),
    max_iter: int = 200,
    block_size: int = 128,
    seed: int = 1,
    label_col: str = "indexedLabel",
    features_col: str = "indexedFeatures",
) -> MultilayerPerceptronClassifier:
    """Feed-forward network ``[features, *hidden, classes]`` trained with L-BFGS (M7).

    Each iteration is one distributed pass: gradients are summed per partition
    and tree-aggregated, so the driver only ever holds the weight vector.
    Seeded, so two runs on the same data agree.
    """
    return MultilayerPerceptronClassifier(
        layers=[num_features, *hidden, num_classes],
        labelCol=label_col,
        featuresCol=features_col,
        blockSize=block_size,
        maxIter=max_iter,
        seed=seed,
    )


def label_converter(
    labels: Sequence[str], input_col: str = "prediction", output_col: str = "predictedLabel"
) -> IndexToString:
    """Predicted index back to label text (M8)."""
    return IndexToString(inputCol=input_col, outputCol=output_col, labels=list(labels))
