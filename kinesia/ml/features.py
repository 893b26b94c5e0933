"""Feature stages (M1-M5): assemble, standardise, index labels and categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import (
    StandardScaler,
    StandardScalerModel,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
    VectorIndexer,
)
from pyspark.sql import DataFrame


def assembler(features: Sequence[str], output_col: str = "nonScaledFeatures") -> VectorAssembler:
    """Features into one vector column (M1); a NULL feature raises, as in the reference."""
    return VectorAssembler(inputCols=list(features), outputCol=output_col, handleInvalid="error")


def scaler(input_col: str = "nonScaledFeatures", output_col: str = "features") -> StandardScaler:
    """Mean 0, sample standard deviation 1 per feature (M2)."""
    return StandardScaler(inputCol=input_col, outputCol=output_col, withMean=True, withStd=True)


def standardize(
    df: DataFrame, input_col: str, output_col: str = "features"
) -> tuple[StandardScalerModel, DataFrame]:
    """Fit the scaler on ``df`` (one distributed summary pass) and apply it (M2)."""
    model = scaler(input_col, output_col).fit(df)
    return model, model.transform(df)


def label_indexer(label: str, output_col: str = "indexedLabel") -> StringIndexer:
    """Label text to 0..k-1, most frequent first, ties alphabetical (M3).

    Fitting is a count per label value: partial counts per task, one small
    shuffle; only the k distinct labels reach the driver.
    """
    return StringIndexer(
        inputCol=label, outputCol=output_col, stringOrderType="frequencyDesc", handleInvalid="error"
    )


def fit_labels(df: DataFrame, label: str, output_col: str = "indexedLabel") -> StringIndexerModel:
    """Fitted label indexer; ``model.labels`` lists the classes in index order (M3, M4)."""
    return label_indexer(label, output_col).fit(df)


def category_indexer(
    input_col: str = "features", output_col: str = "indexedFeatures", max_categories: int = 10
) -> VectorIndexer:
    """Re-code features with at most ``max_categories`` distinct values to 0..k-1 (M5).

    A value 0.0, when present, keeps index 0; the others follow in ascending
    order. Each task keeps at most ``max_categories + 1`` values per feature, so
    the fit's state is bounded whatever the data size. A value not met when fitting
    gets the index after the last one, so a rare hold-out or stream value is scored.
    """
    return VectorIndexer(
        inputCol=input_col, outputCol=output_col, maxCategories=max_categories, handleInvalid="keep"
    )
