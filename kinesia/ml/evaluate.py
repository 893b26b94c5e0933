"""Accuracy (M11)."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy_frame(
    df: DataFrame, label_col: str = "indexedLabel", prediction_col: str = "prediction"
) -> DataFrame:
    """One-row frame: share of rows where label equals prediction, and the row count.

    A global aggregate with partial sums per task; nothing but two numbers
    per task moves.
    """
    hit = F.when(F.col(label_col).cast("double") == F.col(prediction_col).cast("double"), 1.0).otherwise(0.0)
    return df.agg(F.avg(hit).alias("accuracy"), F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, label_col: str = "indexedLabel", prediction_col: str = "prediction") -> float:
    """Spark ML's multiclass accuracy, as the reference printed it."""
    evaluator = MulticlassClassificationEvaluator(
        labelCol=label_col, predictionCol=prediction_col, metricName="accuracy"
    )
    return float(evaluator.evaluate(df))
