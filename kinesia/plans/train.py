"""Training job (J2): bucket means -> scaled features -> multilayer perceptron."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScalerModel, StringIndexerModel
from pyspark.sql import DataFrame

from kinesia.ml.classifier import label_converter, mlp
from kinesia.ml.evaluate import accuracy
from kinesia.ml.features import assembler, category_indexer, fit_labels, scaler
from kinesia.ml.split import hash_split
from kinesia.schema import FEATURES, LABEL
from kinesia.session import shared_dir
from kinesia.sinks.files import write_outputs, write_single_file
from kinesia.sinks.models import save_model
from kinesia.sources.parquet import read_parquet

# Columns the reference drops before writing the hold-out predictions (K6).
DROPPED_FROM_RESULTS = ("features", "indexedLabel", "indexedFeatures", "rawPrediction", "probability", "prediction")


@dataclass
class TrainResult:
    model: PipelineModel
    predictions: DataFrame
    labels: list[str]
    train: DataFrame
    test: DataFrame

    @property
    def scorer(self) -> PipelineModel:
        return scoring_model(self.model)

    def accuracy(self) -> float:
        return accuracy(self.predictions)


def scoring_model(model: PipelineModel) -> PipelineModel:
    """The fitted pipeline without its label indexer, for data that has no label
    or labels never seen in training (a live stream)."""
    return PipelineModel(stages=[s for s in model.stages if not isinstance(s, StringIndexerModel)])


def fitted_scaler(model: PipelineModel) -> StandardScalerModel:
    return next(s for s in model.stages if isinstance(s, StandardScalerModel))


def hold_out_results(predictions: DataFrame) -> DataFrame:
    """Hold-out predictions as the reference stored them (K6 projection)."""
    return predictions.drop(*DROPPED_FROM_RESULTS)


def train(
    df: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
    *,
    hidden: Sequence[int] = (8,),
    max_iter: int = 200,
    block_size: int = 128,
    seed: int = 1,
    train_fraction: float = 0.9,
    split_key: Sequence[str] | str | None = None,
    max_categories: int | None = None,
    out_dir: str | None = None,
    single_file_results: bool = False,
    cut_lineage: bool = False,
) -> TrainResult:
    """Fit label indexer, assembler, scaler, category indexer, network and converter.

    The label indexer sees every row, so no hold-out label is unseen; assembler,
    scaler and category indexer are pipeline stages fitted on the training part
    only (the reference fitted them before the split). The split is a hash of
    ``split_key`` (default: all selected columns), so it survives recomputation.
    The iterative fit runs over Spark ML's own cached copy of the stacked
    training vectors; with ``cut_lineage`` the input is first written as Parquet to
    the shared folder and read back, so a lost executor's partitions are re-read
    from there instead of recomputed from the raw scan (use it when ``df`` is a
    derived aggregate rather than a Parquet table). The label indexer brings the
    distinct labels to the driver: they are the network's output layer.

    With ``out_dir``: model to ``<out>/model`` (K7), scaler to ``<out>/scaler`` (K8),
    hold-out predictions to ``<out>/test_results`` (K6). ``single_file_results``
    writes them as one file like the reference; that runs the write in one task,
    so it is off by default.
    """
    features = list(features)
    data = df.select(*features, label) if split_key is None else df
    if cut_lineage:
        staged = shared_dir(data.sparkSession, "train-input")
        write_outputs([data], [staged])
        data = read_parquet(data.sparkSession, staged)
    labels_model = fit_labels(data, label)
    labels = list(labels_model.labels)
    key = split_key if split_key is not None else [*features, label]
    train_df, test_df = hash_split(data, key, train_fraction, seed)
    stages = [
        labels_model,
        assembler(features),
        scaler(),
        category_indexer(max_categories=max_categories or len(features)),
        mlp(len(features), len(labels), hidden=hidden, max_iter=max_iter, block_size=block_size, seed=seed),
        label_converter(labels),
    ]
    # No persist here: the network caches its own stacked copy of the input
    # (measured: each input row is evaluated once over all iterations), and
    # the two scaler/indexer passes before it re-read Parquet or the checkpoint.
    # A second cached copy of the training set would double executor memory.
    model = Pipeline(stages=stages).fit(train_df)
    predictions = model.transform(test_df)
    if out_dir:
        save_model(model, f"{out_dir}/model")
        save_model(fitted_scaler(model), f"{out_dir}/scaler")
        results, path = hold_out_results(predictions), f"{out_dir}/test_results"
        if single_file_results:
            write_single_file(results, path)
        else:
            write_outputs([results], [path])
    return TrainResult(model, predictions, labels, train_df, test_df)


__all__ = ["TrainResult", "fitted_scaler", "hold_out_results", "scoring_model", "train"]
