"""Spark ML stages of the training job: features, split, classifier, evaluation."""

from kinesia.ml.classifier import label_converter, mlp
from kinesia.ml.correlation import Pruning, correlations, drop_pruned, moment_matrix, prune_features
from kinesia.ml.evaluate import accuracy, accuracy_frame
from kinesia.ml.features import assembler, category_indexer, fit_labels, label_indexer, scaler, standardize
from kinesia.ml.split import hash_split, random_split, split_position
from kinesia.ml.tree import Tree, fit_tree, load_tree, save_tree, train_tree

__all__ = [
    "Pruning",
    "Tree",
    "accuracy",
    "accuracy_frame",
    "assembler",
    "category_indexer",
    "correlations",
    "drop_pruned",
    "fit_labels",
    "fit_tree",
    "hash_split",
    "label_converter",
    "label_indexer",
    "load_tree",
    "mlp",
    "moment_matrix",
    "prune_features",
    "random_split",
    "save_tree",
    "scaler",
    "split_position",
    "standardize",
    "train_tree",
]
