"""The suite's jobs: preprocess (J1), train (J2), stream (J3) and their runners."""

from kinesia.plans.preprocess import preprocess
from kinesia.plans.stream import passthrough, score_stream, stream_preprocess
from kinesia.plans.train import TrainResult, hold_out_results, scoring_model, train

__all__ = [
    "TrainResult",
    "passthrough",
    "preprocess",
    "score_stream",
    "scoring_model",
    "stream_preprocess",
    "hold_out_results",
    "train",
]
