"""Correlation of features with each other and with the target, and pruning by it.

One pass over the rows gives a moment matrix: for every pair of columns the number of
rows that have both, their two means and the centred sums of squares and products. Such
matrices merge exactly as pairwise means do, so each task keeps one, however many rows
it reads; a fixed number of merge groups brings them together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MERGE_GROUPS = 64
_MOMENTS = "part long, task long, moments binary"


class Moments:
    """Pairwise moments of ``p`` columns: n, mean of the row's column, and centred sums, each p x p."""

    def __init__(self, p: int):
        # n[i, j]: rows with both; mean[i, j]: mean of i over them; square[i, j]: centred squares of i; product: of i and j
        self.n, self.mean, self.square, self.product = (np.zeros((p, p)) for _ in range(4))

    def add(self, values: np.ndarray) -> Moments:
        """Rows of a batch (NaN: missing)."""
        have = ~np.isnan(values)
        own = Moments(values.shape[1])
        present, x = have.astype(float), np.where(have, values, 0.0)
        shift = x.sum(0) / np.maximum(present.sum(0), 1)  # keeps the sums of squares from cancelling
        x = np.where(have, x - shift, 0.0)
        own.n = present.T @ present
        total = x.T @ present
        count = np.maximum(own.n, 1)
        own.mean = total / count
        own.square = (x * x).T @ present - own.mean * total
        own.product = x.T @ x - own.mean * own.mean.T * own.n
        own.mean = np.where(own.n > 0, own.mean + shift[:, None], 0.0)
        return self.merge(own)

    def merge(self, other: Moments) -> Moments:
        n = self.n + other.n
        count = np.maximum(n, 1)
        apart = other.mean - self.mean
        weight = self.n * other.n / count
        self.square += other.square + apart * apart * weight
        self.product += other.product + apart * apart.T * weight
        self.mean += apart * other.n / count
        self.n = n
        return self

    def packed(self) -> bytes:
        return np.stack([self.n, self.mean, self.square, self.product]).tobytes()

    @classmethod
    def unpacked(cls, data: bytes, p: int) -> Moments:
        out = cls(p)
        out.n, out.mean, out.square, out.product = np.frombuffer(data).reshape(4, p, p).copy()
        return out

    def correlation(self) -> np.ndarray:
        """Pearson's r of each pair over the rows that have both; NaN below two such rows or for a constant column."""
        constant = (self.square <= 0) | (self.square <= 1e-24 * self.n * self.mean**2)  # only rounding differs
        with np.errstate(invalid="ignore", divide="ignore"):
            r = self.product / np.sqrt(self.square * self.square.T)
        return np.where((self.n < 2) | constant | constant.T, np.nan, np.clip(r, -1, 1))


def moment_matrix(df: DataFrame, columns: Sequence[str]) -> Moments:
    """The moments of ``columns`` in one pass. NULL, NaN and infinite values are missing.

    Tasks keep p x p numbers; ``MERGE_GROUPS`` groups merge them, then one task the groups.
    What reaches the driver depends on the number of columns only. Merging goes by
    task number, so a rerun over the same splits gives the same digits.
    """
    p = len(columns)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, task = Moments(p), TaskContext.get().partitionId()
        for batch in batches:
            values = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float) if batch.num_rows else np.empty((0, p))
            found.add(np.where(np.isfinite(values), values, np.nan))
        yield pa.RecordBatch.from_arrays([pa.array([task % MERGE_GROUPS]), pa.array([task]), pa.array([found.packed()], pa.binary())], ["part", "task", "moments"])

    def merged(table: pa.Table) -> pa.Table:
        rows, found = table.sort_by("task"), Moments(p)
        for data in rows["moments"].to_pylist():
            found.merge(Moments.unpacked(data, p))
        return pa.table({"part": pa.array([0], pa.int64()), "task": pa.array(rows["task"].to_pylist()[:1], pa.int64()), "moments": pa.array([found.packed()], pa.binary())})

    rows = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    parts = rows.mapInArrow(partial, _MOMENTS).groupBy("part").applyInArrow(merged, _MOMENTS)
    whole = parts.groupBy("part").applyInArrow(merged, _MOMENTS).first()
    return Moments.unpacked(bytes(whole["moments"]), p) if whole else Moments(p)


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per pair of columns in their order: feature_a, feature_b, n, correlation.

    Pairs use the rows that have both values. The correlation is NULL with fewer than
    two such rows, or if one of the columns is constant over them.
    """
    found = moment_matrix(df, columns)
    r = found.correlation()
    rows = [
        (a, b, int(found.n[i, j]), None if np.isnan(r[i, j]) else float(r[i, j]))
        for i, a in enumerate(columns) for j, b in enumerate(columns) if i < j
    ]
    return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, n long, correlation double")


def correlation_ratios(df: DataFrame, columns: Sequence[str], label: str) -> dict[str, float]:
    """Correlation ratio (eta) of each column with a label: the root of the share of its variance between labels.

    Two aggregates with a row per label in between, none on the driver. NULL labels and
    values are left out. 0 for a constant column and for one label.
    """
    known = df.where(F.col(label).isNotNull()).select(label, *[F.col(c).cast("double").alias(c) for c in columns])
    aggs = [f(F.when(~F.isnan(c), F.col(c))).alias(f"{c}_{name}") for c in columns for f, name in ((F.count, "n"), (F.avg, "m"), (F.var_pop, "v"))]
    groups = known.groupBy(label).agg(*aggs)
    sums = []
    for c in columns:
        n, m, v = F.col(f"{c}_n"), F.col(f"{c}_m"), F.col(f"{c}_v")
        sums += [F.sum(n * v).alias(f"{c}_within"), F.sum(n).alias(f"{c}_n"), F.var_pop(m).alias(f"{c}_spread")]
        sums += [F.sum(n * m).alias(f"{c}_s"), F.sum(n * m * m).alias(f"{c}_q")]
    row = groups.agg(*sums).first()
    out = {}
    for c in columns:
        n, within = row[f"{c}_n"] or 0, row[f"{c}_within"] or 0.0
        between = max((row[f"{c}_q"] or 0.0) - (row[f"{c}_s"] or 0.0) ** 2 / n, 0.0) if n and row[f"{c}_spread"] else 0.0
        out[c] = float(np.sqrt(between / (between + within))) if between + within > 0 else 0.0
    return out


@dataclass
class Pruning:
    """What to do with a feature, and why."""

    feature: str
    target_correlation: float | None
    label_ratio: float
    kept: bool
    reason: str  # "kept", "no trend" or "like <feature>"


DIGITS = 6  # decisions are taken on rounded figures, so the last bits of a sum never decide


def prune_features(
    df: DataFrame,
    features: Sequence[str],
    *,
    target: str | None = None,
    label: str | None = None,
    least_trend: float = 0.05,
    most_alike: float = 0.95,
) -> list[Pruning]:
    """Which features to keep, in their order.

    A feature without a trend goes: one whose correlation with ``target`` and whose
    correlation ratio with ``label`` are both below ``least_trend``. A feature that is constant
    or missing everywhere has none. Of two features whose correlation is ``most_alike`` or
    more, either sign, the one with the weaker trend goes (equal trends: the later one).
    Pairs are taken from the most alike down, equal ones in feature order; a
    feature that has gone drops no other. Without target and label only likeness counts.
    """
    columns = [*features, *([target] if target else [])]
    found = moment_matrix(df, columns)
    r = np.round(found.correlation(), DIGITS)
    ratios = correlation_ratios(df, features, label) if label else {}
    to_target = [None if target is None or np.isnan(r[i, -1]) else float(r[i, -1]) for i in range(len(features))]
    trend = [max(abs(to_target[i] or 0.0), round(ratios.get(f, 0.0), DIGITS)) for i, f in enumerate(features)]
    constant = [np.isnan(r[i, i]) for i in range(len(features))]
    reason = {}
    for i, f in enumerate(features):
        if constant[i] or ((target or label) and trend[i] < least_trend):
            reason[f] = "no trend"
    pairs = [(-abs(r[i, j]), i, j) for i in range(len(features)) for j in range(i + 1, len(features)) if abs(r[i, j]) >= most_alike]
    for _, i, j in sorted(pairs):
        a, b = features[i], features[j]
        if a in reason or b in reason:
            continue
        loser, winner = (a, b) if trend[i] < trend[j] else (b, a)
        reason[loser] = f"like {winner}"
    return [Pruning(f, to_target[i], round(ratios.get(f, 0.0), DIGITS), f not in reason, reason.get(f, "kept")) for i, f in enumerate(features)]


def drop_pruned(df: DataFrame, prunings: Sequence[Pruning]) -> DataFrame:
    """``df`` without the features that went."""
    return df.drop(*[p.feature for p in prunings if not p.kept])
