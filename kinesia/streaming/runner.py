"""Starting, running and collecting streaming queries."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from contextlib import suppress

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

BATCH_COLUMN = "_batch_id"
STEP_S = 0.5
POLL_S = 5.0  # Spark keeps the progress of the last 100 batches of a query

log = logging.getLogger(__name__)


class LateRows:
    """Rows that the watermark dropped from ``queries``, as far as ``poll`` has seen their batches.

    Spark counts them behind the map-side partial aggregate: the number is of partial
    rows, zero only if no reading was dropped.
    """

    def __init__(self, queries: Sequence[StreamingQuery]):
        self.queries = queries
        self.batches: dict[tuple[str, int], int] = {}

    def poll(self) -> int:
        before = self.total
        for q in self.queries:
            for p in q.recentProgress:
                dropped = sum(op.numRowsDroppedByWatermark for op in p.stateOperators)
                key = (str(q.id), p.batchId)
                self.batches[key] = max(dropped, self.batches.get(key, 0))
        if self.total > before:
            log.warning("the watermark dropped %d rows (%d so far)", self.total - before, self.total)
        return self.total

    @property
    def total(self) -> int:
        return sum(self.batches.values())


def start_outputs(
    frames: Sequence[DataFrame],
    writer: Callable[[DataFrame, int], DataStreamWriter],
    checkpoint_root: str,
    *,
    available_now: bool = False,
) -> list[StreamingQuery]:
    """One query per output, each with its own checkpoint ``<root>/<index>`` (T4).

    ``writer(frame, index)`` returns a configured writer (format, output mode,
    options) — the output mode comes from the caller (T3).
    """
    queries = []
    for i, df in enumerate(frames):
        w = writer(df, i).option("checkpointLocation", f"{checkpoint_root}/{i}")
        if available_now:
            w = w.trigger(availableNow=True)
        queries.append(w.start())
    return queries


def _stop_all_on_failure(queries: Sequence[StreamingQuery]) -> None:
    """Raise if a query has failed, after stopping the others."""
    for q in queries:
        if not q.isActive and q.exception() is not None:
            for other in queries:
                if other.isActive:
                    other.stop()
            raise RuntimeError(f"streaming query {q.name or q.id} failed: {q.exception()}")


def claim_output(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Tie an output folder to the checkpoint that writes it.

    Batch numbers start again in a fresh checkpoint; into an old output it would
    overwrite batches of another run.
    """
    owner = f"{path}/_checkpoint"
    folder = spark._jvm.org.apache.hadoop.fs.Path(owner)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        found = spark.read.text(owner).first()[0]
        if found != checkpoint:
            raise ValueError(f"{path} belongs to the checkpoint {found}, not {checkpoint}")
    else:
        spark.createDataFrame([(checkpoint,)], "value string").coalesce(1).write.text(owner)


def await_any(
    spark: SparkSession, queries: Sequence[StreamingQuery], timeout_ms: int = 0, late: LateRows | None = None
) -> bool:
    """Block until one of ``queries`` ends (T5); ``timeout_ms`` 0 waits forever.

    Returns True if one of them terminated (a failed one stops the others and re-raises),
    False on timeout. Terminations of other queries in the session are ignored: the
    session-wide wait is reset first and resumed if something else woke it.
    ``late`` is polled while waiting, and warns of rows dropped by the watermark.
    """
    deadline = time.monotonic() + timeout_ms / 1000.0 if timeout_ms else None
    while True:
        if late is not None:
            late.poll()
        spark.streams.resetTerminated()
        _stop_all_on_failure(queries)
        if any(not q.isActive for q in queries):
            return True
        remaining = deadline - time.monotonic() if deadline is not None else None
        if remaining is not None and remaining <= 0:
            return any(not q.isActive for q in queries)
        with suppress(StreamingQueryException):
            if late is not None:
                spark.streams.awaitAnyTermination(POLL_S if remaining is None else min(POLL_S, remaining))
            elif remaining is None:
                spark.streams.awaitAnyTermination()
            else:
                spark.streams.awaitAnyTermination(remaining)


def await_all(queries: Sequence[StreamingQuery], timeout_s: float | None = None, late: LateRows | None = None) -> None:
    """Wait for every (``availableNow``) query to finish, then surface failures.

    The outputs of a job stand and fall together: if one query fails the others are stopped,
    and resume from their checkpoints in the next run.
    A query that has not ended after ``timeout_s`` seconds raises ``TimeoutError``.
    With ``late``, rows that the watermark dropped raise ``RuntimeError`` at the end.
    """
    deadline = time.monotonic() + timeout_s if timeout_s is not None else None
    waiting = list(queries)
    while waiting:
        for q in list(waiting):
            with suppress(StreamingQueryException):  # raised below, when the others are stopped
                q.awaitTermination(STEP_S)
            if not q.isActive:
                waiting.remove(q)
        _stop_all_on_failure(queries)
        if late is not None:
            late.poll()
        if waiting and deadline is not None and time.monotonic() >= deadline:
            raise TimeoutError(f"streaming query {waiting[0].name or waiting[0].id} has not ended after {timeout_s} s")
    if late is not None and late.poll():
        raise RuntimeError(
            f"the watermark dropped {late.total} late rows: the output is not whole; "
            "run again with a longer watermark and a new checkpoint"
        )


def parquet_batches(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: each micro-batch to ``<path>/_batch_id=<id>``.

    Overwriting the batch's own folder makes a replayed batch idempotent, so
    update-mode output can land in files and survive restarts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH_COLUMN}={batch_id}")

    return write


def latest_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Merge update-mode batches: per key, the row from the latest batch wins.

    One aggregate keyed by the output key (``max_by`` over the batch id): a
    shuffle on the key, no driver step. Columns keep the batches' order.
    """
    batches = spark.read.parquet(path)
    values = [c for c in batches.columns if c not in set(keys) and c != BATCH_COLUMN]
    latest = batches.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in values]), F.col(BATCH_COLUMN)).alias("_row")
    )
    key_set = set(keys)
    return latest.select(
        *[F.col(c) if c in key_set else F.col(f"_row.{c}").alias(c) for c in batches.columns if c != BATCH_COLUMN]
    )
