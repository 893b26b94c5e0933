"""Bucket means on a stream with bounded state, nothing lost to lateness.

Two queries under one folder, run in turn over what has landed:

* *route* reduces the raw rows and writes each micro-batch to ``readings``, split into rows in time
  and late ones. A row is late if its bucket had closed, ``lateness`` behind the latest
  reading of all earlier micro-batches;
* *close* aggregates the rows in time in watermarked windows, append mode: a bucket's sums go to
  ``closed`` once, when the watermark passes it, and its state is evicted. The state
  holds open buckets only, however long the stream runs.

``merged`` adds up closed buckets, late rows and the buckets still open: the same
means that the batch job gives for all that has landed, in whatever order it came.

Each micro-batch overwrites its own folder and ``close`` starts when ``route`` has ended, so a
batch that is repeated after a stop or a lost driver is written and counted once.
Checkpoints lie in the same folder: a fresh folder is a fresh stream.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kinesia.functions.time import bucket_index, time_tick
from kinesia.operators.filters import drop_empty_rows
from kinesia.operators.projections import with_magnitudes
from kinesia.schema import BUCKET_TIME_TYPE, FEATURES, KEY_COLUMNS, MISSING, OUTPUT_COLUMNS, TICKS_PER_SECOND
from kinesia.streaming.runner import BATCH_COLUMN, LateRows, await_all, parquet_batches
from kinesia.streaming.windows import EVENT_TIME, event_time

KEYS = ("user_id", "activity_id")
BUCKET, LATE, ENDS = "bucket", "late", "_bucket_end"


def reduced_readings(stream: DataFrame, sentinel: str = MISSING) -> DataFrame:
    """Raw rows as the bucket means take them: magnitudes, no empty row, no NULL key or time."""
    reduced = with_magnitudes(drop_empty_rows(stream, KEY_COLUMNS, sentinel), sentinel=sentinel)
    present = F.col("timestamp").isNotNull()
    for k in KEYS:
        present = present & F.col(k).isNotNull()
    return reduced.where(present).select("timestamp", *KEYS, *FEATURES)


@dataclass
class BucketStream:
    """The tables of one stream under ``path``; buckets are ``width`` ticks wide."""

    spark: SparkSession
    path: str
    width: int
    lateness_seconds: float
    sentinel: str = MISSING
    time_type: T.DataType = BUCKET_TIME_TYPE

    @property
    def _width_ms(self) -> int:
        return self.width * (1000 // TICKS_PER_SECOND)

    @property
    def _lateness_ms(self) -> int:
        return int(self.lateness_seconds * 1000)

    # ------------------------------------------------------------ route

    def _mark(self, batch_id: int) -> int | None:
        """Latest reading (ms) of the micro-batches up to this one."""
        if batch_id < 0:
            return None
        row = self.spark.read.schema("mark long").parquet(f"{self.path}/marks/{BATCH_COLUMN}={batch_id}").first()
        return row["mark"] if row else None

    def _routed(self, batch: DataFrame, batch_id: int) -> None:
        before = self._mark(batch_id - 1)
        at = event_time("timestamp")
        ends = (bucket_index(time_tick("timestamp"), self.width) + 1) * F.lit(self._width_ms)
        rows = batch.withColumns({EVENT_TIME: at, ENDS: ends})
        late = F.col(ENDS) <= F.lit(before - self._lateness_ms) if before is not None else F.lit(False)
        folder = f"{self.path}/readings/{BATCH_COLUMN}={batch_id}"
        rows = rows.withColumn(LATE, late.cast("int"))
        rows.write.mode("overwrite").partitionBy(LATE).parquet(folder)
        written = self.spark.read.schema(rows.schema).parquet(folder)
        latest = written.agg(F.max(F.unix_millis(EVENT_TIME))).first()[0]
        mark = max((m for m in (before, latest) if m is not None), default=None)
        self.spark.createDataFrame([(mark,)], "mark long").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/marks/{BATCH_COLUMN}={batch_id}")

    def route(self, stream: DataFrame, *, available_now: bool = True) -> StreamingQuery:
        """Start the first query over a stream of raw rows."""
        writer = reduced_readings(stream, self.sentinel).writeStream.foreachBatch(self._routed).option("checkpointLocation", f"{self.path}/checkpoints/route")
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    # ------------------------------------------------------------ close

    def _sums(self, rows: DataFrame, *keys: Column | str) -> DataFrame:
        """Sums and counts per key: what merges, unlike means."""
        sums = [f(c).alias(f"{c}_{name}") for c in ("timestamp", *FEATURES) for f, name in ((F.sum, "sum"), (F.count, "n"))]
        return rows.groupBy(*KEYS, *keys).agg(*sums)

    def _readings_schema(self) -> T.StructType:
        return self.spark.read.parquet(f"{self.path}/readings").schema

    def close(self, *, available_now: bool = True) -> StreamingQuery:
        """Start the second query over the readings routed so far, all of them in one micro-batch.

        A cap on files would cut a routed batch in two, and the second half could be late
        to a watermark that the first has moved.
        """
        readings = self.spark.readStream.schema(self._readings_schema()).parquet(f"{self.path}/readings").where(F.col(LATE) == 0)
        timed = readings.withWatermark(EVENT_TIME, f"{self._lateness_ms} milliseconds")
        window = F.window(EVENT_TIME, f"{self._width_ms} milliseconds").alias("_window")
        closed = self._sums(timed, window).withColumn(ENDS, F.unix_millis("_window.end")).drop("_window")
        writer = closed.writeStream.outputMode("append").foreachBatch(parquet_batches(f"{self.path}/closed")).option("checkpointLocation", f"{self.path}/checkpoints/close")
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def run(self, stream: DataFrame, timeout_s: float | None = None) -> list[StreamingQuery]:
        """Route what has landed, then close what it closes; call again when more has landed.

        Raises if the second query dropped a row, which routing rules out.
        """
        routed = self.route(stream)
        await_all([routed], timeout_s)
        closing = self.close()
        await_all([closing], timeout_s, late=LateRows([closing]))
        return [routed, closing]

    # ------------------------------------------------------------ results

    def late(self) -> DataFrame:
        """The late readings."""
        return self.spark.read.parquet(f"{self.path}/readings").where(F.col(LATE) == 1)

    def closed(self) -> DataFrame:
        """Sums and counts of the closed buckets, each once, without the late readings."""
        schema = self._sums(self.spark.createDataFrame([], self._readings_schema()), ENDS).schema
        path = f"{self.path}/closed"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], schema)  # no bucket has closed yet
        return self.spark.read.schema(schema).parquet(path).drop(BATCH_COLUMN)

    def merged(self, output: Sequence[str] = OUTPUT_COLUMNS) -> DataFrame:
        """Bucket means of everything that has landed, as ``preprocess`` gives them.

        Open buckets are those that end after the last closed one; only their readings are
        read again. One shuffle of partial sums.
        """
        closed = self.closed()
        last = closed.agg(F.max(ENDS)).first()[0]
        rows = self.spark.read.parquet(f"{self.path}/readings")
        rest = rows.where((F.col(LATE) == 1) | (F.col(ENDS) > F.lit(last))) if last is not None else rows
        parts = closed.unionByName(self._sums(rest, ENDS))
        columns = ("timestamp", *FEATURES)
        sums = parts.groupBy(*KEYS, ENDS).agg(*[F.sum(f"{c}_{x}").alias(f"{c}_{x}") for c in columns for x in ("sum", "n")])
        means = [F.try_divide(f"{c}_sum", f"{c}_n").alias(c) for c in columns]
        complete = sums.select(*KEYS, *means).na.drop(how="any", subset=list(output))
        return complete.withColumn("timestamp", F.col("timestamp").try_cast(self.time_type)).select(*output)


__all__ = ["BucketStream", "reduced_readings"]
