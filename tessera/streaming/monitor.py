"""Structured Streaming: stateless scoring and windowed monitoring.

Streams read the fixture folder with a glob filter (all tables share one
folder).  Event time is ``timestamp_ntz`` in the fixtures; watermarks need
``timestamp``, so it is cast (session zone UTC).  Sinks are files in the
shared checkpoint folder (plus a checkpoint location per query), so a query
restarts exactly where it stopped after a failure; nothing is collected on
the driver.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.operators.metrics import AUC_BUCKETS, bucket_of
from tessera.sources.files import is_directory, list_folders, path_exists, scratch_path

WATERMARK = "1 day"
WINDOW = "1 day"


def file_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int = 64) -> DataFrame:
    """Stream of a fixture table (schema taken from the batch table, glob
    filter so only that table's files are picked up), oldest files first."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    if is_directory(spark, path):
        # a table written by Spark: a folder of part files
        return (spark.readStream.format("parquet").schema(schema)
                .option("maxFilesPerTrigger", files_per_batch).load(path))
    return (spark.readStream.format("parquet").schema(schema)
            .option("pathGlobFilter", f"{name}.parquet").option("maxFilesPerTrigger", 1)
            .load(folder))


def run_to_parquet(stream: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Run a stream over everything available (``availableNow``) into a parquet
    folder by the file sink (append, exactly once), and return that folder as a
    batch table.  Of windows, those appear that the watermark has passed."""
    out = scratch_path(spark, f"stream-{name}")
    ckpt = scratch_path(spark, f"stream-{name}-ckpt")
    q = stream.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True).format(
        "parquet").outputMode("append").option("path", out).start()
    _finish(q)
    return spark.read.parquet(out)


def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def write_batch(batch: DataFrame, path: str) -> None:
    """One micro-batch's changed rows, in a folder of its own: a batch that runs
    again after a failure replaces its own rows and no others."""
    batch.write.mode("overwrite").parquet(path)


@dataclass
class WindowedResult:
    """The result of a windowed aggregation that runs in update mode: every batch
    writes the windows it changed under ``batch=<id>``, and a window's row is the
    one of its last batch.  Nothing is rewritten in place, so a reader sees the
    last whole result while, and after, a batch fails."""

    spark: SparkSession
    path: str
    schema: StructType
    keys: list[str]
    progress: list[dict]

    def batches(self) -> list[int]:
        """Numbers of the batches that have been written whole."""
        names = list_folders(self.spark, self.path)
        done = [x for x in names if x.startswith("batch=") and path_exists(self.spark, f"{self.path}/{x}/_SUCCESS")]
        return sorted(int(x.removeprefix("batch=")) for x in done)

    def table(self) -> DataFrame:
        """One row per key, from the last batch that changed it."""
        written = [f"{self.path}/batch={b}" for b in self.batches()]
        if not written:
            return self.spark.createDataFrame([], self.schema)
        schema = StructType([*self.schema.fields, StructField("batch", LongType())])
        rows = self.spark.read.schema(schema).option("basePath", self.path).parquet(*written)
        values = [x for x in self.schema.names if x not in self.keys]
        last = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "batch").alias("last"))
        return last.select(*self.keys, *[F.col("last")[v].alias(v) for v in values])


def run_windowed(stream: DataFrame, spark: SparkSession, name: str, keys: Sequence[str], out: str | None = None,
                 checkpoint: str | None = None, write: Callable[[DataFrame, str], None] = write_batch) -> WindowedResult:
    """Run a windowed aggregation over everything available, in update mode.

    State is bounded: the watermark drops windows that no row may change any
    more, and rows that come too late for theirs.  Given the same ``out`` and
    ``checkpoint``, a run continues where the last one stopped or failed."""
    out = out or scratch_path(spark, f"stream-{name}")
    checkpoint = checkpoint or scratch_path(spark, f"stream-{name}-ckpt")
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode(
        "update").foreachBatch(lambda batch, number: write(batch, f"{out}/batch={number}")).start()
    _finish(query)
    # what the last batches report, for state and late rows (Spark keeps a bounded number)
    progress = [json.loads(p.json) if hasattr(p, "json") else dict(p) for p in query.recentProgress]
    return WindowedResult(spark, out, stream.schema, list(keys), progress)


def stream_score(spark: SparkSession, folder: str, build: Callable[[DataFrame], DataFrame]
                 ) -> DataFrame:
    """Stateless scoring of a stream: the same pure function as batch scoring."""
    return run_to_parquet(build(spark), spark, "scored")


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn("event_time", F.col(ts).cast("timestamp"))


def daily_prediction_counts(events: DataFrame, prediction: F.Column) -> DataFrame:
    """Tumbling 1-day windows of prediction counts with a watermark."""
    e = event_time(events).withWatermark("event_time", WATERMARK)
    return e.groupBy(F.window("event_time", WINDOW).alias("w"), prediction.alias("prediction")).agg(
        F.count("*").alias("n")).select(
        F.to_date(F.col("w.start")).alias("day"), "prediction", "n")


def windowed_bucket_counts(events: DataFrame, score: F.Column, label: F.Column,
                           n_bins: int = AUC_BUCKETS) -> DataFrame:
    """State = (window, bucket) -> positive/negative counts: mergeable, so
    the AUC of each window is a small batch computation on top."""
    e = event_time(events).withWatermark("event_time", WATERMARK)
    y = label.cast("long")
    return e.groupBy(F.window("event_time", WINDOW).alias("w"), bucket_of(score, n_bins).alias("bucket")).agg(
        F.sum(y).alias("pos"), F.sum(F.lit(1) - y).alias("neg")).select(
        F.to_date(F.col("w.start")).alias("day"), "bucket", "pos", "neg")
