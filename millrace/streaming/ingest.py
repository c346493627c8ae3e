"""Incremental ingest that survives restarts, and windows over event time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.common import first_rows


def ingest(stream: DataFrame, sink: str, checkpoint: str) -> StreamingQuery:
    """Write every micro-batch to a folder of its own number, all that is there now.

    A batch that is replayed after a crash overwrites its own folder, so each
    row lands once; ``durable`` settles keys that arrive in several batches.
    """
    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{sink}/batch={batch:012d}")

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def durable(spark: SparkSession, sink: str, key: list[str], *order: str) -> DataFrame:
    """The ingested rows, of each key the first."""
    rows = spark.read.parquet(sink)
    return first_rows(rows, key, "batch", *order).drop("batch")


def tumbling(df: DataFrame, time: str, width: str, late: str, *by: str) -> DataFrame:
    """Counts per window of event time; on a stream rows later than ``late`` are dropped."""
    counted = df.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *by).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), *by, "n")


def sessions(df: DataFrame, key: str, time: str, gap: str, late: str) -> DataFrame:
    """Sessions of a key that end when nothing comes for ``gap``."""
    counted = df.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return counted.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def step_times(lines: DataFrame, text: str = "value", time: Column | None = None) -> DataFrame:
    """(step, ts) of training log lines that report a loss."""
    step = F.regexp_extract(text, r"'(?:step|global_step)':\s*(\d+)", 1)
    at = F.regexp_extract(text, r"'ts':\s*([0-9.]+)", 1) if time is None else time
    return lines.where(F.col(text).contains("'loss'")).where(step != "").select(step.cast("long").alias("step"), at.cast("double").alias("ts"))


def column_peaks(lines: DataFrame, device: str, counters: list[str]) -> DataFrame:
    """Largest value of each counter per device."""
    return lines.groupBy(device).agg(*[F.max(F.col(c).cast("double")).alias(c) for c in counters])
