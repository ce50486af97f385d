"""Streaming sources: a table of a scale-factor folder or a folder of
text files read as a file stream, with event time and watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.times import epoch_micros, micros_of, to_event_ts
from ..sources.lines import LAYOUTS, read_lines

#: Files of one micro-batch, which bounds what a backlog puts into state at once.
MAX_FILES = 64


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files_per_trigger: int = MAX_FILES) -> DataFrame:
    """File stream over ``<sf_dir>/<name>.parquet``, one file or a folder of
    part files (schema from the footers; new part files are picked up
    per trigger)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # as a pattern it may be a file or a folder; a plain path must be a folder
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(f"{path[:-1]}[{path[-1]}]")


def line_stream(spark: SparkSession, folder: str, layout: str) -> DataFrame:
    """Text files of a reference layout as a stream of typed rows
    (bad lines fail the query, as in the reference)."""
    if layout not in LAYOUTS:
        raise ValueError(layout)
    return read_lines(spark, folder, layout, on_error="fail", streaming=True)


def with_event_time(stream: DataFrame, ts: str = "ts", delay="0 seconds") -> DataFrame:
    """Cast ``ts`` to TIMESTAMP (watermarks refuse TIMESTAMP_NTZ; NTZ is UTC
    wall clock in any session zone) and set a watermark of max(ts) - delay
    (0 s = the reference's ascending times)."""
    return stream.withColumn(ts, to_event_ts(stream, ts)).withWatermark(ts, f"{micros_of(delay)} microseconds")


def with_micros(stream: DataFrame, ts: str = "ts", out: str = "us") -> DataFrame:
    """Adds the event time as microseconds since the epoch."""
    return stream.withColumn(out, epoch_micros(stream, ts))
