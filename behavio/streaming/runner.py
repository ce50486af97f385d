"""Run a streaming DataFrame to completion into a Parquet table under the
shared checkpoint folder, and read the table back."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType, TimestampType

from ..functions.times import utc_ntz
from ..session import scratch_path


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
log = logging.getLogger(__name__)
Stream = DataFrame | Callable[[SparkSession], DataFrame]


#: Micro-batches of one run whose late rows are counted.
PROGRESS = 100_000
#: Settings that a query's own session takes over from the caller's.
INHERITED = ("spark.sql.session.timeZone", "spark.sql.streaming.stateStore.providerClass", "spark.checkpoint.dir")


def _started(spark: SparkSession, stream: Stream, settings: dict[str, str]) -> DataFrame:
    """The stream to run.  One given as a function is built in a session of its
    own with ``settings``, so neither the caller nor other queries see them; a
    DataFrame runs with the settings of its session."""
    if isinstance(stream, DataFrame):
        return stream
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.numRecentProgressUpdates", str(PROGRESS))
    for k in INHERITED:
        if (v := spark.conf.get(k, None)) is not None and own.conf.isModifiable(k):
            own.conf.set(k, v)
    for k, v in settings.items():
        own.conf.set(k, v)
    return stream(own)


def late_rows(query) -> int:
    """Rows that the query has dropped because they were behind the watermark."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p["stateOperators"])


def _finish(query, name: str, late: str, put_aside: int = 0) -> None:
    """Wait for the end and report late rows, with those that the query itself has put aside."""
    query.awaitTermination()
    dropped = late_rows(query) + put_aside
    if dropped and late == "fail":
        raise RuntimeError(f"{name}: {dropped} rows were behind the watermark")
    if dropped:
        log.warning("%s: %d rows were behind the watermark and are not in the result", name, dropped)


def _utc(out: DataFrame) -> DataFrame:
    return out.select(*[utc_ntz(F.unix_micros(f.name)).alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
                        for f in out.schema])


def run_available(spark: SparkSession, stream: Stream, name: str, output_mode: str = "append",
                  ntz: bool = True, state_partitions: int | None = None, rocksdb: bool = False,
                  base: str | None = None, late: str = "warn") -> DataFrame:
    """Process everything available now (one or more micro-batches, then
    the no-data batch that advances the watermark), write to Parquet below
    ``base`` and return the table.  ``ntz`` turns TIMESTAMP columns back into
    UTC wall-clock NTZ.

    ``base`` holds the result and the checkpoint: called again with the same
    folder, the query resumes where it stopped and writes no row twice.  By
    default it is a fresh folder in the shared checkpoint folder.

    ``stream`` is a function of a session that builds the stream, or the
    streaming DataFrame itself.  A new query's state is split into ``state_partitions`` partitions (default:
    the default parallelism), fixed for its lifetime.  ``rocksdb=True`` (needed
    by transformWithState) selects the RocksDB state store.  Both hold for a
    stream given as a function.  Rows behind the
    watermark are counted: ``late`` is "warn" or "fail"."""
    base = (base or scratch_path(spark, name)).rstrip("/")
    settings = {"spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism)}
    if rocksdb:
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
    frame = _started(spark, stream, settings)
    q = (frame.writeStream.format("parquet").outputMode(output_mode)
         .option("path", f"{base}/data").option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True).start())
    _finish(q, name, late)
    out = read_table(spark, f"{base}/data", frame.schema)
    return _utc(out) if ntz else out


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that the running query has written and needs no more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def read_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The table at ``path``; empty when no micro-batch has written it."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def run_available_batches(spark: SparkSession, stream: Stream, name: str, per_batch, schema,
                          ntz: bool = True, state_partitions: int | None = None, base: str | None = None,
                          late: str = "warn") -> DataFrame:
    """Like ``run_available`` but each micro-batch's output goes through
    ``per_batch(batch_df)`` (any batch DataFrame code, e.g. a ranking)
    before it is written.  Each batch is written to its own folder with
    overwrite, so a batch re-run after a failure replaces its output
    instead of duplicating it."""
    base = (base or scratch_path(spark, name)).rstrip("/")
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)

    def write(batch_df, batch_id):
        per_batch(batch_df).write.mode("overwrite").parquet(f"{base}/data/microbatch={batch_id}")

    settings = {"spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism)}
    q = (_started(spark, stream, settings).writeStream.outputMode("append").foreachBatch(write)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    _finish(q, name, late)
    out = read_table(spark, f"{base}/data", schema).select(*[f.name for f in schema])  # without the folder column
    return _utc(out) if ntz else out


def fold_available(spark: SparkSession, stream: Stream, base: str, fold, name: str = "folded",
                   state_partitions: int | None = None, late: str = "warn", output_mode: str = "append") -> None:
    """Fold the available micro-batches with a ``foreachBatch`` function.  Called again with the same ``base``, the
    query resumes.  Late rows that Spark drops, and those that the fold writes below ``{base}/late``, are counted:
    ``late`` is "warn" or "fail"."""
    settings = {"spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism)}

    def put_aside() -> int:
        at = f"{base}/late"
        return spark.read.option("recursiveFileLookup", "true").schema("_any int").parquet(at).count() if exists(spark, at) else 0
    before = put_aside()
    q = (_started(spark, stream, settings).writeStream.outputMode(output_mode).foreachBatch(fold)
         .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    _finish(q, name, late, put_aside() - before)


def run_folded(spark: SparkSession, stream: Stream, base: str, fold, schema: str,
               state_partitions: int | None = None, late: str = "warn", name: str = "folded") -> DataFrame:
    """``fold_available`` with a function that writes its results below ``{base}/data``, which are returned."""
    fold_available(spark, stream, base, fold, name, state_partitions, late)
    kind = StructType.fromDDL(schema)
    return read_table(spark, f"{base}/data", kind).select(*[f.name for f in kind])
