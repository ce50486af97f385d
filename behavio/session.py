"""Session helpers: a tuned local session for tests/bench and the
checkpoint-directory policy used by operators that cut lineage."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "behavio",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench.  On a cluster, use the cluster's
    own session instead; operators only rely on the settings below being
    sensible, never on local paths."""
    master = master or os.environ.get("BEHAVIO_MASTER", "local[8]")
    if shuffle_partitions is None:
        cores = master[master.find("[") + 1:master.find("]")] if "[" in master else "8"
        shuffle_partitions = int(cores) if cores.isdigit() else os.cpu_count() or 8
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         # delete reliable-checkpoint files once their DataFrame is gone
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("BEHAVIO_DRIVER_MEMORY", "16g"))
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
         # commits write a changelog instead of a full snapshot each batch
         .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_code()
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir).  Only a local-mode session without one gets a fresh
    temporary folder; on a cluster an unset value is an error, because a
    machine-local folder would not survive the loss of an executor."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...)")
        d = tempfile.mkdtemp(prefix="behavio-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the checkpoint folder for a written table."""
    import uuid
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/behavio-{name}-{uuid.uuid4().hex[:12]}"


def written(df, name: str):
    """Cut lineage: write ``df`` as Parquet below the shared checkpoint folder and read it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_code() -> None:
    """Pickle this package's functions by value, so Python workers (pandas
    operators, state functions) need no installed copy of the package."""
    import pyspark.cloudpickle as cloudpickle
    import behavio
    try:
        cloudpickle.register_pickle_by_value(behavio)
    except ValueError:
        pass  # already registered
