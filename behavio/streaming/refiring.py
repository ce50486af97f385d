"""Sliding windows that fire when the watermark passes their end and again for every late row, until
the allowed lateness is over, and the table of versions that they are written to.

A micro-batch is counted per pane; the panes wait in written state while a window that holds them may still change.
A pane row remembers up to which end its windows were closed when it came, so a
late row counts in exactly those of its windows that still accepted it.  A micro-batch emits the windows
that have become due, and those of the due ones that its late rows changed: the output is in
update form.  Versions are keyed by the micro-batch, which replaces its own when it is run again; of a
window's versions the last one holds.  Rows for which all windows were closed are a table of their own.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.times import epoch_micros, micros_of, positive_micros, utc_ntz
from ..operators.windows import window_deltas
from .runner import exists, remove

NEVER = -(1 << 62)


def _batch(folder: str, batch: int) -> str:
    return f"{folder}/microbatch={batch}"


def refiring_windows(base: str, ts: str, key: str, size="10 minutes", slide="5 seconds", delay="1 second", lateness="60 seconds",
                     counted: str | None = None, runs: bool = False):
    """A ``foreachBatch`` function over rows with ``ts`` and ``key`` that counts sliding windows per key.

    The watermark of a micro-batch is the largest time of the earlier ones less ``delay``; a window accepts rows until
    the watermark reaches its end plus ``lateness``, and is emitted once the watermark has reached its end, then
    again after each micro-batch that changed it.  It writes below ``base``: ``data`` (window_us, key, cnt), one folder for each
    micro-batch; ``late``, the rows without an open window; ``state``.  Rows without a time are no rows of any window and
    go to ``late``; a null key is a key.

    ``counted`` may name a flag; rows without it move the watermark only.  With ``runs`` (and no lateness) neighbouring windows
    of one count are written as one row (window_us, last_us, key, cnt), whose number follows the rows and not size / slide."""
    size_us, slide_us = positive_micros(size), positive_micros(slide)
    pane_us, delay_us, late_us = gcd(size_us, slide_us), micros_of(delay), micros_of(lateness)
    if slide_us > size_us:
        raise ValueError("windows must not leave gaps")
    if runs and late_us:
        raise ValueError("runs of windows are written once")
    counts_row = F.when(F.col(counted), 1) if counted else F.lit(1)

    def fold(rows: DataFrame, batch: int) -> None:
        rows = rows.persist()  # the late and the other rows are two actions, which would each run the stream's operators
        try:
            folded(rows, batch)
        finally:
            rows.unpersist()

    def folded(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        kind = rows.schema[key].dataType.simpleString()
        panes_ddl, mark_ddl = f"pane_us long, key {kind}, c long, since_us long", "top long"

        def stored(name: str, ddl: str) -> DataFrame:
            if batch == 0:
                return spark.createDataFrame([], ddl)
            return spark.read.schema(ddl).parquet(_batch(f"{base}/state/{name}", batch - 1))

        def keep(df: DataFrame, folder: str) -> DataFrame:
            df.write.mode("overwrite").parquet(_batch(folder, batch))
            return spark.read.schema(df.schema).parquet(_batch(folder, batch))

        top = stored("mark", mark_ddl).agg(F.max("top")).first()[0]
        wm = NEVER if top is None else top - delay_us
        low = max(wm - late_us, NEVER)
        us = epoch_micros(rows, ts)
        pane = (F.floor(us / F.lit(pane_us)) * F.lit(pane_us)).cast("long")
        closed = us.isNull() | (pane + F.lit(size_us) <= F.lit(low))
        keep(rows.where(closed), f"{base}/late")
        new = keep(rows.where(~closed).groupBy(pane.alias("pane_us"), F.col(key).alias("key"))
                   .agg(F.count(counts_row).alias("c"), F.max(us).alias("top")), f"{base}/state/new")
        highest = new.agg(F.max("top")).first()[0]
        now = max(x for x in (top, highest, NEVER) if x is not None)
        due = max(now - delay_us, wm)
        every = stored("panes", panes_ddl).unionByName(new.select("pane_us", "key", "c", F.lit(low + 1).alias("since_us")))
        # for the next micro-batch; this one still counts the windows that close now
        keep(every.where(F.col("pane_us") + size_us > due - late_us), f"{base}/state/panes")

        panes = every.where(F.col("pane_us") + size_us > low).select(utc_ntz(F.col("pane_us")).alias("pane"), "key", "c", "since_us")
        deltas = window_deltas(panes, None, size, slide, ["key"], since="since_us")
        first, last = epoch_micros(deltas, "e"), epoch_micros(deltas, "next_e") - F.lit(slide_us)
        # only ends that can be emitted now
        first = F.greatest(first, _ceil(F.lit(low + 1), slide_us, size_us % slide_us))
        last = F.least(last, F.lit(due))
        if runs:
            windows = deltas.where("cnt > 0").select(first.alias("window_us"), last.alias("last_us"), F.col("key").alias(key), "cnt")
            keep(windows.where("window_us <= last_us"), f"{base}/data")
            return done(spark, batch, now)
        ends = F.when(first <= last, F.sequence(first, last, F.lit(slide_us).cast("long")))
        counts = deltas.where("cnt > 0").select(F.explode(ends).alias("window_us"), "key", "cnt")
        changed = _ends(new.where(F.col("pane_us") + pane_us <= F.lit(wm)), pane_us, size_us, slide_us, low, wm)
        # due windows of all keys, and older ones with a new row
        fired = counts.where(F.col("window_us") > wm).unionByName(
            counts.where(F.col("window_us") <= wm).alias("c").join(
                changed.alias("n"), (F.col("c.window_us") == F.col("n.window_us")) & F.col("c.key").eqNullSafe(F.col("n.key")), "left_semi"))
        keep(fired.withColumnRenamed("key", key), f"{base}/data")
        done(spark, batch, now)

    def done(spark: SparkSession, batch: int, now: int) -> None:
        mark = spark.createDataFrame([(None if now == NEVER else now,)], "top long")
        mark.write.mode("overwrite").parquet(_batch(f"{base}/state/mark", batch))
        # a restart repeats this micro-batch at most, from the one before
        for name in ("panes", "mark", "new"):
            remove(spark, _batch(f"{base}/state/{name}", batch - 2))

    return fold


def _ceil(us, slide_us: int, offset: int):
    """The first window end from ``us`` on."""
    return (F.ceil((us - F.lit(offset)) / F.lit(slide_us)) * F.lit(slide_us) + F.lit(offset)).cast("long")


def _ends(panes: DataFrame, pane_us: int, size_us: int, slide_us: int, low: int, high: int) -> DataFrame:
    """(window_us, key) of the windows of ``panes`` that end after ``low`` and up to ``high``."""
    first = _ceil(F.greatest(F.col("pane_us") + pane_us, F.lit(low + 1)), slide_us, size_us % slide_us)
    last = F.least(F.col("pane_us") + size_us, F.lit(high))
    ends = F.when(first <= last, F.sequence(first, last, F.lit(slide_us).cast("long")))
    return panes.select(F.explode(ends).alias("window_us"), "key").distinct()


def latest(spark: SparkSession, base: str, ddl: str, keys: list[str], version: str = "microbatch") -> DataFrame:
    """The table of versions below ``{base}/data`` with the last version of each key; compacted versions count as of
    their last micro-batch."""
    kind = StructType.fromDDL(ddl)
    rest = [f.name for f in kind if f.name not in keys]
    found = _versions(spark, base, kind, version)
    if found is None:
        return spark.createDataFrame([], kind)
    return (found.groupBy(*keys).agg(F.max_by(F.struct(*rest), version).alias("_last"))
            .select(*[F.col(f"_last.{c}").alias(c) if c in rest else F.col(c) for c in (f.name for f in kind)]))


def _folders(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the complete folders ``name=number`` below ``folder``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return []
    found = [str(s.getPath()) for s in fs.listStatus(at)]
    return sorted(int(p.rpartition("=")[2]) for p in found if exists(spark, f"{p}/_SUCCESS"))


def _versions(spark: SparkSession, base: str, kind: StructType, version: str) -> DataFrame | None:
    base = base.rstrip("/")
    whole = _folders(spark, f"{base}/compacted")[-1:]
    later = [b for b in _folders(spark, f"{base}/data") if not whole or b > whole[0]]
    out = None
    if whole:
        out = spark.read.schema(kind).parquet(f"{base}/compacted/upto={whole[0]}").withColumn(version, F.lit(whole[0]).cast("long"))
    if later:
        part = (spark.read.schema(kind).option("basePath", f"{base}/data").parquet(*[_batch(f"{base}/data", b) for b in later])
                .withColumn(version, F.col(version).cast("long")))
        out = part if out is None else out.unionByName(part)
    return out


def compact(spark: SparkSession, base: str, ddl: str, keys: list[str]) -> None:
    """Write the last versions as one folder, so that readers skip the micro-batches before.  The
    folder counts once it is complete; a compaction that fails leaves the table as it was."""
    done = _folders(spark, f"{base.rstrip('/')}/data")
    if done:
        latest(spark, base, ddl, keys).write.mode("overwrite").parquet(f"{base.rstrip('/')}/compacted/upto={done[-1]}")


def late_table(spark: SparkSession, base: str, schema: StructType) -> DataFrame:
    """The rows that a fold has written below ``{base}/late``, with the micro-batch in which they came."""
    at = f"{base.rstrip('/')}/late"
    if not exists(spark, at):
        return spark.createDataFrame([], StructType(schema.fields).add("microbatch", "long"))
    found = spark.read.schema(StructType(schema.fields).add("microbatch", "long")).option("basePath", at).parquet(at)
    return found.select(*schema.names, "microbatch")
