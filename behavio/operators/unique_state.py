"""Unique visitors whose bitmaps are kept from run to run (U4).

The state is a folder of runs.  A run writes the merged bitmaps of the (window, bucket) pairs that its rows
touch, and the new counts of the windows among them; stored pairs without new rows are not written, and only the
days that the run touches are read.  A window's new count is its old one plus the bits that the run has set, so no run counts
a stored bitmap again.

A run has an id and counts once it is committed: a commit is a folder with the run's number and id, written after the run's
data.  Repeating a committed run changes nothing, one that broke off before its commit is done again
over its own folder.  Runs are made one at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.hashing import rolling_hash
from ..functions.times import epoch_micros, positive_micros, utc_ntz

BITMAPS = "window_us long, bucket long, bitmap binary, bits long"
COUNTS = "window_us long, uv long"
DAY_US = 86_400_000_000
COMPACTED = "compacted:"


def _path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


class BitmapState:
    """Bitmaps and counts of tumbling windows below the shared folder ``base``."""

    def __init__(self, spark: SparkSession, base: str, size="1 hour"):
        self.spark, self.base, self.size_us = spark, base.rstrip("/"), positive_micros(size)

    def commits(self) -> list[tuple[int, str]]:
        """(number, run id) of the committed runs, in order."""
        fs, at = _path(self.spark, f"{self.base}/commits")
        if not fs.exists(at):
            return []
        found = self.spark.read.schema("run string").option("basePath", str(at)).parquet(str(at))
        return sorted((int(r.number), r.run) for r in found.select("number", "run").collect())

    def _versions(self, name: str, ddl: str, days: tuple[int, int] | None = None) -> DataFrame:
        """All versions in the committed runs, with the run's ``number``; of the windows that end on some days only."""
        runs = self.commits()
        if not runs:
            return self.spark.createDataFrame([], f"{ddl}, number long")
        whole = max((n for n, r in runs if r.startswith(COMPACTED)), default=0)
        paths = [f"{self.base}/data/{name}/number={n}" for n, _ in runs if n >= whole]
        found = self.spark.read.schema(f"{ddl}, number long, day long").option("basePath", f"{self.base}/data/{name}").parquet(*paths)
        return (found if days is None else found.where(F.col("day").between(*days))).drop("day")

    @staticmethod
    def _last(versions: DataFrame, keys: list[str]) -> DataFrame:
        rest = [c for c in versions.columns if c not in (*keys, "number")]
        return versions.groupBy(*keys).agg(F.max_by(F.struct(*rest), "number").alias("_last")).select(*keys, "_last.*")

    def bitmaps(self) -> DataFrame:
        """window_us, bucket, bitmap and bits of all pairs."""
        return self._last(self._versions("bitmaps", BITMAPS), ["window_us", "bucket"])

    def counts(self) -> DataFrame:
        """window_us and uv of all windows with a visitor, from the stored counts alone."""
        return self._last(self._versions("counts", COUNTS), ["window_us"])

    def _write(self, df: DataFrame, name: str, number: int) -> DataFrame:
        at = f"{self.base}/data/{name}/number={number}"
        (df.withColumn("day", F.floor(F.col("window_us") / F.lit(DAY_US)).cast("long")).write.mode("overwrite").partitionBy("day").parquet(at))
        return self.spark.read.schema(df.schema).parquet(at)

    def _commit(self, number: int, run: str) -> None:
        self.spark.createDataFrame([(run,)], "run string").coalesce(1).write.mode("error").parquet(f"{self.base}/commits/number={number}")

    def touched(self, rows: DataFrame, ts: str, user: str) -> DataFrame:
        """Bitmaps of the pairs that ``rows`` touch, merged with the stored ones: window_us, bucket, bitmap, bits and
        ``before``, the bits that were set already.  Rows without a time or user are no visits."""
        size = F.lit(self.size_us)
        visits = (rows.select((F.floor(epoch_micros(rows, ts) / size) * size + size).cast("long").alias("window_us"), F.col(user).alias("_u"))
                  .where("window_us IS NOT NULL AND _u IS NOT NULL").withColumn("_o", rolling_hash("_u")))
        new = (visits.groupBy("window_us", F.bitmap_bucket_number("_o").alias("bucket"))
               .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_o")).alias("bitmap")))
        first, last = visits.agg(F.min("window_us"), F.max("window_us")).first()
        days = (0, -1) if first is None else (first // DAY_US, last // DAY_US)
        old = self._versions("bitmaps", BITMAPS, days).join(new.select("window_us", "bucket"), ["window_us", "bucket"], "left_semi")
        old = self._last(old, ["window_us", "bucket"])
        both = new.withColumn("before", F.lit(0).cast("long")).unionByName(
            old.select("window_us", "bucket", "bitmap", F.col("bits").alias("before")))
        merged = both.groupBy("window_us", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"), F.max("before").alias("before"))
        return merged.withColumn("bits", F.bitmap_count("bitmap").cast("long"))

    def add(self, rows: DataFrame, run: str, ts: str, user: str) -> None:
        """Merge the rows of one run; nothing happens if it is committed already."""
        if run.startswith(COMPACTED):
            raise ValueError(f"the id of a run must not start with {COMPACTED}")
        runs = self.commits()
        if run in (r for _, r in runs):
            return
        number = (runs[-1][0] if runs else 0) + 1
        merged = self._write(self.touched(rows, ts, user), "merged", number)
        self._write(merged.select("window_us", "bucket", "bitmap", "bits"), "bitmaps", number)
        gained = merged.groupBy("window_us").agg(F.sum(F.col("bits") - F.col("before")).alias("gained"))
        uv = (F.col("gained") + F.coalesce("uv", F.lit(0))).alias("uv")
        self._write(gained.join(self.counts(), "window_us", "left").select("window_us", uv), "counts", number)
        self._commit(number, run)

    def compact(self) -> None:
        """Write the last versions of all pairs and windows as a run of its own; readers skip those before."""
        runs = self.commits()
        if runs:
            number = runs[-1][0] + 1
            self._write(self.bitmaps(), "bitmaps", number)
            self._write(self.counts(), "counts", number)
            self._commit(number, f"{COMPACTED}{number}")


def window_counts(state: BitmapState) -> DataFrame:
    """window_start, window_end and uv of a state's windows."""
    end = F.col("window_us")
    return state.counts().select(utc_ntz(end - state.size_us).alias("window_start"), utc_ntz(end).alias("window_end"), "uv")
