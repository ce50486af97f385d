"""Line numbers of text over all files and splits, in two passes.

A split's lines are consecutive rows of one partition, so a line's place in
its split needs no shuffle.  What moves is one row per split: their sizes are
summed in input order (files by path, splits by their first byte), and each
line adds the lines before its split.  No task sees all splits: their prefix
sums are made per range of splits, and only the ranges' totals meet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..session import scratch_path

#: Splits whose offsets are broadcast (some 200 bytes each); beyond, the same join shuffles.
BROADCAST_SPLITS = 100_000
#: Ranges of splits, whose totals meet in one task.
RANGES = 256


def source_split(lines: DataFrame) -> DataFrame:
    """Adds the file (``path``) and first byte (``start``) of each row's split; ``lines`` is a text read or stream."""
    return lines.select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"))


def positioned(lines: DataFrame) -> DataFrame:
    """``source_split`` and ``at``, which grows by one from line to line of a split; ``lines`` is a batch read without a filter."""
    return source_split(lines).withColumn("at", F.monotonically_increasing_id())


def split_offsets(lines: DataFrame, order: tuple[str, ...] = ("path", "start"), ranges: int = RANGES) -> DataFrame:
    """Per split: ``first`` (its smallest ``at``), ``n`` (lines) and ``before`` (lines of the splits before it in ``order``).

    Null parts of ``order`` come first.  Writes one small table in the shared folder, as ranges must not be drawn anew by a retried task."""
    spark = lines.sparkSession
    at = scratch_path(spark, "splits")
    (lines.groupBy(*order).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
     .repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()).write.parquet(at))
    splits = spark.read.parquet(at)
    earlier = (Window.unboundedPreceding, -1)
    totals = (splits.groupBy("range").agg(F.sum("n").alias("size"))  # at most ``ranges`` rows
              .select("range", F.coalesce(F.sum("size").over(Window.orderBy("range").rowsBetween(*earlier)), F.lit(0)).alias("base")))
    inside = F.coalesce(F.sum("n").over(Window.partitionBy("range").orderBy(*order).rowsBetween(*earlier)), F.lit(0))
    return (splits.withColumn("inside", inside).join(F.broadcast(totals), "range")
            .select(*order, "first", "n", (F.col("base") + F.col("inside")).alias("before")))


def numbered(lines: DataFrame, order: tuple[str, ...] = ("path", "start"), out: str = "line_no") -> DataFrame:
    """``lines`` (of ``positioned``) with the line number ``out``, from 0 in ``order``, in place of ``at`` and the order's columns.

    The two passes must cut the text alike, which Spark does for the same
    files and settings; a line outside of its split's numbers (files changed in between) raises."""
    spark = lines.sparkSession
    at = scratch_path(spark, "offsets")
    split_offsets(lines, order).write.parquet(at)
    offsets = spark.read.parquet(at)
    offsets = F.broadcast(offsets) if offsets.count() <= BROADCAST_SPLITS else offsets
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in order]
    place = F.col("a.at") - F.col("b.first")
    number = F.when(place.between(F.lit(0), F.col("b.n") - 1), F.col("b.before") + place).otherwise(
        F.raise_error(F.lit("the text changed while its lines were numbered")).cast("long"))
    joined = lines.alias("a").join(offsets.alias("b"), on=[c for c in same], how="left")
    return joined.select(*[F.col(f"a.{c}") for c in lines.columns if c not in (*order, "at")], number.alias(out))
