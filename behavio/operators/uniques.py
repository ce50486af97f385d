"""Distinct visitors per window.

* exact:  ``count_distinct`` - Catalyst plans it as a (window, user)
  aggregate followed by a (window) aggregate, both with map-side partial
  aggregation, so a hot window is spread over users.
* bitmap: the reference's one-hash bitmap - user id text hashed to a bit
  offset; bits are collected with ``bitmap_construct_agg`` per 32,768-bit
  bucket (only non-empty buckets exist) and counted with ``bitmap_count``.
* hll:    mergeable HLL sketches (``hll_sketch_agg``), bounded memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.hashing import rolling_hash
from ..functions.times import epoch_micros, positive_micros, window_text
from .windows import _keys


def _hour_window(ts: str, size) -> F.Column:
    return F.window(ts, window_text(size))


def with_bit_offset(df: DataFrame, user: str, out: str = "offset") -> DataFrame:
    return df.withColumn(out, rolling_hash(F.col(user)))


def unique_count(df: DataFrame, ts: str, size, user: str, keys=(), method: str = "exact",
                 out: str = "uv") -> DataFrame:
    """Distinct ``user`` per (tumbling window, keys): window_start, window_end, keys, uv."""
    keys = _keys(keys)
    w = _hour_window(ts, size).alias("w")
    if method == "exact":
        agg = df.groupBy(w, *keys).agg(F.count_distinct(user).alias(out))
    elif method == "bitmap":
        b = (with_bit_offset(df, user)
             .groupBy(w, *keys, F.bitmap_bucket_number("offset").alias("_bucket"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position("offset")).alias("_bm")))
        agg = b.groupBy("w", *keys).agg(F.sum(F.bitmap_count("_bm")).cast("long").alias(out))
    elif method == "hll":
        agg = (df.groupBy(w, *keys).agg(F.hll_sketch_agg(F.col(user)).alias("_sk"))
                 .withColumn(out, F.hll_sketch_estimate("_sk")).drop("_sk"))
    else:
        raise ValueError(method)
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *keys, out)


def hll_sketches(df: DataFrame, ts: str, size, user: str, keys=()) -> DataFrame:
    """Per (window, keys) HLL sketch binaries, for later union (e.g. daily
    rollups with ``hll_union_agg``) without re-reading the events."""
    keys = _keys(keys)
    w = _hour_window(ts, size).alias("w")
    return (df.groupBy(w, *keys).agg(F.hll_sketch_agg(F.col(user)).alias("sketch"))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *keys, "sketch"))


def rollup_sketches(sketches: DataFrame, size, keys=(), out: str = "uv_approx") -> DataFrame:
    """Union ``hll_sketches`` output into coarser tumbling windows (e.g.
    hourly -> daily) with ``hll_union_agg``: distinct counts of the larger
    windows without re-reading the events."""
    keys = _keys(keys)
    w = _hour_window("window_start", size).alias("w")
    return (sketches.groupBy(w, *keys).agg(F.hll_union_agg("sketch").alias("_sk"))
                    .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                            *keys, F.hll_sketch_estimate("_sk").alias(out)))


def running_unique(df: DataFrame, ts: str, seq: str, size, user: str, method: str = "exact",
                   slice_="1 minute", out: str = "uv") -> DataFrame:
    """For every row: distinct users of its tumbling window seen so far in
    (ts, seq) order, itself included (the per-event firing of U3/W8).

    Each (window, user) contributes one *marker* row at its first event,
    found with a grouped ``min`` (partial aggregation, no sort of a hot
    window or user).  A window is cut into slices; each slice's marker
    count is also copied as one *carry-in* row into every later slice of
    the window (at most size/slice copies, a small table).  Rows, markers
    and carry-ins are unioned and one running sum per (window, slice) -
    carry-ins first, a marker just before its own row - gives every row's
    count.  No join; a window's work is split into size/slice groups."""
    ident = F.col(user) if method == "exact" else rolling_hash(F.col(user))
    slice_us = positive_micros(slice_)
    base = df.select(seq, ts, ident.alias("_u"),
                     F.window(ts, window_text(size)).end.alias("window_end"),
                     F.floor(epoch_micros(df, ts) / F.lit(slice_us)).alias("_slice"))
    # a null user is no visitor, as in unique_count
    firsts = (base.where(F.col("_u").isNotNull()).groupBy("window_end", "_u")
                  .agg(F.min(F.struct(F.col(ts).alias("t"), F.col(seq).alias("s"),
                                      F.col("_slice").alias("k"))).alias("f"))
                  .select("window_end", F.col("f.t").alias(ts), F.col("f.s").alias(seq),
                          F.col("f.k").alias("_slice")))
    per_slice = firsts.groupBy("window_end", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    last_slice = F.floor((epoch_micros(per_slice, "window_end") - F.lit(1)) / F.lit(slice_us))
    carries = (per_slice.where(F.col("_slice") < last_slice)
               .select("window_end", F.explode(F.sequence(F.col("_slice") + 1, last_slice)).alias("_slice"),
                       F.lit(None).cast(df.schema[ts].dataType).alias(ts),
                       F.lit(None).cast(df.schema[seq].dataType).alias(seq), F.col("_n").alias("_m")))
    rows = base.select("window_end", "_slice", ts, seq, F.lit(0).cast("long").alias("_m"))
    marks = firsts.select("window_end", "_slice", ts, seq, F.lit(1).cast("long").alias("_m"))
    w = (Window.partitionBy("window_end", "_slice")
         .orderBy(F.col(ts).asc_nulls_first(), F.col(seq).asc_nulls_first(), F.col("_m").desc())
         .rowsBetween(Window.unboundedPreceding, 0))
    return (rows.unionByName(marks).unionByName(carries)
                .withColumn("_c", F.sum("_m").over(w))
                .where(F.col("_m") == 0)
                .select(seq, ts, "window_end", F.col("_c").cast("long").alias(out)))


def merge_unique_state(new: DataFrame, stored: DataFrame, key: str = "window_end",
                       member: str = "offset") -> tuple[DataFrame, DataFrame]:
    """Fold a batch of (key, member) rows into a stored state table (U4).

    Returns (rows to append to the state, updated counts per key).  Members
    already stored are removed by an anti-join; the state table can be a
    Parquet table kept across runs."""
    fresh = new.select(key, member).distinct().join(stored.select(key, member), [key, member], "left_anti")
    state = stored.select(key, member).unionByName(fresh)
    counts = state.groupBy(key).agg(F.count(F.lit(1)).alias("uv"))
    return fresh, counts
