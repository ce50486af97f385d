"""Stream forms of the window, distinct, top-N and join operators.

All run in append mode: a window's row is emitted once, when the
watermark passes its end, and its state is dropped then."""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, functions as F

from ..functions.times import interval, positive_micros, window_text


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys or ())


def windowed_count(stream: DataFrame, ts: str, size, slide=None, keys=(), count_col: str = "cnt") -> DataFrame:
    keys = _keys(keys)
    w = F.window(ts, window_text(size), window_text(slide)) if slide else F.window(ts, window_text(size))
    return (stream.groupBy(w.alias("window"), *keys).agg(F.count(F.lit(1)).alias(count_col)))


def pane_sliding_count(stream: DataFrame, ts: str, size, slide, keys=(), count_col: str = "cnt") -> DataFrame:
    """Sliding-window counts on a stream from pane counts: a first windowed
    aggregation counts rows per slide-long pane, a second one slides over
    ``window_time(pane)``.  The size/slide fan-out is applied to pane rows
    instead of raw rows (both stages in append mode, chained watermarks)."""
    keys = _keys(keys)
    pane = gcd(positive_micros(slide), positive_micros(size)) / 1_000_000
    panes = stream.groupBy(F.window(ts, window_text(pane)).alias("pane"), *keys).agg(
        F.count(F.lit(1)).alias("_c"))
    w = F.window(F.window_time("pane"), window_text(size), window_text(slide))
    return panes.groupBy(w.alias("window"), *keys).agg(F.sum("_c").alias(count_col))


def flatten_window(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    return df.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest)


def chained_unique(stream: DataFrame, ts: str, size, user: str, out: str = "uv") -> DataFrame:
    """Exact distinct users per tumbling window on a stream: Spark refuses
    count_distinct on streams, so first (window, user) pairs are formed by
    one aggregation and then counted per window by a second one."""
    pairs = windowed_count(stream, ts, size, keys=[user], count_col="_n")
    return pairs.groupBy("window").agg(F.count(F.lit(1)).alias(out))


def approx_unique(stream: DataFrame, ts: str, size, user: str, out: str = "uv_approx") -> DataFrame:
    """Approximate distinct users per tumbling window on a stream (U5):
    HLL++ state of bounded size per window, instead of the exact chained
    form's one state row per (window, user)."""
    w = F.window(ts, window_text(size))
    return stream.groupBy(w.alias("window")).agg(F.approx_count_distinct(user).alias(out))


def stream_interval_join(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str,
                         lower="-10 seconds", upper="10 seconds", how: str = "inner") -> DataFrame:
    """Stream-stream band join (J1; ``how="left_outer"`` adds J3, the left
    rows without a partner).  Both sides need watermarks; the literal band
    bounds let Spark drop each side's rows from state once the other
    side's watermark has passed them, and emit unmatched left rows then."""
    l, r = left.alias("l"), right.alias("r")
    cond = ((F.col(f"l.{key}") == F.col(f"r.{key}"))
            & (F.col(f"r.{rts}") >= F.col(f"l.{lts}") + interval(lower))
            & (F.col(f"r.{rts}") <= F.col(f"l.{lts}") + interval(upper)))
    cols = [F.col(f"l.{key}").alias(key)] + [F.col(f"l.{c}") for c in left.columns if c != key] \
        + [F.col(f"r.{c}") for c in right.columns if c != key]
    return l.join(r, cond, how).select(*cols)


def top_n_per_batch(by: str, order_col: str, key: str, n: int, rank_base: int = 1):
    """A ``foreachBatch`` ranking for windowed counts in append mode: a
    window's counts are all emitted in the micro-batch in which the
    watermark passes its end, so ranking inside each batch is exact, and
    the batch ``top_n`` keeps at most n rows per window and map task."""
    from ..operators.topn import top_n

    def rank(batch_df: DataFrame) -> DataFrame:
        return top_n(batch_df, by, order_col, key, n, rank_base)

    return rank
