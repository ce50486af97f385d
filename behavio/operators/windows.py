"""Tumbling and sliding event-time window counts.

Windows are half-open ``[start, end)`` and aligned to the epoch, the same
as ``F.window``.  Sliding windows are computed from *panes*: rows are
first counted per ``slide``-long pane (a partial + final hash aggregate
that shrinks the data to at most keys x span/slide rows); then either the
pane counts are fanned out to the windows that contain them (up to
``PANE_MAX_OVERLAP`` panes per window) or, above that, the difference
form is used, whose work follows the number of output windows.
``F.window`` would instead replicate every input row size/slide times.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.times import epoch_micros, interval, micros_between, positive_micros, window_text

PANE_MAX_OVERLAP = 12


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def tumbling_count(df: DataFrame, ts: str, size, keys=(), count_col: str = "cnt") -> DataFrame:
    """Rows per (tumbling window, keys): window_start, window_end, keys, cnt."""
    keys = _keys(keys)
    w = F.window(ts, window_text(size))
    return (df.groupBy(w.alias("w"), *keys)
              .agg(F.count(F.lit(1)).alias(count_col))
              .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      *keys, count_col))


def pane_counts(df: DataFrame, ts: str, slide, keys=(), count_col: str = "c") -> DataFrame:
    """Rows per (slide-long pane, keys): columns pane, keys, c."""
    keys = _keys(keys)
    return (df.groupBy(F.window(ts, window_text(slide)).start.alias("pane"), *keys)
              .agg(F.count(F.lit(1)).alias(count_col)))


def sliding_count(df: DataFrame, ts: str, size, slide, keys=(), method: str = "auto",
                  count_col: str = "cnt") -> DataFrame:
    """Rows per (sliding window, keys) for every window holding >= 1 row.

    method: "builtin" (F.window: every row copied size/slide times),
    "panes" (pane counts copied size/slide times), "deltas" (difference
    form expanded per constant stretch: work proportional to the output),
    or "auto" (panes up to PANE_MAX_OVERLAP panes per window, deltas
    above).  When slide does not divide size, panes are their greatest
    common divisor long.  Durations are exact to the microsecond."""
    keys = _keys(keys)
    size_us, slide_us = positive_micros(size), positive_micros(slide)
    pane_us = gcd(size_us, slide_us)
    if method == "auto":
        # Count panes first (raw rows hit the hash aggregate once), then
        # fan the pane counts out; past a dozen overlaps use the
        # difference form, whose work follows the output.
        method = "panes" if size_us // pane_us <= PANE_MAX_OVERLAP else "deltas"
    size_i, slide_i, pane_i = (us / 1_000_000 for us in (size_us, slide_us, pane_us))
    if method == "builtin":
        w = F.window(ts, window_text(size), window_text(slide))
        return (df.groupBy(w.alias("w"), *keys)
                  .agg(F.count(F.lit(1)).alias(count_col))
                  .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                          *keys, count_col))
    if method == "deltas":
        return _expanded(window_deltas(df, ts, size, slide, keys), size_i, slide_i, keys, count_col)
    panes = pane_counts(df, ts, pane_i, keys)
    # A pane from p to p + pane lies in the windows that end at multiples of
    # slide (plus size, as windows start at multiples of slide) from p + pane to p + size.
    offset = size_us % slide_us
    pm = epoch_micros(panes, "pane")
    first = (F.ceil((pm + F.lit(pane_us - offset)) / F.lit(slide_us)) * F.lit(slide_us) + F.lit(offset)).cast("long")
    last = (F.floor((pm + F.lit(size_us - offset)) / F.lit(slide_us)) * F.lit(slide_us) + F.lit(offset)).cast("long")
    shift = F.when(last >= first, F.sequence(first - pm, last - pm, F.lit(slide_us).cast("long")))
    return (panes.select("pane", F.explode(shift).alias("_s"), *keys, "c")
                 .select(F.timestamp_add("MICROSECOND", F.col("_s"), F.col("pane")).alias("window_end"), *keys, "c")
                 .groupBy("window_end", *keys)
                 .agg(F.sum("c").alias(count_col))
                 .select((F.col("window_end") - interval(size_i)).alias("window_start"),
                         "window_end", *keys, count_col))


def _expanded(deltas: DataFrame, size, slide, keys: list[str], count_col: str) -> DataFrame:
    # window ends e, e + slide, ... before next_e
    ends = F.sequence(F.col("e"), F.col("next_e") - interval(slide), interval(slide))
    return deltas.where(F.col("cnt") > 0).select((F.explode(ends)).alias("window_end"), *keys, F.col("cnt").alias(count_col)) \
                 .select((F.col("window_end") - interval(size)).alias("window_start"), "window_end", *keys, count_col)


def sliding_count_of_panes(panes: DataFrame, size, slide, keys=(), count_col: str = "cnt") -> DataFrame:
    """Sliding counts of a table of pane counts (pane, keys, c), panes being
    gcd(size, slide) long, in the difference form."""
    keys = _keys(keys)
    return _expanded(window_deltas(panes, None, size, slide, keys), size, slide, keys, count_col)


def window_deltas(df: DataFrame, ts: str | None, size, slide, keys=(), chunk="1 day", since: str | None = None) -> DataFrame:
    """Difference form of sliding counts (of rows by ``ts``, or of pane counts
    as ``pane_counts`` gives them when ``ts`` is None): per key, one row per window end
    ``e`` where the count changes; ``cnt`` holds for the window ends
    e, e+slide, ..., next_e-slide.

    Pane p adds its count at end p+slide and removes it at p+size+slide, so
    a running sum over ends reproduces every window's count with ~2 x panes
    rows instead of (size/slide) x panes.  The running sum is cut into
    (key, chunk) partitions, chunks being at least ``size`` long: a pane
    still active at a chunk's start adds one *carry-in* row there, so each
    chunk's sum starts from the right count without looking at earlier
    chunks.  One window pass, no self-join; no task handles more than one
    chunk of one key, so a hot key, or no key at all, is spread over many
    tasks.
    With panes, ``since`` may name a column: windows that end before it (microseconds) do not
    count the pane.
    Columns: keys, e, cnt, next_e (null after the last change)."""
    keys = _keys(keys)
    size_us, slide_us = positive_micros(size), positive_micros(slide)
    pane_us, offset = gcd(size_us, slide_us), size_us % slide_us
    chunk_us = max(positive_micros(chunk), size_us)
    chunk_us = -(-chunk_us // slide_us) * slide_us      # a multiple of slide
    # without a time column, df has the panes already
    panes = df if ts is None else pane_counts(df, ts, pane_us / 1_000_000, keys)
    pm = epoch_micros(panes, "pane")
    # first window end that holds the pane, and the first that no longer does;
    # ends are multiples of slide plus the offset, which all arithmetic leaves out
    up = lambda u: F.ceil(u / F.lit(slide_us)) * F.lit(slide_us)
    u0 = up(pm + F.lit(pane_us - offset)).cast("long")
    u1 = (F.floor((pm + F.lit(size_us - offset)) / F.lit(slide_us)) * F.lit(slide_us) + F.lit(slide_us)).cast("long")
    if since is not None:
        u0 = F.greatest(u0, up(F.col(since) - F.lit(offset)).cast("long"))
    at = lambda u: F.timestamp_add("MICROSECOND", u + F.lit(offset) - pm, F.col("pane"))
    e0, e1 = at(u0), at(u1)
    panes = panes.where(u0 < u1)                        # slide > size: a pane may lie between windows
    k0, k1 = F.floor(u0 / F.lit(chunk_us)), F.floor(u1 / F.lit(chunk_us))
    uc = k1 * F.lit(chunk_us)                                      # start of e1's chunk
    rows = F.array(
        F.struct(e0.alias("e"), u0.alias("u"), F.col("c").alias("d"), k0.alias("k")),
        F.struct(e1.alias("e"), u1.alias("u"), (-F.col("c")).alias("d"), k1.alias("k")),
        F.when(k1 > k0, F.struct(F.timestamp_add("MICROSECOND", uc - u1, e1).alias("e"), uc.alias("u"),
                                 F.col("c").alias("d"), k1.alias("k"))))
    d = (panes.select(*keys, F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("x"))
              .select(*keys, "x.e", "x.u", "x.d", F.col("x.k").alias("_chunk")))
    w = Window.partitionBy(*keys, "_chunk").orderBy("e")
    # RANGE frame: rows sharing an end all see the sum after every change at it.
    cnt = F.sum("d").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    out = d.select(*keys, "e", "u", "_chunk", cnt.alias("cnt"), F.lead("e").over(w).alias("_next"))
    # keep one row per end; the chunk's last row runs to the next chunk's
    # start while windows are non-empty (a carry-in row sits there).
    to_next_chunk = F.timestamp_add("MICROSECOND", (F.col("_chunk") + 1) * F.lit(chunk_us) - F.col("u"), F.col("e"))
    next_e = F.coalesce(F.col("_next"), F.when(F.col("cnt") > 0, to_next_chunk))
    return (out.where(F.col("_next").isNull() | (F.col("_next") != F.col("e")))
               .select(*keys, "e", "cnt", next_e.alias("next_e")))


def sliding_runs(df: DataFrame, ts: str, size, slide, keys=()) -> DataFrame:
    """All sliding windows that hold a row, neighbours of one key, UTC day (of the window's end) and count as one
    row: the result of ``sliding_count`` in a form that grows with the rows, not with size / slide.

    Columns: keys, first_end, last_end (of windows that are ``slide`` apart), cnt."""
    keys = _keys(keys)
    day = 86_400_000_000
    d = window_deltas(df, ts, size, slide, keys, chunk="1 day").where("cnt > 0")
    if day % positive_micros(slide) or positive_micros(size) > day:
        raise ValueError("a day must hold whole slides, and a window")
    d = d.withColumn("_day", F.floor(epoch_micros(d, "e") / F.lit(day)))
    w = Window.partitionBy(*keys, "_day").orderBy("e")
    same = (F.lag("cnt").over(w) == F.col("cnt")) & (F.lag("next_e").over(w) == F.col("e"))
    d = d.withColumn("_new", F.when(same, 0).otherwise(1)).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (d.groupBy(*keys, "_day", "_run").agg(F.min("e").alias("first_end"), F.max("next_e").alias("_next"), F.first("cnt").alias("cnt"))
            .select(*keys, "first_end", (F.col("_next") - interval(slide)).alias("last_end"), "cnt"))


def sliding_peak(df: DataFrame, ts: str, size, slide, keys=(), peak_col: str = "peak") -> DataFrame:
    """Per key: the largest sliding-window count, the first window end at
    which it occurs, and how many windows hold >= 1 row."""
    keys = _keys(keys)
    d = window_deltas(df, ts, size, slide, keys)
    n_windows = F.when(F.col("cnt") > 0, micros_between(d, "e", "next_e") / F.lit(positive_micros(slide)))
    return (d.groupBy(*keys).agg(
                F.max("cnt").alias(peak_col),
                F.min_by("e", F.struct(-F.col("cnt"), F.col("e"))).alias("peak_window_end"),
                F.sum(n_windows).cast("long").alias("windows")))


def drop_static_urls(df: DataFrame, url: str = "url", suffixes=("css", "js")) -> DataFrame:
    """drop requests for static resources (URLs ending in .css / .js)."""
    from ..functions.urls import is_static_resource
    return df.where(~is_static_resource(url, suffixes))
