"""Per-key event patterns (E1-E7) over the total order (ts, seq).

All use window functions over ``partitionBy(key).orderBy(ts, seq)``
(one sort per key; Spark shares it between window expressions with the
same spec).  Frames are always growing frames (``unboundedPreceding ..
k``), which Spark evaluates incrementally; "the next later event" is
found by reversing the order instead of using an O(n^2)
``unboundedFollowing`` frame.  Only the greedy burst detector (E4) needs
Python, to follow the chains of islands with several bursts, see ``bursts``.
"""

from __future__ import annotations

from collections import deque

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.times import epoch_micros, interval, micros_between, positive_micros, seconds_of, utc_ntz

# Fixed result texts of the reference jobs.
PAY_OK, PAY_TIMEOUT = "successfully", "timeout"
DEADLINE_OK, DEADLINE_TIMEOUT = "Order Pay Successfully", "Order Pay Timeout"


def _cond(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _order(key: str, ts: str, seq: str, desc: bool = False) -> Window:
    if desc:
        return Window.partitionBy(key).orderBy(F.col(ts).desc(), F.col(seq).desc())
    return Window.partitionBy(key).orderBy(ts, seq)


def _bucketed(df: DataFrame, key: str, ts: str, seq: str, width, k: int, heads: DataFrame | None = None) -> DataFrame:
    """Rows tagged with a time bucket ``_b`` of ``width`` (>= the pattern's
    horizon) plus *lookahead* rows: the first ``k`` rows of bucket b+1 (of
    ``heads``, rows of the same columns, if given), copied into bucket b with
    ``_la = true``.  A per-(key, bucket) window then sees every event up
    to the horizon after each real row, so patterns bounded by the horizon
    are exact while a hot key is split over its buckets.  The lookahead is
    a ``row_number() <= k`` cut, planned with a partial WindowGroupLimit
    before the shuffle."""
    width_us = positive_micros(width)
    x = df.withColumn("_b", F.floor(epoch_micros(df, ts) / F.lit(width_us)))
    heads = x if heads is None else heads.withColumn("_b", F.floor(epoch_micros(heads, ts) / F.lit(width_us)))
    wb = Window.partitionBy(key, "_b").orderBy(ts, seq)
    heads = (heads.withColumn("_r", F.row_number().over(wb)).where(F.col("_r") <= k).drop("_r")
                  .withColumn("_b", F.col("_b") - 1).withColumn("_la", F.lit(True)))
    return x.withColumn("_la", F.lit(False)).unionByName(heads)


def strict_sequence(df: DataFrame, key: str, ts: str, seq: str, cond, steps: int = 2,
                    within="2 seconds", strict: bool = True, bucket: bool = True) -> DataFrame:
    """``steps`` consecutive events of a key that all satisfy ``cond``,
    the last less than ``within`` after the first (``strict=False``: at
    most).  Overlapping matches are all emitted.

    ``bucket=True`` evaluates per (key, time bucket of width ``within``)
    with the next bucket's first steps-1 events as lookahead (see
    ``_bucketed``); ``bucket=False`` uses one window per key.

    Columns: key, first_ts, last_ts, first_seq, n."""
    x = df.select(key, ts, seq, F.coalesce(_cond(cond), F.lit(False)).alias("_c"))
    if bucket and steps > 1:
        x = _bucketed(x, key, ts, seq, within, steps - 1)
        w = Window.partitionBy(key, "_b").orderBy(ts, seq)
    else:
        x = x.withColumn("_la", F.lit(False))
        w = _order(key, ts, seq)
    ok = F.col("_c")
    for k in range(1, steps):
        ok = ok & F.coalesce(F.lead("_c", k).over(w), F.lit(False))
    last = F.lead(ts, steps - 1).over(w) if steps > 1 else F.col(ts)
    bound = F.col(ts) + interval(within)
    x = x.select(key, ts, seq, "_la", ok.alias("_ok"), last.alias("last_ts"))
    in_time = (F.col("last_ts") < bound) if strict else (F.col("last_ts") <= bound)
    return (x.where(~F.col("_la") & F.col("_ok") & in_time)
             .select(key, F.col(ts).alias("first_ts"), "last_ts", F.col(seq).alias("first_seq"),
                     F.lit(steps).cast("long").alias("n")))


def followed_by(df: DataFrame, key: str, ts: str, seq: str, first, then, within="15 minutes",
                strict: bool = True, bucket: bool = True) -> DataFrame:
    """Each ``first`` event is paired with the first later ``then``
    event of its key; it succeeds when that event comes less than
    ``within`` later (``strict=False``: at most), else it times out.

    The next ``then`` event is found with a reversed growing frame
    (incremental, not an O(n^2) following frame).  ``bucket=True`` runs it
    per (key, time bucket of width ``within``) with the next bucket's first
    ``then`` event as lookahead: a later event beyond that is more than
    ``within`` away and could not succeed anyway.

    Columns: key, first_ts, first_seq, then_ts (null on timeout),
    then_seq, kind ('successfully' | 'timeout')."""
    # only the two kinds of events matter; the bare condition reaches the scan
    df = df.where(_cond(first) | _cond(then))
    x = df.select(key, ts, seq, F.coalesce(_cond(first), F.lit(False)).alias("_f"),
                  F.coalesce(_cond(then), F.lit(False)).alias("_t"))
    if bucket:
        heads = df.where(_cond(then)).select(key, ts, seq, F.coalesce(_cond(first), F.lit(False)).alias("_f"),
                                             F.lit(True).alias("_t"))
        x = _bucketed(x, key, ts, seq, within, 1, heads=heads)
        w = (Window.partitionBy(key, "_b").orderBy(F.col(ts).desc(), F.col(seq).desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    else:
        x = x.withColumn("_la", F.lit(False))
        w = _order(key, ts, seq, desc=True).rowsBetween(Window.unboundedPreceding, -1)
    nxt = F.min(F.when(F.col("_t"), F.struct(F.col(ts).alias("t"), F.col(seq).alias("s")))).over(w)
    x = x.select(key, ts, seq, "_f", "_la", nxt.alias("_n"))
    bound = F.col(ts) + interval(within)
    ok = (F.col("_n.t") < bound) if strict else (F.col("_n.t") <= bound)
    ok = F.coalesce(ok, F.lit(False))
    return (x.where(F.col("_f") & ~F.col("_la"))
             .select(key, F.col(ts).alias("first_ts"), F.col(seq).alias("first_seq"),
                     F.when(ok, F.col("_n.t")).alias("then_ts"),
                     F.when(ok, F.col("_n.s")).alias("then_seq"),
                     F.when(ok, F.lit(PAY_OK)).otherwise(F.lit(PAY_TIMEOUT)).alias("kind")))


def deadline(df: DataFrame, key: str, ts: str, seq: str, first, then, within="15 minutes",
             bucket: bool = True) -> DataFrame:
    """A deadline ``within`` after each ``first`` event; success when
    a later ``then`` event of the key arrives by the deadline (inclusive).

    Columns: key, create_ts, result, pay_ts, delay_min (whole minutes from
    create to pay, null on timeout), deadline_min."""
    r = followed_by(df, key, ts, seq, first, then, within, strict=False, bucket=bucket)
    ok = F.col("kind") == PAY_OK
    delay = F.floor(micros_between(r, "first_ts", "then_ts") / F.lit(60_000_000)).cast("long")
    return r.select(key, F.col("first_ts").alias("create_ts"),
                    F.when(ok, F.lit(DEADLINE_OK)).otherwise(F.lit(DEADLINE_TIMEOUT)).alias("result"),
                    F.col("then_ts").alias("pay_ts"), delay.alias("delay_min"),
                    F.lit(int(seconds_of(within) // 60)).cast("long").alias("deadline_min"))


def _islands(df: DataFrame, key: str, ts: str, seq: str, cond, max_gap) -> DataFrame:
    """Rows satisfying ``cond`` with an island id per key: a new island
    starts when the previous event of the key does not satisfy ``cond`` or
    is more than ``max_gap`` earlier."""
    w = _order(key, ts, seq)
    x = df.select(key, ts, seq, _cond(cond).alias("_c"))
    prev_c = F.lag("_c").over(w)
    prev_t = F.lag(ts).over(w)
    brk = (~F.coalesce(prev_c, F.lit(False))) | (F.col(ts) > prev_t + interval(max_gap))
    x = x.withColumn("_start", (F.col("_c") & brk).cast("int"))
    x = x.withColumn("island", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return x.where("_c").drop("_c", "_start")


#: Buckets that one task scans of one key.
CARRY_BLOCK = 4096


def _carry(df: DataFrame, part: list[str], order: str, n: Column, t: Column, s: Column, since: Column, name: str) -> DataFrame:
    """Adds, from the earlier rows of a partition in ``order``: the time and
    seq of the last run start (``_t``, ``_s``), the run's rows up to this row
    (``_n``), and the rows up to and with this row (``_rows``).  A row stands for ``n`` rows,
    of which ``since`` follow its own last start (null without one)."""
    w = Window.partitionBy(*part).orderBy(order)
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    x = df.withColumn(f"{name}_rows", F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    x = x.withColumn(f"{name}_a", since - F.col(f"{name}_rows"))
    return (x.withColumn(f"{name}_t", F.last(t, ignorenulls=True).over(before))
             .withColumn(f"{name}_s", F.last(s, ignorenulls=True).over(before))
             .withColumn(f"{name}_n", F.last(f"{name}_a", ignorenulls=True).over(before) + F.col(f"{name}_rows") - n)
             .drop(f"{name}_a"))


def _run_positions(df: DataFrame, key: str, ts: str, seq: str, cond, max_gap) -> DataFrame:
    """``cond`` rows with their run (island) start and 1-based position,
    computed per (key, time bucket of width ``max_gap``) so a hot key is
    split over its buckets.

    * Run starts are exact from a one-row lookbehind (the previous bucket's
      last event; anything earlier is more than ``max_gap`` away).
    * A row after the first start of its bucket counts from that start.
    * Rows before it continue a run from earlier buckets: a small table of
      per-bucket summaries (fail rows, last start, rows since it) is
      scanned per key in bucket order to carry the start and the count in.
      A run can only continue through consecutive, all-``cond`` buckets.

    Columns: key, ts, seq, next_other_ts (time of the following event
    when it is not a ``cond`` one and at most one bucket later), run_start
    (ts), run_id (seq of the run's first row), pos."""
    width_us = positive_micros(max_gap)
    x = (df.select(key, ts, seq, F.coalesce(_cond(cond), F.lit(False)).alias("_c"))
           .withColumn("_b", F.floor(epoch_micros(df, ts) / F.lit(width_us))))
    wb = Window.partitionBy(key, "_b").orderBy(ts, seq)
    tail = (x.withColumn("_r", F.row_number().over(Window.partitionBy(key, "_b")
                                                   .orderBy(F.col(ts).desc(), F.col(seq).desc())))
             .where(F.col("_r") == 1).drop("_r")
             .withColumn("_b", F.col("_b") + 1).withColumn("_lb", F.lit(True)))
    # (head: the next bucket's first event, for the event after a run)
    head = (x.withColumn("_r", F.row_number().over(wb)).where(F.col("_r") == 1).drop("_r")
             .withColumn("_b", F.col("_b") - 1).withColumn("_lb", F.lit(True)))
    u = x.withColumn("_lb", F.lit(False)).unionByName(tail).unionByName(head)
    brk = (~F.coalesce(F.lag("_c").over(wb), F.lit(False))) | (F.col(ts) > F.lag(ts).over(wb) + interval(max_gap))
    # time of the next event when it is not a ``cond`` one (ends the run)
    nxt_other = F.when(~F.lead("_c").over(wb), F.lead(ts).over(wb))
    real = F.col("_b") == F.floor(epoch_micros(df, ts) / F.lit(width_us))
    u = (u.withColumn("_start", F.col("_c") & brk).withColumn("next_other_ts", nxt_other)
          .where(F.col("_c") & real))
    upto = wb.rowsBetween(Window.unboundedPreceding, 0)
    u = (u.withColumn("_idx", F.count(F.lit(1)).over(upto))
          .withColumn("_nst", F.sum(F.col("_start").cast("int")).over(upto))
          .withColumn("_ls", F.last(F.when(F.col("_start"), F.struct(F.col(ts).alias("t"), F.col("_idx").alias("i"),
                                                                     F.col(seq).alias("s"))),
                                    ignorenulls=True).over(upto)))
    # ``u`` feeds both the bucket summaries and the final rows; both read the
    # same shuffle of (key, bucket), which Spark runs once.
    last = F.max(F.when(F.col("_start"), F.struct(F.col(ts).alias("t"), F.col("_idx").alias("i"), F.col(seq).alias("s"))))
    per_b = u.groupBy(key, "_b").agg(F.count(F.lit(1)).alias("_n"), last.alias("_last"))
    # The carry runs over a key's buckets in two levels, so that no task scans
    # all buckets of a hot key: within a block of buckets, and over the blocks.
    per_b = per_b.withColumn("_d", F.floor(F.col("_b") / F.lit(CARRY_BLOCK)))
    inner = _carry(per_b, [key, "_d"], "_b", F.col("_n"), F.col("_last.t"), F.col("_last.s"),
                   F.col("_n") - F.col("_last.i") + 1, "_w").withColumn("_w_rows", F.col("_w_rows") - F.col("_n"))
    blocks = inner.groupBy(key, "_d").agg(
        F.sum("_n").alias("_bn"),
        F.max(F.when(F.col("_last").isNotNull(), F.struct("_b", "_w_rows", "_n", "_last"))).alias("_x"))
    # rows of the block from its last start on
    since = F.col("_bn") - F.col("_x._w_rows") - F.col("_x._last.i") + 1
    outer = _carry(blocks, [key], "_d", F.col("_bn"), F.col("_x._last.t"), F.col("_x._last.s"), since, "_o")
    # a null key is a key
    outer = outer.select(F.col(key).alias("_ok"), F.col("_d").alias("_od"), "_o_t", "_o_s", "_o_n")
    per_b = (inner.join(outer, F.col(key).eqNullSafe(F.col("_ok")) & (F.col("_d") == F.col("_od")))
             .select(F.col(key).alias("_pk"), F.col("_b").alias("_pb"), F.coalesce("_w_t", "_o_t").alias("_carry_t"), F.coalesce("_w_s", "_o_s").alias("_carry_s"),
                     F.coalesce(F.col("_w_n"), F.col("_o_n") + F.col("_w_rows")).alias("_carry_n")))
    r = u.join(per_b, F.col(key).eqNullSafe(F.col("_pk")) & (F.col("_b") == F.col("_pb")), "left")
    carried = F.col("_nst") == 0
    return r.select(key, ts, seq, "next_other_ts",
                    F.when(carried, F.col("_carry_t")).otherwise(F.col("_ls.t")).alias("run_start"),
                    F.when(carried, F.col("_carry_s")).otherwise(F.col("_ls.s")).alias("run_id"),
                    F.when(carried, F.col("_carry_n") + F.col("_idx"))
                     .otherwise(F.col("_idx") - F.col("_ls.i") + 1).cast("long").alias("pos"))


def runs(df: DataFrame, key: str, ts: str, seq: str, cond, max_gap="2 seconds",
         min_len: int = 3, bucket: bool = True) -> DataFrame:
    """E5: runs of consecutive ``cond`` events of a key, each at most
    ``max_gap`` after the previous one; any other event ends the run.  One
    alert per event at position >= ``min_len`` in its run.
    ``bucket=True``: per (key, time bucket), see ``_run_positions``;
    ``bucket=False``: gaps-and-islands over one window per key.

    Columns: key, first_ts (run start), last_ts (this event), seq, fails."""
    if bucket:
        p = _run_positions(df, key, ts, seq, cond, max_gap)
        return (p.where(F.col("pos") >= min_len)
                 .select(key, F.col("run_start").alias("first_ts"), F.col(ts).alias("last_ts"), seq,
                         F.col("pos").alias("fails")))
    x = _islands(df, key, ts, seq, cond, max_gap)
    wi = Window.partitionBy(key, "island").orderBy(ts, seq)
    x = (x.withColumn("fails", F.row_number().over(wi).cast("long"))
          .withColumn("first_ts", F.first(ts).over(wi.rowsBetween(Window.unboundedPreceding, 0))))
    return (x.where(F.col("fails") >= min_len)
             .select(key, "first_ts", F.col(ts).alias("last_ts"), seq, "fails"))


#: Groups of spans in which the links of a long island are contracted, level by level.
LINK_GROUPS = (64, 64 * 64)


def bursts(df: DataFrame, key: str, ts: str, seq: str, cond, span="2 seconds",
           min_exclusive: int = 2) -> DataFrame:
    """A ``cond`` event with no open burst opens one; ``cond`` events
    up to ``span`` after the opener (inclusive) join it; any other event of
    the key cancels it; the burst is reported at its timer (opener + span)
    when it holds more than ``min_exclusive`` events.

    Openers are found island by island (``cond`` events with gaps <= span; any other
    event, or a larger gap, resets the chain).  An island's first event is one.  Each
    event links to the first one more than ``span`` later, where the next burst would open
    if it were an opener itself: at most two spans away, so links, sizes and last events come
    from windows over (key, island, time group) with two spans of lookahead.

    Which links the chain takes is decided without folding an island as a whole: in every
    group of ``LINK_GROUPS[0]`` spans, links are contracted to where the chain leaves the group; of these only the
    events at the group's beginning can be entered, and they are contracted again in wider groups.
    From the island's first event the chain is then followed over the widest groups, from the entries so
    found inside of the narrower ones, and so on.  A task remembers what links can reach; the
    last step over a whole island reads its entries, a two thousandth of its time.  Islands
    of a single burst have no links and never reach Python.

    Columns: key, first_ts, last_ts, fails."""
    span_us = positive_micros(span)
    p = _run_positions(df, key, ts, seq, cond, span)
    nodes = (p.select(F.col(key).alias("k"), F.col("run_id").alias("run"), epoch_micros(p, ts).alias("us"),
                      epoch_micros(p, "run_start").alias("head"), epoch_micros(p, "next_other_ts").alias("other"))
             .groupBy("k", "run", "us").agg(F.count(F.lit(1)).alias("c"), F.min("head").alias("head"), F.max("other").alias("other")))
    wide = F.lit(LINK_GROUPS[0] * span_us)
    nodes = nodes.withColumn("g", F.floor(F.col("us") / wide)).withColumn("copy", F.lit(False))
    ahead = nodes.where(F.col("us") - F.col("g") * wide < 2 * span_us).withColumn("g", F.col("g") - 1).withColumn("copy", F.lit(True))
    w = Window.partitionBy("k", "run", "g").orderBy("us")
    within = w.rangeBetween(0, span_us)
    nodes = (nodes.unionByName(ahead)
             .select("k", "run", "us", "head", "copy", F.sum("c").over(within).alias("n"), F.max("us").over(within).alias("last"),
                     F.max("other").over(within).alias("stop"), F.min("us").over(w.rangeBetween(span_us + 1, 2 * span_us)).alias("to"))
             .where(~F.col("copy")).drop("copy"))
    # with all columns, so that the windows above are shuffled and computed once for all uses
    taken = _chain(nodes.where("to IS NOT NULL"), span_us).select(
        F.col("k").alias("taken_k"), F.col("run").alias("taken_run"), F.col("to").alias("taken_us"))
    on = F.col("k").eqNullSafe(F.col("taken_k")) & (F.col("run") == F.col("taken_run")) & (F.col("us") == F.col("taken_us"))
    openers = nodes.join(taken, on, "left").where("us = head OR taken_us IS NOT NULL")
    # a burst before another one has run to its timer; the last one may be cancelled by the event after the island
    out = openers.where((F.col("n") > min_exclusive) & (F.col("to").isNotNull() | F.col("stop").isNull() | (F.col("stop") > F.col("us") + span_us)))
    ntz = df.schema[ts].dataType.simpleString() == "timestamp_ntz"
    back = lambda c: utc_ntz(F.col(c)) if ntz else F.timestamp_micros(F.col(c))
    return out.select(F.col("k").alias(key), back("us").alias("first_ts"), back("last").alias("last_ts"), F.col("n").cast("long").alias("fails"))


def _chain(links: DataFrame, span_us: int) -> DataFrame:
    """The ``links`` (k, run, us, head, to) on the chains from the heads, as (k, run, us, to)."""
    levels, reach = [links], 2 * span_us
    for spans in LINK_GROUPS:
        wide = F.lit(spans * span_us)
        start = F.floor(F.col("us") / wide) * wide
        # a chain enters a group in its first two spans
        entry = (F.col("us") - start < 2 * span_us) | (F.col("us") == F.col("head"))
        levels.append(_folded(levels[-1], wide, F.col("us").desc(), _contract(reach)).where(entry))
        reach = (spans + 2) * span_us
    taken = _folded(levels.pop(), None, F.col("us"), _follow)
    for spans in reversed(LINK_GROUPS):
        entries = taken.select("k", "run", F.col("to").alias("us"), "head", F.lit(None).cast("long").alias("to"))
        level = levels.pop()
        entries = entries.select(*[c if c in entries.columns else F.lit(None).cast(level.schema[c].dataType).alias(c) for c in level.columns])
        # of an entry and its own link, the entry comes first
        order = F.struct(F.col("us"), F.col("to").isNotNull())
        taken = _folded(level.unionByName(entries), F.lit(spans * span_us), order, _follow)
    return taken


def _folded(rows: DataFrame, wide: Column | None, order: Column, fold) -> DataFrame:
    """``fold`` over the rows of each (k, run, group of ``wide`` microseconds) in ``order``."""
    g = F.lit(0).cast("long") if wide is None else F.floor(F.col("us") / wide)
    x = rows.withColumn("g", g)
    names = ["k", "run", "us", "head", "to"]
    ddl = ", ".join(f"{c} {x.schema[c].dataType.simpleString()}" for c in names)
    dealt = x.repartition("k", "run", "g").sortWithinPartitions("k", "run", "g", order)

    def over(batches):
        group, state = None, None
        for pdf in batches:
            # links may be null, and stay integers
            to = [None if t is None else int(t) for t in pdf["to"].astype(object).where(pdf["to"].notna(), None)]
            out = []
            rows = zip(*(pdf[c].tolist() for c in ("k", "run", "g", "us", "head")), to)
            for i, (k, run, part, us, head, t) in enumerate(rows):
                # a null key is not equal to itself
                if group is None or (part, run) != group[1:] or (k != group[0] and not (k != k and group[0] != group[0])):
                    group, state = (k, part, run), _Chain()
                found = fold(state, us, t, us == head)
                if found is not None:
                    out.append((i, found))
            if out:
                kept = pdf[names].iloc[[i for i, _ in out]].copy()
                kept["to"] = np.array([t for _, t in out], dtype=np.int64)
                yield kept

    return dealt.mapInPandas(over, ddl)


class _Chain:
    """What a fold remembers of one group: exits by time and, in falling order, their times; where a walk is."""

    def __init__(self):
        self.exits, self.times, self.at = {}, deque(), None


def _contract(reach: int):
    """For links in falling order, none longer than ``reach``: where the chain from ``to`` leaves the group, or ends."""
    def exit_of(later: _Chain, us: int, to: int, is_head: bool) -> int:
        while later.times and later.times[0] > us + reach:
            del later.exits[later.times.popleft()]
        out = later.exits[us] = later.exits.get(to, to)
        later.times.append(us)
        return out
    return exit_of


def _follow(walk: _Chain, us: int, to: int | None, is_head: bool) -> int | None:
    """Links come in rising order, entries without ``to``: the link, if the chain is at it."""
    if to is not None and not is_head and walk.at != us:
        return None
    walk.at = us if to is None else to
    return to
