"""Keyed stream patterns in event-time order (``applyInPandasWithState``).

Rows of a key wait in state until the watermark has passed them; then they
are taken in (time, seq) order, so rows that arrive out of order within the
watermark's delay give the batch result.  Keys are dealt by hash into buckets, of which each has one state: the
waiting rows and the patterns' values of its keys.  A call is made by new rows of a bucket or by a
timer at its earliest waiting row or deadline, so the number of calls does not grow with the keys; a
key with nothing to wait for keeps no state.  State grows with the rows inside the delay
and one micro-batch, which ``table_stream``'s trigger limit bounds.

Times are microseconds since the epoch in a long column (see
``with_micros``): nothing passes through the session time zone.  Rows behind
the watermark are dropped by Spark before they get here; the runner reports
their number.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F

DAY_US = 86_400_000_000
#: Groups of keys, each with one state: a call and a state cost far more than a key's rows.
BUCKETS = 1024
WHOLE = ("tinyint", "smallint", "int", "bigint")


class Pattern:
    """What is done with a key's rows in order.

    ``state_ddl`` declares its own state columns, ``start`` is their value for a
    new key, ``out_ddl`` its result columns after the keys."""

    state_ddl = ""
    start: tuple = ()
    out_ddl = ""
    #: Columns of the rows that order them: the time, the seq, and further values.
    ordered_by = 2

    def step(self, state: tuple, rows: list[tuple], out: list[tuple]) -> tuple:
        """Take (us, seq, *values) rows in order, append results, return the state."""
        raise NotImplementedError

    def due(self, state: tuple) -> int | None:
        """The time (us) at which something is to be done without a row."""
        return None

    def expire(self, state: tuple, now: int, out: list[tuple]) -> tuple:
        """All rows up to ``now`` have been taken."""
        return state


def ordered(stream, keys: list[str], pattern: Pattern, us: str, seq: str, values: list[str], buckets: int = BUCKETS):
    """``pattern`` over each key of ``stream`` in event-time order; the stream needs a
    watermark.  Result: keys, then the pattern's columns.  The state is that of
    ``buckets`` groups of keys and fixed for a query's lifetime."""
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    # a whole number that may be null would be a float in pandas
    whole = {c for c in (*keys, seq, *values) if kinds[c] in WHOLE}
    text = lambda c: "string" if c in whole else kinds[c]
    own = [p.strip().split(" ", 1) for p in pattern.state_ddl.split(",") if p.strip()]
    buffer = [(us, kinds[us]), (seq, kinds[seq]), *[(v, kinds[v]) for v in values]]
    state_ddl = ", ".join([*[f"k{i} array<{text(k)}>" for i, k in enumerate(keys)], *[f"o{i} array<{t}>" for i, (_, t) in enumerate(own)],
                           *[f"w{i} array<{text(k)}>" for i, k in enumerate(keys)], *[f"b{i} array<{t}>" for i, (_, t) in enumerate(buffer)]])
    out_ddl = ", ".join([*[f"`{k}` {text(k)}" for k in keys], pattern.out_ddl])
    out_names = [p.strip().split(" ")[0] for p in pattern.out_ddl.split(",")]
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket")
    rows = stream.withColumn("_bucket", bucket).withColumns({c: F.col(c).cast("string") for c in whole})
    found = rows.groupBy("_bucket").applyInPandasWithState(
        _state_fn(keys, pattern, len(own), [us, seq, *values], out_names, whole), out_ddl, state_ddl, "append", "EventTimeTimeout")
    return found.withColumns({k: F.col(k).cast(kinds[k]) for k in keys if k in whole})


def _plain(series: pd.Series, whole: bool = False) -> list:
    found = [None if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else v
             for v in series.astype(object).tolist()]
    return [None if v is None else int(v) for v in found] if whole else found


def _state_fn(keys: list[str], pattern: Pattern, n_own: int, columns: list[str], out_names: list[str], whole: set[str]) -> Callable:
    n = len(keys)

    def fn(bucket, frames, state):
        stored = tuple(state.get) if state.exists else None
        own = dict(zip(zip(*stored[:n]), zip(*stored[n:n + n_own]))) if stored else {}
        waiting = list(zip(*stored[n + n_own:])) if stored else []
        if not state.hasTimedOut:
            for pdf in frames:
                waiting += zip(*[_plain(pdf[k]) for k in keys], *[_plain(pdf[c], c in whole) for c in columns])
        now = state.getCurrentWatermarkMs() * 1000
        ready: dict[tuple, list[tuple]] = {key: [] for key in own}
        later = []
        for r in waiting:
            if r[n] <= now:
                ready.setdefault(r[:n], []).append(r[n:])
            else:
                later.append(r)
        left, kept, out, owners = {r[:n] for r in later}, {}, [], []
        wake = min((r[n] for r in later), default=None)
        for key, rows in ready.items():
            value = own.get(key, pattern.start)
            if rows:
                rows.sort(key=lambda r: [(v is not None, v) for v in r[:pattern.ordered_by]])
                value = pattern.step(value, rows, out)
            value = pattern.expire(value, now, out)
            owners += [key] * (len(out) - len(owners))
            due = pattern.due(value)
            if due is not None:
                wake = due if wake is None else min(wake, due)
            if due is not None or key in left:
                kept[key] = value
        if wake is not None:
            state.update((*_columns(list(kept), n), *_columns(list(kept.values()), n_own), *_columns(later, n + len(columns))))
            state.setTimeoutTimestamp(max(-(-wake // 1000), state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        if out:
            cols = [*zip(*owners), *zip(*out)]
            yield pd.DataFrame({c: pd.Series(list(v), dtype=object) for c, v in zip([*keys, *out_names], cols)})
    return fn


def _columns(rows: list[tuple], n: int) -> list[list]:
    return [list(c) for c in zip(*rows)] if rows else [[] for _ in range(n)]


class Quota(Pattern):
    """Per UTC day of event time, the first ``max_passed`` rows pass,
    the next raises one alert, the rest are dropped."""

    state_ddl = "day long, n long"
    start = (None, 0)
    out_ddl = "seq long, us long, n long, kind string"

    def __init__(self, max_passed: int):
        self.max_passed = max_passed

    def step(self, state, rows, out):
        day, n = state
        for us, seq, *_ in rows:
            if us // DAY_US != day:
                day, n = us // DAY_US, 0
            if n <= self.max_passed:
                n += 1
                out.append((seq, us, n, "pass" if n <= self.max_passed else "alert"))
        return day, n

    def due(self, state):
        return None if state[0] is None else (state[0] + 1) * DAY_US

    def expire(self, state, now, out):
        return self.start if state[0] is not None and (state[0] + 1) * DAY_US <= now else state


class FollowedBy(Pattern):
    """Each ``first`` row waits for the key's next ``then`` row: in
    time it succeeds, else it times out.  Rows carry whether they are first."""

    state_ddl = "p_us array<long>, p_seq array<long>"
    start = ([], [])
    out_ddl = "first_us long, first_seq long, then_us long, then_seq long, kind string"

    def __init__(self, within_us: int, strict: bool = True):
        # last microsecond at which a ``then`` row is in time
        self.last = within_us - 1 if strict else within_us

    def step(self, state, rows, out):
        pending = list(zip(*state)) if state[0] else []
        for us, seq, first in rows:
            if first:
                pending.append((us, seq))
                continue
            for p_us, p_seq in pending:
                ok = us <= p_us + self.last
                out.append((p_us, p_seq, us if ok else None, seq if ok else None, "successfully" if ok else "timeout"))
            pending = []
        return [p[0] for p in pending], [p[1] for p in pending]

    def due(self, state):
        return min(state[0]) + self.last if state[0] else None

    def expire(self, state, now, out):
        pending = list(zip(*state)) if state[0] else []
        out += [(us, seq, None, None, "timeout") for us, seq in pending if us + self.last <= now]
        pending = [p for p in pending if p[0] + self.last > now]
        return [p[0] for p in pending], [p[1] for p in pending]


class Bursts(Pattern):
    """A failure opens a burst, failures up to ``span`` after it join, any
    other row cancels it; reported at opener + span when larger than ``min_exclusive``."""

    state_ddl = "open_us long, last_us long, n long"
    start = (None, None, 0)
    out_ddl = "first_us long, last_us long, fails long"

    def __init__(self, span_us: int, min_exclusive: int = 2):
        self.span, self.least = span_us, min_exclusive

    def _close(self, state, out):
        if state[0] is not None and state[2] > self.least:
            out.append((state[0], state[1], state[2]))
        return self.start

    def step(self, state, rows, out):
        for us, _, fail in rows:
            if state[0] is not None and us > state[0] + self.span:
                state = self._close(state, out)
            if not fail:
                state = self.start
            elif state[0] is None:
                state = (us, us, 1)
            else:
                state = (state[0], us, state[2] + 1)
        return state

    def due(self, state):
        return None if state[0] is None else state[0] + self.span

    def expire(self, state, now, out):
        return self._close(state, out) if state[0] is not None and state[0] + self.span <= now else state


class StrictPairs(Pattern):
    """A failure right after a failure less than ``within`` earlier."""

    state_ddl = "p_us long, p_seq long"  # the previous row, if it is a failure
    start = (None, None)
    out_ddl = "first_us long, last_us long, first_seq long, n long"

    def __init__(self, within_us: int):
        self.within = within_us

    def step(self, state, rows, out):
        p_us, p_seq = state
        for us, seq, fail in rows:
            if fail and p_us is not None and us < p_us + self.within:
                out.append((p_us, us, p_seq, 2))
            p_us, p_seq = (us, seq) if fail else (None, None)
        return p_us, p_seq

    def due(self, state):
        return None if state[0] is None else state[0] + self.within - 1

    def expire(self, state, now, out):
        return self.start if state[0] is not None and state[0] + self.within - 1 <= now else state


class Runs(Pattern):
    """E5: failures each at most ``gap`` after the previous one; every failure
    from the ``least``-th of its run on is reported."""

    state_ddl = "first_us long, last_us long, n long"
    start = (None, None, 0)
    out_ddl = "first_us long, last_us long, seq long, fails long"

    def __init__(self, gap_us: int, least: int = 3):
        self.gap, self.least = gap_us, least

    def step(self, state, rows, out):
        first, last, n = state
        for us, seq, fail in rows:
            if not fail:
                first, last, n = self.start
                continue
            first, n = (first, n + 1) if first is not None and us <= last + self.gap else (us, 1)
            last = us
            if n >= self.least:
                out.append((first, us, seq, n))
        return first, last, n

    def due(self, state):
        return None if state[0] is None else state[1] + self.gap

    def expire(self, state, now, out):
        return self.start if state[0] is not None and state[1] + self.gap <= now else state


class Reconcile(Pattern):
    """A row consumes the oldest waiting row of the other side within
    the tolerance, or waits; unmatched once the tolerance has passed.  Rows carry
    their side (0 left, 1 right) as ``seq`` and a value of the given type."""

    ordered_by = 3  # rows of one time and side by their value, nulls first, as in batch
    state_ddl = "side int, w_us array<long>, w_id array<long>"
    start = (None, [], [])
    out_ddl = "left_us long, left_id long, right_us long, right_id long, kind string"

    def __init__(self, tol_us: int):
        self.tol = tol_us

    def _alone(self, side, row):
        return (*row, None, None, "pay_without_receipt") if side == 0 else (None, None, *row, "receipt_without_pay")

    def step(self, state, rows, out):
        side, waiting = state[0], list(zip(state[1], state[2]))
        for us, s, rid in rows:
            while waiting and us - waiting[0][0] > self.tol:
                out.append(self._alone(side, waiting.pop(0)))
            if waiting and s != side:
                pair = (waiting.pop(0), (us, rid))
                l, r = pair if side == 0 else pair[::-1]
                out.append((*l, *r, "match"))
            else:
                side = s
                waiting.append((us, rid))
        return side, [w[0] for w in waiting], [w[1] for w in waiting]

    def due(self, state):
        return state[1][0] + self.tol if state[1] else None

    def expire(self, state, now, out):
        side, waiting = state[0], list(zip(state[1], state[2]))
        while waiting and waiting[0][0] + self.tol <= now:
            out.append(self._alone(side, waiting.pop(0)))
        return side, [w[0] for w in waiting], [w[1] for w in waiting]
