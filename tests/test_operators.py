"""Operator properties against brute force on small inputs."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from behavio.functions import is_static_resource, rolling_hash
from behavio.operators import (bursts, interval_join, merge_unique_state, quota, reconcile, running_unique, runs,
                               sliding_count, sliding_peak, strict_sequence, top_n, unique_count)
from behavio.operators.uniques import with_bit_offset
from behavio.sources import parse_lines, read_lines
from sf_dirs import SF_SMALL

T0 = dt.datetime(2024, 1, 1)


def _events(spark):
    return spark.read.parquet(f"{SF_SMALL}/events.parquet")


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("size,slide", [("1 hour", "10 minutes"), ("10 minutes", "5 seconds"), ("2 hours", "1 hour")])
def test_sliding_methods_agree(spark, size, slide):
    ev = _events(spark)
    cols = ["window_start", "window_end", "event_type", "cnt"]
    ref = _rows(sliding_count(ev, "ts", size, slide, ["event_type"], method="builtin"), cols)
    assert ref
    assert _rows(sliding_count(ev, "ts", size, slide, ["event_type"], method="panes"), cols) == ref
    assert _rows(sliding_count(ev, "ts", size, slide, ["event_type"], method="deltas"), cols) == ref


def test_sliding_deltas_global_and_chunks(spark):
    ev = _events(spark)
    cols = ["window_start", "window_end", "cnt"]
    ref = _rows(sliding_count(ev, "ts", "1 hour", "5 minutes", method="builtin"), cols)
    assert _rows(sliding_count(ev, "ts", "1 hour", "5 minutes", method="deltas"), cols) == ref


def test_sliding_peak_matches_counts(spark):
    ev = _events(spark)
    c = sliding_count(ev, "ts", "1 hour", "5 minutes", ["event_type"], method="builtin").toPandas()
    exp = {}
    for k, g in c.groupby("event_type"):
        peak = g.cnt.max()
        exp[k] = (peak, g[g.cnt == peak].window_end.min(), len(g))
    got = {r.event_type: (r.peak, pd.Timestamp(r.peak_window_end), r.windows)
           for r in sliding_peak(ev, "ts", "1 hour", "5 minutes", ["event_type"]).collect()}
    assert got == exp


def test_top_n_rank_base_and_ties(spark):
    df = spark.createDataFrame([("w", "a", 3), ("w", "b", 3), ("w", "c", 1), ("v", "a", 1)], "g string, k string, cnt long")
    r = _rows(top_n(df, "g", "cnt", "k", 2, rank_base=0), ["g", "k", "rank"])
    assert r == [("v", "a", 0), ("w", "a", 0), ("w", "b", 1)]
    g = _rows(top_n(df, [], "cnt", "k", 1), ["k", "rank"])
    assert g == [("a", 1)]


def test_unique_methods(spark):
    ev = _events(spark).where("event_type = 'view'")
    cols = ["window_end", "uv"]
    exact = _rows(unique_count(ev, "ts", "1 hour", "user_id", method="exact"), cols)
    assert _rows(unique_count(ev, "ts", "1 hour", "user_id", method="bitmap"), cols) == exact
    approx = dict(_rows(unique_count(ev, "ts", "1 day", "user_id", method="hll"), cols))
    exact_day = dict(_rows(unique_count(ev, "ts", "1 day", "user_id", method="exact"), cols))
    for k, v in exact_day.items():
        assert abs(approx[k] - v) <= max(2, 0.05 * v)


def test_rolling_hash_long_ids(spark):
    ids = [0, 7, 1234, 99999999, 12345678901234]
    df = spark.createDataFrame([(i,) for i in ids], "u long")
    got = [r.h for r in df.select(rolling_hash("u").alias("h")).collect()]

    def ref(i):
        h = 0
        for ch in str(i):
            h = (h * 73 + ord(ch)) & ((1 << 64) - 1)
        return h & ((1 << 29) - 1)
    assert got == [ref(i) for i in ids]


def test_running_unique_brute_force(spark):
    ev = _events(spark).where("event_type = 'view'")
    got = {r.event_id: r.uv for r in running_unique(ev, "ts", "event_id", "1 hour", "user_id", slice_="5 minutes").collect()}
    pdf = ev.select("event_id", "ts", "user_id").toPandas().sort_values(["ts", "event_id"])
    exp, seen = {}, {}
    for r in pdf.itertuples():
        hour = r.ts.floor("h")
        s = seen.setdefault(hour, set())
        s.add(r.user_id)
        exp[r.event_id] = len(s)
    assert got == exp


def test_merge_unique_state(spark):
    new = spark.createDataFrame([(1, 5), (1, 6), (2, 5)], "window_end long, offset long")
    stored = spark.createDataFrame([(1, 5)], "window_end long, offset long")
    fresh, counts = merge_unique_state(new, stored)
    assert _rows(fresh, ["window_end", "offset"]) == [(1, 6), (2, 5)]
    assert _rows(counts, ["window_end", "uv"]) == [(1, 2), (2, 1)]


def _random_events(n_users=6, n=400, seed=7):
    rnd = random.Random(seed)
    rows, t = [], {u: T0 for u in range(n_users)}
    for i in range(n):
        u = rnd.randrange(n_users)
        t[u] = t[u] + dt.timedelta(seconds=rnd.choice([0, 1, 1, 2, 2, 3, 5, 30]))
        rows.append((i, t[u], u, rnd.choice(["fail", "fail", "fail", "success"])))
    return rows


def _streaky_events(seed, n=600):
    rnd = random.Random(seed)
    rows, t = [], {u: T0 for u in range(3)}
    for i in range(n):
        u = rnd.randrange(3)
        t[u] += dt.timedelta(seconds=rnd.choice([0, 1, 1, 1, 2, 2, 3, 7]))
        rows.append((i, t[u], u, "success" if rnd.random() < 0.08 else "fail"))
    return rows


@pytest.mark.parametrize("rows", [_random_events(), _streaky_events(4), _streaky_events(9)])
def test_bursts_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "seq long, ts timestamp_ntz, user_id long, event_type string")
    got = _rows(bursts(df, "user_id", "ts", "seq", F.col("event_type") == "fail", "2 seconds", 2),
                ["user_id", "first_ts", "last_ts", "fails"])
    exp = []
    for u in sorted({r[2] for r in rows}):
        ev = sorted((r[1], r[0], r[3]) for r in rows if r[2] == u)
        burst = None
        for ts, _, et in ev:
            if burst and ts > burst[0] + dt.timedelta(seconds=2):
                if burst[2] > 2:
                    exp.append((u, burst[0], burst[1], burst[2]))
                burst = None
            if et != "fail":
                burst = None
            elif burst is None:
                burst = [ts, ts, 1]
            else:
                burst[1], burst[2] = ts, burst[2] + 1
        if burst and burst[2] > 2:
            exp.append((u, burst[0], burst[1], burst[2]))
    assert got == sorted(exp)
    assert got


def test_runs_brute_force(spark):
    rows = _random_events(seed=11)
    df = spark.createDataFrame(rows, "seq long, ts timestamp_ntz, user_id long, event_type string")
    got = _rows(runs(df, "user_id", "ts", "seq", F.col("event_type") == "fail", "2 seconds", 3),
                ["user_id", "first_ts", "last_ts", "fails"])
    exp = []
    for u in sorted({r[2] for r in rows}):
        buf = []
        for ts, _, et in sorted((r[1], r[0], r[3]) for r in rows if r[2] == u):
            if et != "fail":
                buf = []
                continue
            if buf and ts - buf[-1] <= dt.timedelta(seconds=2):
                buf.append(ts)
            else:
                buf = [ts]
            if len(buf) >= 3:
                exp.append((u, buf[0], ts, len(buf)))
    assert got == sorted(exp)
    assert got


def test_interval_join_brute_force(spark):
    rnd = random.Random(3)
    left = [(rnd.randrange(4), i, T0 + dt.timedelta(seconds=rnd.randrange(0, 300))) for i in range(120)]
    right = [(rnd.randrange(4), 1000 + i, T0 + dt.timedelta(seconds=rnd.randrange(0, 300))) for i in range(120)]
    l = spark.createDataFrame(left, "k long, lid long, lts timestamp_ntz")
    r = spark.createDataFrame(right, "k long, rid long, rts timestamp_ntz")
    got = _rows(interval_join(l, r, "k", "lts", "rts", "-7 seconds", "10 seconds"), ["k", "lid", "rid"])
    exp = sorted((a[0], a[1], b[1]) for a in left for b in right
                 if a[0] == b[0] and a[2] - dt.timedelta(seconds=7) <= b[2] <= a[2] + dt.timedelta(seconds=10))
    assert got == exp and got


def test_reconcile_counts(spark):
    l = spark.createDataFrame([("a", T0), ("a", T0 + dt.timedelta(seconds=60)), ("b", T0)], "k string, lts timestamp_ntz")
    r = spark.createDataFrame([("a", T0 + dt.timedelta(seconds=5)), ("a", T0 + dt.timedelta(seconds=90)),
                               ("c", T0)], "k string, rts timestamp_ntz")
    got = _rows(reconcile(l, r, "k", "lts", "rts", "5 seconds"), ["k", "kind"])
    assert got == [("a", "match"), ("a", "pay_without_receipt"), ("a", "receipt_without_pay"),
                   ("b", "pay_without_receipt"), ("c", "receipt_without_pay")]


def test_read_lines_rejects_and_static_filter(spark, tmp_path):
    p = tmp_path / "apache.log"
    p.write_text("\n".join([
        "1.1.1.1 - - 17/05/2015:10:05:03 +0000 GET /a.css",
        "1.1.1.1 - - 17/05/2015:10:05:04 +0000 GET /a.js",
        "1.1.1.1 - - 17/05/2015:10:05:05 +0000 GET /a.css?x",
        "1.1.1.1 - - 17/05/2015:10:05:06 +0000 GET /ok",
        "1.1.1.1 - - 31/02/2015:10:05:06 +0000 GET /bad-date",
        "garbage"]))
    rows, rejects = read_lines(spark, str(p), "access_log", on_error="reject")
    kept = rows.where(~is_static_resource("url"))
    assert sorted(r.url for r in kept.collect()) == ["/a.css?x", "/ok"]
    assert rejects.count() == 2
    assert rows.where("url = '/ok'").collect()[0].ts == dt.datetime(2015, 5, 17, 10, 5, 6)
    with pytest.raises(Exception):
        read_lines(spark, str(p), "access_log", on_error="fail").collect()


def test_parse_behaviour_layout(spark):
    lines = spark.createDataFrame([("543462, 1715, 1464116, pv, 1511658000",), ("1,2,x,pv,5",)], "value string")
    p = parse_lines(lines, "behaviour").collect()
    assert p[0]["_ok"] and p[0].user_id == 543462 and p[0].behavior == "pv"
    assert p[0].ts == dt.datetime(2017, 11, 26, 1, 0, 0)
    assert not p[1]["_ok"]


@pytest.mark.parametrize("within", ["2 seconds", "5 seconds", "30 seconds"])
def test_bucketed_patterns_equal_per_key(spark, within):
    from behavio.operators import deadline, followed_by, strict_sequence
    rows = _random_events(n=600, seed=5)
    df = spark.createDataFrame(rows, "seq long, ts timestamp_ntz, user_id long, event_type string")
    fail, ok = F.col("event_type") == "fail", F.col("event_type") == "success"
    for steps in (2, 3):
        a = strict_sequence(df, "user_id", "ts", "seq", fail, steps, within, bucket=True)
        b = strict_sequence(df, "user_id", "ts", "seq", fail, steps, within, bucket=False)
        assert _rows(a, a.columns) == _rows(b, b.columns)
    a = followed_by(df, "user_id", "ts", "seq", fail, ok, within, bucket=True)
    b = followed_by(df, "user_id", "ts", "seq", fail, ok, within, bucket=False)
    assert _rows(a, a.columns) == _rows(b, b.columns)
    assert a.where("kind = 'successfully'").count() > 0
    a = deadline(df, "user_id", "ts", "seq", fail, ok, within, bucket=True)
    b = deadline(df, "user_id", "ts", "seq", fail, ok, within, bucket=False)
    assert _rows(a, a.columns) == _rows(b, b.columns)


@pytest.mark.parametrize("gap,seed", [("2 seconds", 1), ("3 seconds", 2), ("1 seconds", 3)])
def test_bucketed_runs_equal_per_key(spark, gap, seed):
    rnd = random.Random(seed)
    rows, t = [], {u: T0 for u in range(3)}
    for i in range(500):          # long fail streaks spanning many buckets
        u = rnd.randrange(3)
        t[u] += dt.timedelta(seconds=rnd.choice([0, 1, 1, 1, 2, 2, 3, 7]))
        rows.append((i, t[u], u, "success" if rnd.random() < 0.08 else "fail"))
    df = spark.createDataFrame(rows, "seq long, ts timestamp_ntz, user_id long, event_type string")
    fail = F.col("event_type") == "fail"
    a = runs(df, "user_id", "ts", "seq", fail, gap, 3, bucket=True)
    b = runs(df, "user_id", "ts", "seq", fail, gap, 3, bucket=False)
    ra, rb = _rows(a, b.columns), _rows(b, b.columns)
    assert ra == rb and max(r[4] for r in rb) > 6


@pytest.mark.parametrize("chunk", ["1 hour", "90 minutes", "1 day"])
def test_window_deltas_small_chunks(spark, chunk):
    from behavio.operators.windows import window_deltas
    ev = _events(spark)
    ref = {(r.event_type, r.window_end): r.cnt
           for r in sliding_count(ev, "ts", "1 hour", "5 minutes", ["event_type"], method="builtin").collect()}
    got = {}
    for r in window_deltas(ev, "ts", "1 hour", "5 minutes", ["event_type"], chunk=chunk).collect():
        if r.cnt > 0:
            e = r.e
            while e < r.next_e:
                assert (r.event_type, e) not in got
                got[(r.event_type, e)] = r.cnt
                e += dt.timedelta(minutes=5)
    assert got == ref


def test_kafka_records_round_trip(spark):
    """The Kafka sink's records are CSV lines a behaviour reader parses back."""
    from behavio.sources import kafka_records
    df = spark.createDataFrame([(543462, 1715, 1464116, "pv", 1511658000)],
                               "user_id long, item_id long, category_id int, behavior string, ts long")
    rec = kafka_records(df)
    assert rec.columns == ["value"]
    back = parse_lines(rec, "behaviour").collect()[0]
    assert back["_ok"] and (back.user_id, back.item_id, back.behavior) == (543462, 1715, "pv")
    assert back.ts == dt.datetime(2017, 11, 26, 1, 0, 0)


def _consume(left, right, tol_s):
    """Brute force: rows of a key in time order, left first; each takes the
    oldest waiting row of the other side within the tolerance."""
    out = []
    for key in sorted({x[0] for x in left + right}):
        rows = sorted([(t, 0, v) for k, t, v in left if k == key] + [(t, 1, v) for k, t, v in right if k == key])
        waiting = []
        for t, side, v in rows:
            while waiting and (t - waiting[0][0]).total_seconds() > tol_s:
                w = waiting.pop(0)
                out.append((w[2], None) if w[1] == 0 else (None, w[2]))
            if waiting and waiting[0][1] != side:
                w = waiting.pop(0)
                out.append((w[2], v) if side == 1 else (v, w[2]))
            else:
                waiting.append((t, side, v))
        out += [(w[2], None) if w[1] == 0 else (None, w[2]) for w in waiting]
    return sorted(out, key=str)


@pytest.mark.parametrize("tol", [0, 3, 60, 4000])
def test_reconcile_consumes_like_brute_force(spark, tol):
    rnd = random.Random(21 + tol)
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(20)}",
             T0 + dt.timedelta(seconds=rnd.randrange(0, 40000)), i) for i in range(800)]
    left, right = [r for r in rows if r[2] % 2 == 0], [r for r in rows if r[2] % 2]
    r = reconcile(spark.createDataFrame(left, "k string, lts timestamp_ntz, lv long"),
                  spark.createDataFrame(right, "k string, rts timestamp_ntz, rv long"), "k", "lts", "rts", f"{tol} seconds")
    got = r.collect()
    assert sorted(((x.lv, x.rv) for x in got), key=str) == _consume(left, right, tol)
    at = {v: (k, t) for k, t, v in rows}
    for x in got:
        assert x.kind == ("match" if None not in (x.lv, x.rv) else "pay_without_receipt" if x.rv is None else "receipt_without_pay")
        assert all(at[v] == (x.k, t) for v, t in ((x.lv, x.lts), (x.rv, x.rts)) if v is not None)


@pytest.mark.parametrize("dup", [True, False])
def test_reconcile_keeps_null_keys_and_times(spark, dup):
    left = spark.createDataFrame([(None, T0, 1), ("a", None, 2), ("b", T0, 3)], "k string, lts timestamp_ntz, lv long")
    right = spark.createDataFrame([(None, T0, 4), ("a", T0, 5), ("b", T0, 6)], "k string, rts timestamp_ntz, rv long")
    got = {(x.k, x.lv, x.rv, x.kind) for x in reconcile(left, right, "k", "lts", "rts", "5 seconds", pair_duplicates=dup).collect()}
    assert got == {(None, 1, None, "pay_without_receipt"), ("a", 2, None, "pay_without_receipt"), ("b", 3, 6, "match"),
                   (None, None, 4, "receipt_without_pay"), ("a", None, 5, "receipt_without_pay")}
    for kind in ("match", "pay_without_receipt", "receipt_without_pay"):
        one = reconcile(left, right, "k", "lts", "rts", "5 seconds", pair_duplicates=dup, kind=kind)
        assert {(x.k, x.lv, x.rv, x.kind) for x in one.collect()} == {g for g in got if g[3] == kind}


def test_stale_row_does_not_shift_later_pairs(spark):
    s = lambda n: T0 + dt.timedelta(seconds=n)
    left = spark.createDataFrame([("k", s(0)), ("k", s(100))], "k string, lts timestamp_ntz")
    right = spark.createDataFrame([("k", s(100))], "k string, rts timestamp_ntz")
    got = sorted((x.kind, x.lts) for x in reconcile(left, right, "k", "lts", "rts", "5 seconds").collect())
    assert got == [("match", s(100)), ("pay_without_receipt", s(0))]


@pytest.mark.parametrize("day", [dt.datetime(2024, 3, 10), dt.datetime(2024, 11, 3)])
def test_patterns_do_not_depend_on_the_session_zone(spark, day):
    """Both changes of New York's clocks lie between 1 and 3 o'clock."""
    rnd = random.Random(3)
    rows = [(i, day + dt.timedelta(seconds=rnd.randrange(3600, 4 * 3600)), rnd.randrange(6), rnd.choice(["fail", "fail", "ok"]))
            for i in range(400)]
    df = spark.createDataFrame(rows, "seq long, ts timestamp_ntz, k long, t string")
    fail = F.col("t") == "fail"

    def results():
        l = df.where(fail).select("k", F.col("ts").alias("lts"), F.col("seq").alias("ls"))
        r = df.where(~fail).select("k", F.col("ts").alias("rts"), F.col("seq").alias("rs"))
        out = [interval_join(l, r, "k", "lts", "rts", "-90 seconds", "90 seconds"), strict_sequence(df, "k", "ts", "seq", fail, 2, "5 minutes"),
               runs(df, "k", "ts", "seq", fail, "5 minutes", 2), bursts(df, "k", "ts", "seq", fail, "10 minutes", 1),
               reconcile(l, r, "k", "lts", "rts", "90 seconds"), quota(df, ["k"], "ts", "seq", 2).select("seq", "n")]
        # as text: the client shows NTZ alike in all zones
        return [sorted(tuple(map(str, x)) for x in o.select(*[F.col(c).cast("string") for c in o.columns]).collect()) for o in out]
    utc = results()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert results() == utc and all(utc)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("size,slide", [("1 hour", "25 minutes"), ("1500 milliseconds", "500 milliseconds"), ("90 minutes", "1 hour")])
def test_windows_of_any_ratio_and_below_a_second(spark, size, slide):
    rnd = random.Random(5)
    df = spark.createDataFrame([(T0 + dt.timedelta(milliseconds=rnd.randrange(0, 9_000_000)), rnd.randrange(3)) for _ in range(300)],
                               "ts timestamp_ntz, k long")
    ways = [_rows(sliding_count(df, "ts", size, slide, ["k"], method=m), ["window_start", "window_end", "k", "cnt"])
            for m in ("builtin", "panes", "deltas")]
    assert ways[0] == ways[1] == ways[2] and ways[0]


def test_huge_epoch_is_a_reject(spark, tmp_path):
    (tmp_path / "b.csv").write_text("1,2,3,pv,1511658000\n1,2,3,pv,99999999999999999\n1,2,3,pv,x\n")
    rows, rejects = read_lines(spark, str(tmp_path), "behaviour", on_error="reject")
    assert rows.count() == 1 and rejects.count() == 2


def test_kafka_lines_pass_unchanged_and_rows_are_written_back(spark):
    from behavio.sources import kafka_records
    line = "1,2,3,pv,1511658000"
    lines = spark.createDataFrame([(line,)], "value string")
    assert kafka_records(lines).collect()[0].value == line
    assert kafka_records(parse_lines(lines, "behaviour"), "behaviour").collect()[0].value == line


def test_sketch_rollup_close_to_exact(spark):
    from behavio.operators.uniques import hll_sketches, rollup_sketches
    ev = _events(spark).where("event_type = 'view'")
    got = dict(_rows(rollup_sketches(hll_sketches(ev, "ts", "1 hour", "user_id"), "1 day"), ["window_end", "uv_approx"]))
    exact = dict(_rows(unique_count(ev, "ts", "1 day", "user_id"), ["window_end", "uv"]))
    assert got.keys() == exact.keys()
    assert all(abs(got[k] - exact[k]) <= max(1, 0.05 * exact[k]) for k in exact)
