"""Greedy bursts and reconciliation of keys without a gap: results, and how much one task reads."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from behavio.operators import bursts, matching, patterns, reconcile

T0 = dt.datetime(2024, 1, 1)


def events(seed, n, users, success=0.0, gaps=(0, 0.3, 0.7, 1, 1.4, 2)):
    rnd = random.Random(seed)
    rows, t = [], dict.fromkeys(users, 0.0)
    for i in range(n):
        u = rnd.choice(users)
        t[u] += rnd.choice(gaps)
        rows.append((i, T0 + dt.timedelta(seconds=t[u]), u, "success" if rnd.random() < success else "fail"))
    return rows


def brute(rows, span=2, more_than=2):
    out = []
    for u in {r[2] for r in rows}:
        first = last = None
        n = 0
        for ts, _, kind in sorted((r[1], r[0], r[3]) for r in rows if r[2] == u):
            if first is not None and ts > first + dt.timedelta(seconds=span):
                out += [(u, first, last, n)] * (n > more_than)
                first = None
            if kind != "fail":
                first = None
            elif first is None:
                first, last, n = ts, ts, 1
            else:
                last, n = ts, n + 1
        if first is not None:
            out += [(u, first, last, n)] * (n > more_than)
    return sorted(out, key=repr)


def found(spark, rows, parts=4):
    df = spark.createDataFrame(rows, "seq long, ts timestamp_ntz, user_id long, event_type string").repartition(parts)
    return sorted(map(tuple, bursts(df, "user_id", "ts", "seq", F.col("event_type") == "fail", "2 seconds", 2).collect()), key=repr)


@pytest.mark.parametrize("groups", [(64, 4096), (2, 4), (3, 6), (2, 8, 32)])
def test_bursts_of_long_islands(spark, monkeypatch, groups):
    monkeypatch.setattr(patterns, "LINK_GROUPS", groups)
    rows = events(1, 700, [1, 2]) + [(10_000 + i, *r[1:]) for i, r in enumerate(events(2, 300, [3], 0.05))]
    rows += [(20_000 + i, *r[1:]) for i, r in enumerate(events(3, 200, [None, 5], 0.02))]
    assert found(spark, rows) == brute(rows)


def test_links_are_contracted_and_followed_like_a_walk():
    rnd = random.Random(8)
    for _ in range(100):
        times = sorted(rnd.sample(range(200), rnd.randrange(2, 80)))
        link = {t: next((x for x in times if x > t + 9), None) for t in times}
        links = [(t, x) for t, x in link.items() if x is not None]
        end = lambda t: t if link.get(t) is None else end(link[t])
        later, contract = patterns._Chain(), patterns._contract(200)
        assert all(contract(later, t, x, False) == end(x) for t, x in reversed(links))
        at, walk, t = patterns._Chain(), [], times[0]
        while link.get(t) is not None:
            walk.append(t)
            t = link[t]
        assert [t for t, x in links if patterns._follow(at, t, x, t == times[0]) is not None] == walk


def test_a_hot_key_without_a_gap_is_many_tasks(spark, monkeypatch):
    """One key fails every second for hours: no Python task may read its whole island."""
    monkeypatch.setattr(patterns, "LINK_GROUPS", (16, 256))
    groups = spark.createDataFrame([(T0 + dt.timedelta(seconds=i), i, 1, "fail") for i in range(6000)],
                                   "ts timestamp_ntz, seq long, user_id long, event_type string")
    seen = []
    folded = patterns._folded

    def watched(rows, wide, order, fold):
        out = folded(rows, wide, order, fold)
        g = F.lit(0) if wide is None else F.floor(F.col("us") / wide)
        seen.append(rows.groupBy("k", "run", g.alias("g")).count().agg(F.max("count")).first()[0])
        return out
    monkeypatch.setattr(patterns, "_folded", watched)
    got = bursts(groups, "user_id", "ts", "seq", F.col("event_type") == "fail", "2 seconds", 2).collect()
    assert len(got) == 2000 and all(r.fails == 3 for r in got)
    assert max(seen) <= 600 and len(seen) == 5


def queue_match(left, right, tol):
    """Rows (time, id) taken in order, left before right: (left id, right id) of the matches."""
    waiting, side, out = [], None, []
    for t, s, i in sorted([(t, 0, i) for t, i in left] + [(t, 1, i) for t, i in right]):
        while waiting and t - waiting[0][0] > tol:
            waiting.pop(0)
        if waiting and s != side:
            w = waiting.pop(0)[1]
            out.append((w, i) if side == 0 else (i, w))
        else:
            side = s
            waiting.append((t, i))
    return out


def reconciled(spark, left, right, tol):
    ddl = lambda p: f"k string, {p}_ts timestamp_ntz, {p}_id long"
    at = lambda rows: [(k, T0 + dt.timedelta(seconds=t), i) for k, t, i in rows]
    out = reconcile(spark.createDataFrame(at(left), ddl("l")), spark.createDataFrame(at(right), ddl("r")), "k", "l_ts", "r_ts", f"{tol} seconds")
    return sorted((r.k, r.l_id, r.r_id) for r in out.where("kind = 'match'").collect()), out.count()


@pytest.mark.parametrize("group, tol", [(2, 3), (5, 20), (64, 60), (64, 0)])
def test_reconcile_without_a_gap_in_small_groups(spark, monkeypatch, group, tol):
    monkeypatch.setattr(matching, "GROUP", group)
    rnd = random.Random(group)
    rows = lambda k, n, span: [(k, rnd.randrange(span), i) for i in range(n)]
    left, right = rows("a", 300, 400) + rows("b", 40, 4000), rows("a", 260, 400) + rows("b", 60, 4000)
    want = sorted((k, l, r) for k in "ab" for l, r in queue_match([x[1:] for x in left if x[0] == k], [x[1:] for x in right if x[0] == k], tol))
    assert reconciled(spark, left, right, tol) == (want, len(left) + len(right) - len(want))


def test_all_entered_numbers_are_passed_at_once():
    rnd = random.Random(4)
    for _ in range(500):
        tol = rnd.choice([1, 3, 8])
        l, r = (sorted(rnd.randrange(60) for _ in range(rnd.randrange(1, 40))) for _ in range(2))
        bounds = [(f, h) for t in r if (f := sum(x < t - tol for x in l)) < (h := sum(x <= t + tol for x in l))]
        if not bounds:
            continue
        state = {}
        for j, (f, h) in enumerate(bounds):
            assert not list(matching._pass_all(state, (j, f, h)))
        got = {i: v for _, i, v in matching._pass_all(state, None)}
        assert sorted(got) == list(range(bounds[0][0], bounds[0][1] + 1))
        for i, v in got.items():
            for f, h in bounds:
                i = max(i, f) + (max(i, f) < h)
            assert i == v


def test_a_hot_reconcile_key_is_many_groups(spark, monkeypatch):
    """A key with a row a second on both sides: no fold reads more than its group, and the numbers passed on are few."""
    read = []
    on = matching._matched

    def watched(bounds):
        read.append((bounds.count(), bounds.groupBy("k", "g").count().agg(F.max("count")).first()[0]))
        return on(bounds)
    monkeypatch.setattr(matching, "_matched", watched)
    left = [("hot", i, i) for i in range(4000)]
    right = [("hot", i + 2, i) for i in range(4000)]
    found, rows = reconciled(spark, left, right, 3)
    assert found == [("hot", i, i) for i in range(4000)] and rows == 4000
    assert read == [(4000, 3 * matching.GROUP)]
