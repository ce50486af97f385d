"""Exact boundaries: which bounds are strict and
which inclusive, per operator."""

import datetime as dt

from pyspark.sql import functions as F

from behavio.operators import (bursts, deadline, followed_by, interval_join, reconcile, runs,
                               strict_sequence)

T0 = dt.datetime(2024, 1, 1)


def _df(spark, rows):
    return spark.createDataFrame([(i, T0 + dt.timedelta(seconds=s), k, t) for i, (s, k, t) in enumerate(rows)],
                                 "seq long, ts timestamp_ntz, k long, t string")


def test_strict_pair_gap_exactly_within_is_no_match(spark):
    df = _df(spark, [(0, 1, "fail"), (2, 1, "fail"), (10, 2, "fail"), (11.999, 2, "fail")])
    fail = F.col("t") == "fail"
    got = {r.k for r in strict_sequence(df, "k", "ts", "seq", fail, 2, "2 seconds").collect()}
    assert got == {2}                      # 2.000 s apart: outside "< 2 s"


def test_runs_gap_exactly_max_gap_continues(spark):
    df = _df(spark, [(0, 1, "fail"), (2, 1, "fail"), (4, 1, "fail"), (0, 2, "fail"), (2, 2, "fail"), (4.001, 2, "fail")])
    fail = F.col("t") == "fail"
    got = sorted((r.k, r.fails) for r in runs(df, "k", "ts", "seq", fail, "2 seconds", 3).collect())
    assert got == [(1, 3)]


def test_burst_span_is_inclusive(spark):
    df = _df(spark, [(0, 1, "fail"), (1, 1, "fail"), (2, 1, "fail"),
                     (0, 2, "fail"), (1, 2, "fail"), (2.001, 2, "fail"),
                     (0, 3, "fail"), (1, 3, "fail"), (2, 3, "success"), (2, 3, "fail")])
    fail = F.col("t") == "fail"
    got = sorted((r.k, r.fails) for r in bursts(df, "k", "ts", "seq", fail, "2 seconds", 2).collect())
    # key 2: third fail after the timer; key 3: a success at the timer cancels
    assert got == [(1, 3)]


def test_followed_by_strict_and_deadline_inclusive(spark):
    df = _df(spark, [(0, 1, "create"), (900, 1, "pay"), (0, 2, "create"), (899.999, 2, "pay"),
                     (5, 3, "create"), (5, 3, "pay")])
    c, p = F.col("t") == "create", F.col("t") == "pay"
    fb = {r.k: r.kind for r in followed_by(df, "k", "ts", "seq", c, p, "15 minutes").collect()}
    assert fb == {1: "timeout", 2: "successfully", 3: "successfully"}   # equal time, later seq
    dl = {r.k: r.result for r in deadline(df, "k", "ts", "seq", c, p, "15 minutes").collect()}
    assert dl == {1: "Order Pay Successfully", 2: "Order Pay Successfully", 3: "Order Pay Successfully"}


def test_interval_join_and_reconcile_bounds_inclusive(spark):
    left = spark.createDataFrame([("a", T0), ("b", T0), ("c", T0)], "k string, lts timestamp_ntz")
    right = spark.createDataFrame([("a", T0 + dt.timedelta(seconds=10)), ("b", T0 - dt.timedelta(seconds=10)),
                                   ("c", T0 + dt.timedelta(seconds=10, microseconds=1))],
                                  "k string, rts timestamp_ntz")
    j = sorted(r.k for r in interval_join(left, right, "k", "lts", "rts", "-10 seconds", "10 seconds").collect())
    assert j == ["a", "b"]
    r5 = right.withColumn("rts", F.col("rts") - F.expr("INTERVAL 5 SECONDS"))
    kinds = sorted((r.k, r.kind) for r in reconcile(left, r5, "k", "lts", "rts", "5 seconds").collect())
    assert kinds == [("a", "match"), ("b", "pay_without_receipt"), ("b", "receipt_without_pay"),
                     ("c", "pay_without_receipt"), ("c", "receipt_without_pay")]


def test_quota_daily_reset_vs_none(spark):
    from behavio.operators import quota
    day = 86400
    rows = [(s, 1, "click") for s in (0, 10, 20, 30)] + [(day + s, 1, "click") for s in (0, 10, 20)]
    df = _df(spark, rows)
    q = quota(df, ["k"], "ts", "seq", max_passed=2, reset="day")
    assert sorted((r.day.day, r.n, r.alert) for r in q.collect()) == [
        (1, 1, False), (1, 2, False), (1, 3, True), (2, 1, False), (2, 2, False), (2, 3, True)]
    q = quota(df, ["k"], "ts", "seq", max_passed=2, reset="none")
    assert sorted((r.n, r.passed, r.alert) for r in q.collect()) == [(1, True, False), (2, True, False), (3, False, True)]
    # the midnight row counts for the new day: UTC event-time days
    assert {r.msg for r in q.where("alert").collect()} == {"click over 2 times today"}
