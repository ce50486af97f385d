"""Bitmaps kept from run to run."""

import datetime as dt
import random

import pytest

from behavio.operators import unique_count
from behavio.operators.unique_state import BitmapState, window_counts

T0 = dt.datetime(2024, 1, 1)
DDL = "ts timestamp_ntz, user_id long"


def visits(seed, n=400, hours=30):
    rnd = random.Random(seed)
    return [(T0 + dt.timedelta(seconds=rnd.randrange(hours * 3600)), rnd.choice([None, *range(60), 10**9 + seed])) for _ in range(n)]


def counts(df):
    return sorted((r.window_end, r.uv) for r in df.collect())


def direct(spark, rows):
    df = spark.createDataFrame([r for r in rows if r[1] is not None], DDL)
    return counts(unique_count(df, "ts", "1 hour", "user_id", method="bitmap"))


def test_three_runs_one_repeated_are_one_run(spark, tmp_path):
    runs = [visits(s) for s in range(3)]
    state = BitmapState(spark, str(tmp_path))
    for k in (0, 1, 1, 2, 0):
        state.add(spark.createDataFrame(runs[k], DDL), f"r{k}", "ts", "user_id")
    assert counts(window_counts(state)) == direct(spark, sum(runs, []))
    assert [r for _, r in state.commits()] == ["r0", "r1", "r2"]
    state.compact()
    assert counts(window_counts(state)) == direct(spark, sum(runs, []))
    late = visits(9)
    state.add(spark.createDataFrame(late, DDL), "late", "ts", "user_id")
    assert counts(window_counts(state)) == direct(spark, sum(runs, late))


def test_an_uncommitted_run_does_not_count_and_is_done_again(spark, tmp_path, monkeypatch):
    state = BitmapState(spark, str(tmp_path))
    state.add(spark.createDataFrame(visits(1), DDL), "a", "ts", "user_id")
    with monkeypatch.context() as m:
        m.setattr(state, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            state.add(spark.createDataFrame(visits(2), DDL), "b", "ts", "user_id")
    assert counts(window_counts(state)) == direct(spark, visits(1))
    state.add(spark.createDataFrame(visits(3), DDL), "c", "ts", "user_id")
    state.add(spark.createDataFrame(visits(2), DDL), "b", "ts", "user_id")
    assert counts(window_counts(state)) == direct(spark, visits(1) + visits(2) + visits(3))


def test_only_touched_pairs_are_written_and_counts_read_no_bitmap(spark, tmp_path):
    state = BitmapState(spark, str(tmp_path))
    state.add(spark.createDataFrame(visits(1), DDL), "a", "ts", "user_id")
    state.add(spark.createDataFrame([(T0, 5), (T0, 7)], DDL), "b", "ts", "user_id")
    written = spark.read.parquet(f"{tmp_path}/data/bitmaps/number=2")
    assert written.select("window_us").distinct().count() == 1 and written.count() == written.select("bucket").distinct().count()
    plan = state.counts()._jdf.queryExecution().executedPlan().toString()
    assert "bitmap" not in plan
    touched = state.touched(spark.createDataFrame([(T0, 5)], DDL), "ts", "user_id")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in touched and "day" in touched


def test_empty_runs(spark, tmp_path):
    state = BitmapState(spark, str(tmp_path))
    state.add(spark.createDataFrame([], DDL), "none", "ts", "user_id")
    state.add(spark.createDataFrame([(None, 1), (T0, None)], DDL), "nulls", "ts", "user_id")
    assert counts(window_counts(state)) == []
    state.add(spark.createDataFrame([(T0, 1)], DDL), "one", "ts", "user_id")
    assert counts(window_counts(state)) == [(T0 + dt.timedelta(hours=1), 1)]
