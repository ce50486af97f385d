"""Windows that fire again for late rows, against the rule applied row by row."""

import datetime as dt
import logging
import random

import pytest
from pyspark.sql.types import StructType

from behavio.streaming.refiring import compact, late_table, latest, refiring_windows
from behavio.streaming.runner import fold_available
from behavio.streaming.running import running_users
from behavio.streaming.runner import run_folded

S = 1_000_000
DDL = "id long, ts timestamp_ntz, page string"
COUNTS = "window_us long, page string, cnt long"
START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def micros(t):
    return int((t - dt.datetime(1970, 1, 1)).total_seconds()) * S + t.microsecond


def brute(batches, size, slide, delay, lateness):
    """(counts of due windows, late ids, emitted versions) when each batch is judged by the watermark before it."""
    counts, late, top, versions = {}, [], None, []
    for b, rows in enumerate(batches):
        low = None if top is None else top - (delay + lateness) * S
        before = None if top is None else top - delay * S
        changed = set()
        for i, t, page in rows:
            us = micros(t)
            ends = [e for e in range((us // (slide * S) + 1) * slide * S, us + size * S + 1, slide * S) if low is None or e > low]
            if not ends:
                late.append(i)
            for e in ends:
                counts[e, page] = counts.get((e, page), 0) + 1
                changed.add((e, page))
        tops = [micros(t) for i, t, _ in rows if i not in late]
        top = max([x for x in (top, *tops) if x is not None], default=None)
        due = top - delay * S
        versions += [(b, e, p, counts[e, p]) for e, p in counts if e <= due and (before is None or e > before or (e, p) in changed)]
    return {k: c for k, c in counts.items() if k[0] <= top - delay * S}, sorted(late), versions


def run(spark, tmp_path, batches, size, slide, delay, lateness, **options):
    base = str(tmp_path / "query")
    fold = refiring_windows(base, "ts", "page", f"{size} seconds", f"{slide} seconds", f"{delay} seconds", f"{lateness} seconds")
    for rows in batches:
        spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(f"{base}/source")
        fold_available(spark, lambda own: own.readStream.schema(DDL).parquet(f"{base}/source"), base, fold, output_mode="update", **options)
    return base


def counted(spark, base):
    return {(r.window_us, r.page): r.cnt for r in latest(spark, base, COUNTS, ["window_us", "page"]).collect()}


def late_batches():
    """Ten minute windows as the hot pages job has them; rows in time, half a second, 30 s and 90 s late."""
    rnd = random.Random(3)
    batches, n = [], 0
    for b in range(4):
        rows = []
        for k in range(60):
            wait = rnd.choice([0, 0, 0, 0.5, 30, 90, 900]) if b else 0
            rows.append((n, at(b * 120 + 2 * k - wait + rnd.random()), rnd.choice(["/a", "/b", None])))
            n += 1
        batches.append(rows)
    return batches


def test_late_rows_count_where_windows_are_open(spark, tmp_path):
    batches = late_batches()
    base = run(spark, tmp_path, batches, 600, 5, 1, 60)
    counts, late, versions = brute(batches, 600, 5, 1, 60)
    assert late and counted(spark, base) == counts
    got = late_table(spark, base, StructType.fromDDL(DDL)).collect()
    assert sorted(r.id for r in got) == late
    # versions: due windows once, and again only if changed
    data = spark.read.parquet(f"{base}/data").collect()
    assert sorted((r.microbatch, r.window_us, str(r.page), r.cnt) for r in data) == sorted((b, e, str(p), c) for b, e, p, c in versions)
    compact(spark, base, COUNTS, ["window_us", "page"])
    assert counted(spark, base) == counts


def test_compacted_versions_give_way_to_later_ones(spark, tmp_path):
    batches = late_batches()
    base = run(spark, tmp_path, batches[:2], 60, 5, 1, 60)
    compact(spark, base, COUNTS, ["window_us", "page"])
    fold = refiring_windows(base, "ts", "page", "60 seconds", "5 seconds", "1 second", "60 seconds")
    for rows in batches[2:]:
        spark.createDataFrame(rows, DDL).write.mode("append").parquet(f"{base}/source")
        fold_available(spark, lambda own: own.readStream.schema(DDL).parquet(f"{base}/source"), base, fold, output_mode="update")
    assert counted(spark, base) == brute(batches, 60, 5, 1, 60)[0]


def test_a_repeated_micro_batch_replaces_its_output(spark, tmp_path):
    batches = late_batches()[:2]
    base = run(spark, tmp_path, batches, 60, 5, 1, 60)
    before = counted(spark, base)
    fold = refiring_windows(base, "ts", "page", "60 seconds", "5 seconds", "1 second", "60 seconds")
    fold(spark.createDataFrame(batches[1], DDL), 1)
    assert counted(spark, base) == before == brute(batches, 60, 5, 1, 60)[0]


def test_no_late_row_vanishes_without_a_word(spark, tmp_path, caplog):
    batches = late_batches()
    with caplog.at_level(logging.WARNING):
        run(spark, tmp_path, batches, 60, 5, 1, 60)
    assert any("behind the watermark" in r.message for r in caplog.records)
    with pytest.raises(RuntimeError, match="behind the watermark"):
        run(spark, tmp_path / "again", batches, 60, 5, 1, 60, late="fail")


def test_running_users_report_late_rows(spark, tmp_path):
    """Three arrivals, the second with a row 80 s behind the first."""
    base, ddl = str(tmp_path / "uv"), "id long, ts timestamp, user long"
    out = "seq long, us long, window_us long, uv long"
    arrivals = [[(1, at(0), 1), (2, at(100), 2)], [(3, at(20), 3), (4, at(120), 4)], [(5, at(140), 5)]]
    fold = running_users(base, "ts", "id", "user", "1 hour", "3 seconds")
    failed = 0
    for rows in arrivals:
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{base}/source")
        try:
            run_folded(spark, lambda own: own.readStream.schema(ddl).parquet(f"{base}/source"), base, fold, out, late="fail")
        except RuntimeError as e:
            failed += 1
            assert "1 rows" in str(e)
    assert failed == 1
    assert [r.seq for r in late_table(spark, base, StructType.fromDDL("seq long, us long, user_id long")).collect()] == [3]


def test_empty_and_timeless_rows(spark, tmp_path):
    batches = [[(1, None, "/a"), (2, at(1), "/a")], [(3, at(50), "/a")]]
    base = run(spark, tmp_path, batches, 10, 5, 1, 0)
    assert [r.id for r in late_table(spark, base, StructType.fromDDL(DDL)).collect()] == [1]
    assert counted(spark, base) == {(micros(at(5)), "/a"): 1, (micros(at(10)), "/a"): 1}
    assert latest(spark, str(tmp_path / "none"), COUNTS, ["window_us", "page"]).count() == 0
