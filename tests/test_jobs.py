"""Reference jobs on synthesised behaviour and access-log files
(the reference reads them but does not ship them)."""

import datetime as dt

from behavio.plans import jobs
from behavio.sources import read_lines

H = 1511658000  # 2017-11-26 01:00:00 UTC


def _write(tmp_path, name, lines):
    p = tmp_path / name
    p.write_text("\n".join(lines))
    return str(p)


def test_hot_items_pv_uv(spark, tmp_path):
    rows = [
        "1,10,100,pv,%d" % (H + 0),
        "1,10,100,pv,%d" % (H + 60),        # repeated user in the hour
        "2,11,100,pv,%d" % (H + 120),
        "3,11,100,pv,%d" % (H + 180),
        "4,12,100,pv,%d" % (H + 240),
        "5,13,100,cart,%d" % (H + 250),     # not a pv
        "6,13,100,pv,%d" % (H + 3600),      # exactly on the next hour edge
    ]
    b = read_lines(spark, _write(tmp_path, "UserBehavior.csv", rows), "behaviour")
    top = jobs.hot_items(b).where("window_end = TIMESTAMP_NTZ'2017-11-26 02:00:00'").orderBy("rank").collect()
    # items 10 and 11 tie at 2 views: key order decides
    assert [(r.rank, r.item_id, r.cnt) for r in top] == [(1, 10, 2), (2, 11, 2), (3, 12, 1)]
    pv = {r.window_start.hour: r.pv for r in jobs.page_views(b).collect()}
    assert pv == {1: 5, 2: 1}
    uv = {r.window_start.hour: r.uv for r in jobs.unique_visitors(b).collect()}
    assert uv == {1: 4, 2: 1}
    assert {r.window_start.hour: r.uv for r in jobs.unique_visitors(b, method="bitmap").collect()} == uv
    run = [r.uv for r in jobs.unique_visitors_running(b).orderBy("seq").collect()]
    assert run == [1, 1, 2, 3, 4, 1]
    rep = jobs.hot_items_report(b).where("window_end = TIMESTAMP_NTZ'2017-11-26 02:00:00'").collect()[0].report
    assert rep.splitlines() == ["time: 2017-11-26 02:00:00", "No:1\titem:10\tcount:2",
                                "No:2\titem:11\tcount:2", "No:3\titem:12\tcount:1"]


def test_hot_pages_with_static_filter(spark, tmp_path):
    base = dt.datetime(2015, 5, 17, 10, 5, 0)

    def line(sec, url):
        t = (base + dt.timedelta(seconds=sec)).strftime("%d/%m/%Y:%H:%M:%S")
        return f"83.149.9.216 - - {t} +0000 GET {url}"
    rows = [line(0, "/a"), line(1, "/a"), line(2, "/b"), line(3, "/a.css"), line(4, "/a.js"), line(5, "/b?x.css")]
    logs = read_lines(spark, _write(tmp_path, "apache.log", rows), "access_log")
    top = jobs.hot_pages(logs).where("window_end = TIMESTAMP_NTZ'2015-05-17 10:05:10'").orderBy("rank").collect()
    # "/b?x.css" ends in .css, so it is dropped like "/a.css"
    assert [(r.rank, r.url, r.cnt) for r in top] == [(0, "/a", 2), (1, "/b", 1)]


def test_marketing(spark):
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    rows = [("u1", "BROWSE", "AppStore", t0), ("u2", "CLICK", "AppStore", t0 + dt.timedelta(seconds=15)),
            ("u3", "UNINSTALL", "weibo", t0 + dt.timedelta(seconds=20)),
            ("u4", "BROWSE", "AppStore", t0 + dt.timedelta(seconds=25))]
    m = spark.createDataFrame(rows, "user_id string, behavior string, channel string, ts timestamp_ntz")
    tot = jobs.app_marketing(m)
    assert tot.agg({"cnt": "max"}).collect()[0][0] == 3
    assert tot.count() == 360 + 2       # windows touched by t0 .. t0+25s
    ch = jobs.app_marketing_by_channel(m)
    assert {r.behavior for r in ch.collect()} == {"BROWSE", "CLICK"}
