"""Small line files with the edge cases of the reference's inputs: a row out of
order, equal create and pay seconds, an empty tx id, no final newline, a hot
(user, ad) pair past its quota."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from behavio.plans import jobs
from behavio.sources import read_lines
from behavio.streaming.processors import Bursts, Quota, ordered
from behavio.streaming.runner import run_available
from behavio.streaming.sources import line_stream, with_event_time, with_micros

H = 1511658000  # 2017-11-26 01:00:00 UTC

LOGINS = ["1,10.0.0.1,fail,%d" % (H + 0), "2,10.0.0.2,success,%d" % (H + 1), "1,10.0.0.1,fail,%d" % (H + 2),
          "1,10.0.0.1,fail,%d" % (H + 1), "3,10.0.0.3,fail,%d" % (H + 5), "3,10.0.0.3,success,%d" % (H + 6), "3,10.0.0.3,fail,%d" % (H + 6),
          "1,10.0.0.1,success,%d" % (H + 60)]
ADS = (["7,70,beijing,beijing,%d" % (H + i) for i in range(103)]
       + ["8,80,hebei,hebei,%d" % (H + 500), "8,81,henan,henan,%d" % (H + 300), "9,90,hebei,hebei,%d" % (H + 3600)])
ORDERS = ["1,create,,%d" % H, "1,pay,t1,%d" % (H + 2), "2,create,,%d" % (H + 10), "2,pay,t2,%d" % (H + 10),
          "3,create,,%d" % (H + 20), "4,pay,t4,%d" % (H + 30), "3,pay,t3,%d" % (H + 920), "5,create,,%d" % (H + 40)]
RECEIPTS = ["t1,wechat,%d" % (H + 5), "t2,alipay,%d" % (H + 16), "t9,alipay,%d" % (H + 18), "t4,wechat,%d" % (H + 25)]


@pytest.fixture
def lines(tmp_path):
    def write(name, rows):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "in.csv").write_text("\n".join(rows))  # no final newline
        return str(folder)
    return write


def _ts(s):
    return dt.datetime(1970, 1, 1) + dt.timedelta(seconds=s)


def test_ad_quota(spark, lines):
    ads = read_lines(spark, lines("ads", ADS), "ad")
    counts, alerts = jobs.ad_clicks(ads)
    a = alerts.collect()
    assert [(x.user_id, x.ad_id, x.ts, x.msg) for x in a] == [(7, 70, _ts(H + 101), "click over 101 times today")]
    agg = counts.agg(F.count(F.lit(1)).alias("rows"), F.sum("cnt").alias("total")).collect()[0]
    assert agg.total == 104 * 720  # 101 + 3 passed, each in 720 windows
    peak = counts.groupBy("province").agg(F.max("cnt").alias("m")).collect()
    assert {x.province: x.m for x in peak} == {"beijing": 101, "hebei": 2, "henan": 1}


def test_login_failures(spark, lines):
    logins = read_lines(spark, lines("logins", LOGINS), "login")
    pairs = jobs.login_fail_pairs(logins).orderBy("first_ts").collect()
    assert [(r.user_id, r.first_ts, r.last_ts) for r in pairs] == [(1, _ts(H), _ts(H + 1)), (1, _ts(H + 1), _ts(H + 2))]
    b = jobs.login_fail_bursts(logins).collect()
    assert [(r.user_id, r.first_ts, r.last_ts, r.fails, r.msg) for r in b] == [
        (1, _ts(H), _ts(H + 2), 3, "login fail in 2 seconds 3 times today")]
    assert [(x.user_id, x.fails) for x in jobs.login_fail_runs(logins).collect()] == [(1, 3)]


def test_orders(spark, lines):
    orders = read_lines(spark, lines("orders", ORDERS), "order")
    got = {r.order_id: r.kind for r in jobs.order_timeout(orders).collect()}
    assert got == {1: "successfully", 2: "successfully", 3: "timeout", 5: "timeout"}  # 3 is paid at 15 minutes sharp
    got = {r.order_id: (r.result, r.delay_min) for r in jobs.order_timeout_by_state(orders).collect()}
    assert got == {1: ("Order Pay Successfully", 0), 2: ("Order Pay Successfully", 0), 3: ("Order Pay Successfully", 15),
                   5: ("Order Pay Timeout", None)}


def test_receipts(spark, lines):
    orders = read_lines(spark, lines("orders", ORDERS), "order_tx")
    receipts = read_lines(spark, lines("receipts", RECEIPTS), "receipt")
    assert sorted(x.tx_id for x in jobs.tx_match_by_join(orders, receipts).collect()) == ["t1", "t2", "t4"]
    got = {(x.tx_id, x.kind) for x in jobs.tx_match(orders, receipts).collect()}
    assert got == {("t1", "match"), ("t4", "match"), ("t2", "pay_without_receipt"), ("t3", "pay_without_receipt"),
                   ("t2", "receipt_without_pay"), ("t9", "receipt_without_pay")}


def test_line_streams(spark, lines):
    ads = with_event_time(with_micros(line_stream(spark, lines("ads", ADS + ["5,5,x,y,%d" % (H + 90000)]), "ad")), "ts", "1 hour")
    q = run_available(spark, ordered(ads, ["user_id", "ad_id"], Quota(101), "us", "seq", []), "t_ads")
    assert {k: n for k, n in q.where("user_id <> 5").groupBy("kind").count().collect()} == {"pass": 104, "alert": 1}
    logins = line_stream(spark, lines("logins", LOGINS), "login").withColumn("is_fail", F.col("event_type") == "fail")
    logins = with_event_time(with_micros(logins), "ts", "3 seconds")
    b = run_available(spark, ordered(logins, ["user_id"], Bursts(2_000_000, 2), "us", "seq", ["is_fail"]), "t_logins")
    assert [(x.user_id, x.first_us, x.fails) for x in b.collect()] == [(1, H * 1_000_000, 3)]
