"""Query catalogue over the test tables (``events``, ``customer``,
``nation``, ``orders``, ``lineitem``, ``pages``).

The behaviour jobs read ``events``: item id = ``props.k``, the event type
stands for the behaviour (view = pv, error = login failure, signup =
order create, purchase = pay), the user's nation (``user_id =
c_custkey``) stands for channel / province.  ``events`` is sparse (about
one event per user every 7 hours), so time parameters are rescaled where
the reference's seconds would never match; each function names its
parameters.  Every query reads whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import is_static_resource, json_long, url_host
from ..operators import (bursts, deadline, followed_by, interval_join, quota, reconcile, runs,
                         sliding_count, sliding_peak, sliding_runs, strict_sequence, top_n, top_n_report,
                         tumbling_count, unique_count, running_unique)
from ..operators.uniques import hll_sketches, rollup_sketches
from ..sources.tables import table


def _ev(spark, d, cols=("event_id", "ts", "user_id", "event_type")) -> DataFrame:
    return table(spark, d, "events").select(*cols)


def _items(spark, d, event_type: str) -> DataFrame:
    return (table(spark, d, "events").where(F.col("event_type") == event_type)
            .select("event_id", "ts", "user_id", json_long("props", "k").alias("item_id")))


def nation_of_user(spark, d) -> DataFrame:
    # both joins are left to AQE, which broadcasts a side only when its
    # size is under the threshold
    nation = table(spark, d, "nation").select("n_nationkey", "n_name")
    return (table(spark, d, "customer").select("c_custkey", "c_nationkey")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").alias("user_id"), F.col("n_name")))


# ---------------------------------------------------------------- hot items
def hot_items(spark: SparkSession, d: str) -> DataFrame:
    """Top 3 viewed items per 1 h window sliding by 10 min (rank from 1)."""
    c = sliding_count(_items(spark, d, "view"), "ts", "1 hour", "10 minutes", keys=["item_id"])
    return top_n(c, "window_end", "cnt", "item_id", 3).select("window_end", "rank", "item_id", "cnt")


def hot_items_report(spark: SparkSession, d: str) -> DataFrame:
    """The hot-items text report, one row per window end."""
    c = sliding_count(_items(spark, d, "view"), "ts", "1 hour", "10 minutes", keys=["item_id"])
    return top_n_report(top_n(c, "window_end", "cnt", "item_id", 3), "window_end", "item_id", "cnt")


def hot_items_fine_top(spark: SparkSession, d: str) -> DataFrame:
    """Top 5 clicked items per 10 min window sliding by 5 s, rank from 0."""
    c = sliding_count(_items(spark, d, "click"), "ts", "10 minutes", "5 seconds", keys=["item_id"])
    return top_n(c, "window_end", "cnt", "item_id", 5, rank_base=0).select("window_end", "rank", "item_id", "cnt")


def hot_items_fine(spark: SparkSession, d: str) -> DataFrame:
    """Peak 10 min / 5 s click count per item, with the first window end
    reaching it and the number of non-empty windows."""
    return sliding_peak(_items(spark, d, "click"), "ts", "10 minutes", "5 seconds", keys=["item_id"])


def hot_hosts(spark: SparkSession, d: str) -> DataFrame:
    """Top 5 hosts of ``pages`` after dropping .css/.js URLs, rank from 0."""
    p = table(spark, d, "pages").select("url").where(~is_static_resource("url"))
    c = p.groupBy(url_host("url").alias("host")).agg(F.count(F.lit(1)).alias("cnt"))
    return top_n(c, [], "cnt", "host", 5, rank_base=0).select("host", "cnt", "rank")


# ---------------------------------------------------------------- page views / UV
def page_views_hourly(spark: SparkSession, d: str) -> DataFrame:
    v = _ev(spark, d).where(F.col("event_type") == "view")
    return tumbling_count(v, "ts", "1 hour", count_col="pv")


def unique_visitors_hourly(spark: SparkSession, d: str) -> DataFrame:
    v = _ev(spark, d).where(F.col("event_type") == "view")
    return unique_count(v, "ts", "1 hour", "user_id", method="exact")


def uv_bitmap_hourly(spark: SparkSession, d: str) -> DataFrame:
    v = _ev(spark, d).where(F.col("event_type") == "view")
    return unique_count(v, "ts", "1 hour", "user_id", method="bitmap")


def uv_approx_hourly(spark: SparkSession, d: str) -> DataFrame:
    v = _ev(spark, d).where(F.col("event_type") == "view")
    return unique_count(v, "ts", "1 hour", "user_id", method="hll", out="uv_approx")


def uv_approx_daily(spark: SparkSession, d: str) -> DataFrame:
    """Daily approximate viewers from the hourly HLL sketches (unioned,
    not recounted)."""
    v = _ev(spark, d).where(F.col("event_type") == "view")
    return rollup_sketches(hll_sketches(v, "ts", "1 hour", "user_id"), "1 day")


def uv_running(spark: SparkSession, d: str) -> DataFrame:
    v = _ev(spark, d).where(F.col("event_type") == "view")
    return running_unique(v, "ts", "event_id", "1 hour", "user_id")


# ---------------------------------------------------------------- marketing
def marketing_total(spark: SparkSession, d: str) -> DataFrame:
    """All events but 'error' (the uninstalls), 1 h windows sliding by 10 s."""
    e = _ev(spark, d).where(~F.col("event_type").eqNullSafe("error"))
    c = sliding_count(e, "ts", "1 hour", "10 seconds")
    return c.select("window_start", "window_end", F.lit("app marketing").alias("channel"),
                    F.lit("total").alias("behavior"), "cnt")


def marketing_by_channel(spark: SparkSession, d: str) -> DataFrame:
    """Per (nation of the user, event type): peak 1 h / 10 s count."""
    e = (_ev(spark, d).where(~F.col("event_type").eqNullSafe("error"))
         .join(nation_of_user(spark, d), "user_id", "left")
         .select("ts", F.col("n_name").alias("channel"), F.col("event_type").alias("behavior")))
    return sliding_peak(e, "ts", "1 hour", "10 seconds", keys=["channel", "behavior"])


# ---------------------------------------------------------------- ad quota
AD_MAX_PASSED = 2  # rescaled from 101: events has ~0.4 events per (user, type, day)


def _quota(spark, d):
    return quota(_ev(spark, d), ["user_id", "event_type"], "ts", "event_id", max_passed=AD_MAX_PASSED)


def ad_quota_passed(spark: SparkSession, d: str) -> DataFrame:
    return _quota(spark, d).where("passed").select("event_id", "user_id", "event_type", "ts", "n")


def ad_quota_alerts(spark: SparkSession, d: str) -> DataFrame:
    return _quota(spark, d).where("alert").select("user_id", "event_type", "day", "ts", "msg")


def ad_clicks_by_region(spark: SparkSession, d: str) -> DataFrame:
    """Clicks that passed the quota, per nation, peak 1 h / 5 s count."""
    ok = (_quota(spark, d).where("passed")
          .join(nation_of_user(spark, d), "user_id", "left")
          .select("ts", F.col("n_name").alias("province")))
    return sliding_peak(ok, "ts", "1 hour", "5 seconds", keys=["province"])


# ---------------------------------------------------------------- login failures
def strict_pairs(spark: SparkSession, d: str) -> DataFrame:
    """error immediately followed by error of the same user, < 2 h apart."""
    e = _ev(spark, d)
    return strict_sequence(e, "user_id", "ts", "event_id", F.col("event_type") == "error", 2, "2 hours")


def fail_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of errors <= 12 h apart; alert from the 3rd error on."""
    e = _ev(spark, d)
    return runs(e, "user_id", "ts", "event_id", F.col("event_type") == "error", "12 hours", 3)


def fail_bursts(spark: SparkSession, d: str) -> DataFrame:
    """Greedy 24 h bursts of errors opened by an error, cancelled by any
    other event; reported when > 2 errors."""
    e = _ev(spark, d)
    return bursts(e, "user_id", "ts", "event_id", F.col("event_type") == "error", "24 hours", 2)


# ---------------------------------------------------------------- orders
def _orders(spark, d):
    e = _ev(spark, d)
    return followed_by(e, "user_id", "ts", "event_id", F.col("event_type") == "signup",
                       F.col("event_type") == "purchase", "6 hours")


def order_paid(spark: SparkSession, d: str) -> DataFrame:
    return (_orders(spark, d).where(F.col("kind") == "successfully")
            .select("user_id", F.col("first_ts").alias("create_ts"), F.col("first_seq").alias("create_id"),
                    F.col("then_ts").alias("pay_ts"), F.col("then_seq").alias("pay_id")))


def order_timeout(spark: SparkSession, d: str) -> DataFrame:
    return (_orders(spark, d).where(F.col("kind") == "timeout")
            .select("user_id", F.col("first_ts").alias("create_ts"), F.col("first_seq").alias("create_id")))


def order_deadline(spark: SparkSession, d: str) -> DataFrame:
    e = _ev(spark, d)
    return deadline(e, "user_id", "ts", "event_id", F.col("event_type") == "signup",
                    F.col("event_type") == "purchase", "6 hours")


# ---------------------------------------------------------------- payments
def tx_interval_join(spark: SparkSession, d: str) -> DataFrame:
    """signup x purchase of the same user, purchase within +-1 h (inclusive)."""
    e = _ev(spark, d)
    s = e.where(F.col("event_type") == "signup").select("user_id", F.col("event_id").alias("signup_id"),
                                                         F.col("ts").alias("signup_ts"))
    p = e.where(F.col("event_type") == "purchase").select("user_id", F.col("event_id").alias("purchase_id"),
                                                           F.col("ts").alias("purchase_ts"))
    return interval_join(s, p, "user_id", "signup_ts", "purchase_ts", "-1 hour", "1 hour")


def _tx(spark, d, kind):
    pays = table(spark, d, "orders").select(F.col("o_orderkey").alias("tx_id"), F.col("o_orderdate").alias("pay_ts"))
    receipts = (table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("tx_id"))
                .agg(F.min("l_shipdate").alias("receipt_ts")))
    # tx ids are unique on both sides (primary key; aggregate), so no
    # duplicate pairing is needed.
    return reconcile(pays, receipts, "tx_id", "pay_ts", "receipt_ts", "10 days", pair_duplicates=False, kind=kind)


def tx_match(spark: SparkSession, d: str) -> DataFrame:
    return _tx(spark, d, "match")


def pay_without_receipt(spark: SparkSession, d: str) -> DataFrame:
    return _tx(spark, d, "pay_without_receipt")


def receipt_without_pay(spark: SparkSession, d: str) -> DataFrame:
    return _tx(spark, d, "receipt_without_pay")


def tx_reconcile_dup(spark: SparkSession, d: str) -> DataFrame:
    """signup and purchase of one user matched one to one within 12 h, with
    several of each per user: consuming matches and the unmatched of both sides."""
    e = _ev(spark, d)
    s = e.where(F.col("event_type") == "signup").select("user_id", F.col("ts").alias("signup_ts"), F.col("event_id").alias("signup_id"))
    p = e.where(F.col("event_type") == "purchase").select("user_id", F.col("ts").alias("purchase_ts"), F.col("event_id").alias("purchase_id"))
    out = reconcile(s, p, "user_id", "signup_ts", "purchase_ts", "12 hours")
    # ids as text: a nullable integer is a float to some clients
    return out.select("user_id", "signup_ts", F.col("signup_id").cast("string").alias("signup_id"), "purchase_ts",
                      F.col("purchase_id").cast("string").alias("purchase_id"), "kind")


def marketing_windows(spark: SparkSession, d: str) -> DataFrame:
    """Per (nation of the user, event type): every 1 h window sliding by 10 s, windows of equal counts as one row."""
    e = (_ev(spark, d).where(~F.col("event_type").eqNullSafe("error"))
         .join(nation_of_user(spark, d), "user_id", "left")
         .select("ts", F.col("n_name").alias("channel"), F.col("event_type").alias("behavior")))
    return sliding_runs(e, "ts", "1 hour", "10 seconds", keys=["channel", "behavior"])


def ad_click_windows(spark: SparkSession, d: str) -> DataFrame:
    """Clicks that passed the quota, per nation: every 1 h window sliding by 5 s, windows of equal counts as one row."""
    ok = (_quota(spark, d).where("passed")
          .join(nation_of_user(spark, d), "user_id", "left")
          .select("ts", F.col("n_name").alias("province")))
    return sliding_runs(ok, "ts", "1 hour", "5 seconds", keys=["province"])


QUERIES = {
    "tx_reconcile_dup": tx_reconcile_dup,
    "hot_items": hot_items,
    "hot_items_report": hot_items_report,
    "hot_items_fine_top": hot_items_fine_top,
    "hot_items_fine": hot_items_fine,
    "hot_hosts": hot_hosts,
    "page_views_hourly": page_views_hourly,
    "unique_visitors_hourly": unique_visitors_hourly,
    "uv_bitmap_hourly": uv_bitmap_hourly,
    "uv_approx_hourly": uv_approx_hourly,
    "uv_approx_daily": uv_approx_daily,
    "uv_running": uv_running,
    "marketing_total": marketing_total,
    "marketing_by_channel": marketing_by_channel,
    "ad_quota_passed": ad_quota_passed,
    "ad_quota_alerts": ad_quota_alerts,
    "ad_clicks_by_region": ad_clicks_by_region,
    "strict_pairs": strict_pairs,
    "fail_runs": fail_runs,
    "fail_bursts": fail_bursts,
    "order_paid": order_paid,
    "order_timeout": order_timeout,
    "order_deadline": order_deadline,
    "tx_interval_join": tx_interval_join,
    "tx_match": tx_match,
    "pay_without_receipt": pay_without_receipt,
    "receipt_without_pay": receipt_without_pay,
    "marketing_windows": marketing_windows,
    "ad_click_windows": ad_click_windows,
}
