"""The reference's jobs as functions of parsed DataFrames (layouts in
``sources.lines``): behaviour, access log, logins, ad clicks, marketing,
orders, receipts.  Times are event time; parameters default to the
reference's constants."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import is_static_resource
from ..operators import (bursts, deadline, drop_static_urls, followed_by, interval_join, quota, reconcile, runs,
                         sliding_count, strict_sequence, top_n, top_n_report, tumbling_count,
                         unique_count, running_unique)
from ..operators.quota import DEFAULT_MAX_PASSED

# Fixed value: the reference's login-failure message format.
LOGIN_MSG = "login fail in 2 seconds %d times today"


def _login_msg(count_col: str):
    return F.format_string(LOGIN_MSG, F.col(count_col))


def hot_items(behaviour: DataFrame, n: int = 3, size="1 hour", slide="10 minutes") -> DataFrame:
    """Top n viewed ('pv') items per sliding window end, rank from 1."""
    pv = behaviour.where(F.col("behavior") == "pv")
    c = sliding_count(pv, "ts", size, slide, keys=["item_id"])
    return top_n(c, "window_end", "cnt", "item_id", n).select("window_end", "rank", "item_id", "cnt")


def hot_items_report(behaviour: DataFrame, n: int = 3) -> DataFrame:
    return top_n_report(hot_items(behaviour, n), "window_end", "item_id", "cnt")


def page_views(behaviour: DataFrame, size="1 hour") -> DataFrame:
    return tumbling_count(behaviour.where(F.col("behavior") == "pv"), "ts", size, count_col="pv")


def unique_visitors(behaviour: DataFrame, size="1 hour", method: str = "exact") -> DataFrame:
    return unique_count(behaviour.where(F.col("behavior") == "pv"), "ts", size, "user_id", method=method)


def unique_visitors_running(behaviour: DataFrame, size="1 hour", method: str = "bitmap") -> DataFrame:
    """Per-event running UV of the hour (the bloom job's per-element firing)."""
    return running_unique(behaviour.where(F.col("behavior") == "pv"), "ts", "seq", size, "user_id",
                          method="exact" if method == "exact" else "bitmap")


def hot_pages(access_log: DataFrame, n: int = 5, size="10 minutes", slide="5 seconds") -> DataFrame:
    """Top n URLs per 10 min window sliding by 5 s, rank from 0, after
    dropping .css/.js requests."""
    pages = drop_static_urls(access_log, "url")
    c = sliding_count(pages, "ts", size, slide, keys=["url"])
    return top_n(c, "window_end", "cnt", "url", n, rank_base=0).select("window_end", "rank", "url", "cnt")


def login_fail_bursts(logins: DataFrame, span="2 seconds", max_fail_times: int = 2) -> DataFrame:
    b = bursts(logins, "user_id", "ts", "seq", F.col("event_type") == "fail", span, max_fail_times)
    return b.withColumn("msg", _login_msg("fails"))


def login_fail_runs(logins: DataFrame, max_gap="2 seconds", min_len: int = 3) -> DataFrame:
    r = runs(logins, "user_id", "ts", "seq", F.col("event_type") == "fail", max_gap, min_len)
    return r.withColumn("msg", _login_msg("fails"))


def login_fail_pairs(logins: DataFrame, within="2 seconds") -> DataFrame:
    p = strict_sequence(logins, "user_id", "ts", "seq", F.col("event_type") == "fail", 2, within)
    return p.withColumn("msg", _login_msg("n"))


def app_marketing(marketing: DataFrame, size="1 hour", slide="10 seconds") -> DataFrame:
    m = marketing.where(~F.col("behavior").eqNullSafe("UNINSTALL"))
    c = sliding_count(m, "ts", size, slide)
    return c.select("window_start", "window_end", F.lit("app marketing").alias("channel"),
                    F.lit("total").alias("behavior"), "cnt")


def app_marketing_by_channel(marketing: DataFrame, size="1 hour", slide="10 seconds") -> DataFrame:
    m = marketing.where(~F.col("behavior").eqNullSafe("UNINSTALL"))
    return sliding_count(m, "ts", size, slide, keys=["channel", "behavior"])


def ad_clicks(ads: DataFrame, max_passed: int = DEFAULT_MAX_PASSED, reset: str = "day",
              size="1 hour", slide="5 seconds") -> tuple[DataFrame, DataFrame]:
    """(counts per province and sliding window of the clicks that passed
    the quota, blacklist alerts)."""
    q = quota(ads, ["user_id", "ad_id"], "ts", "seq", max_passed, reset)
    passed = q.where("passed").drop("day", "n", "passed", "alert", "msg")
    alerts = q.where("alert").select("user_id", "ad_id", "ts", "msg")
    counts = sliding_count(passed, "ts", size, slide, keys=["province"])
    return counts, alerts


def order_timeout(orders: DataFrame, within="15 minutes") -> DataFrame:
    """Each create with its first later pay: kind successfully / timeout."""
    return followed_by(orders, "order_id", "ts", "seq", F.col("event_type") == "create",
                       F.col("event_type") == "pay", within)


def order_timeout_by_state(orders: DataFrame, within="15 minutes") -> DataFrame:
    return deadline(orders, "order_id", "ts", "seq", F.col("event_type") == "create",
                    F.col("event_type") == "pay", within)


def _pays(orders: DataFrame) -> DataFrame:
    # Creates carry an empty tx id; drop them.
    return (orders.where((F.col("event_type") == "pay") & F.col("tx_id").isNotNull() & (F.col("tx_id") != ""))
                  .select("tx_id", "order_id", F.col("ts").alias("pay_ts")))


def tx_match(orders: DataFrame, receipts: DataFrame, tolerance="5 seconds") -> DataFrame:
    r = receipts.select("tx_id", "pay_channel", F.col("ts").alias("receipt_ts"))
    return reconcile(_pays(orders), r, "tx_id", "pay_ts", "receipt_ts", tolerance)


def tx_match_by_join(orders: DataFrame, receipts: DataFrame, lower="-10 seconds", upper="10 seconds") -> DataFrame:
    r = receipts.select("tx_id", "pay_channel", F.col("ts").alias("receipt_ts"))
    return interval_join(_pays(orders), r, "tx_id", "pay_ts", "receipt_ts", lower, upper)
