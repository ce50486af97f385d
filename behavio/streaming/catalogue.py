"""Streaming twins of catalogue queries.

Each reads ``events`` as a file stream, runs with
``trigger(availableNow=True)`` into a Parquet table under the checkpoint
folder and returns that table.  In append mode a window is emitted only once
the watermark (the largest event time seen, less the delay) reaches its end
(the watermark follows the rows that pass the filters, which Catalyst
pushes below the watermark), so the oracles keep the closed windows only;
the keyed patterns (3 s delay) take rows in event-time order once the watermark
has passed them, so theirs keep what is decided by then; inner
joins emit as soon as rows arrive, so theirs equals batch."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions import json_long
from ..functions.times import epoch_micros, micros_of, to_event_ts, utc_ntz
from ..operators.topn import top_n
from ..sources.lines import format_line
from ..sources.tables import table
from ..session import scratch_path
from .lines import BY_PATH, run_lines
from .operators import (approx_unique, chained_unique, flatten_window, stream_interval_join, top_n_per_batch,
                        windowed_count)
from .processors import Bursts, FollowedBy, Quota, Reconcile, Runs, StrictPairs, ordered
from .refiring import late_table, latest, refiring_windows
from .runner import exists, fold_available, read_table, run_available, run_available_batches, run_folded
from .running import running_users, sliding_top
from .sources import table_stream, with_event_time, with_micros
from ..plans.catalogue import nation_of_user
from ..plans.lines import HUGE, line_files
from ..plans.oracle import _NATION_OF_USER, _PEAK, _QUOTA, ORACLE_SQL as _BATCH_SQL


def _events(spark, d, cols=("event_id", "ts", "user_id", "event_type", "props"), delay="0 seconds"):
    return with_event_time(table_stream(spark, d, "events").select(*cols), "ts", delay)


def _streamed(name: str, per_batch=None, schema=None, **options):
    """A catalogue query from a function that builds its stream."""
    def wrap(build):
        @functools.wraps(build)
        def query(spark: SparkSession, d: str) -> DataFrame:
            if per_batch is not None:
                return run_available_batches(spark, lambda own: build(own, d), name, per_batch, schema, **options)
            return run_available(spark, lambda own: build(own, d), name, **options)
        return query
    return wrap


@_streamed("stream_page_views")
def stream_page_views_hourly(spark: SparkSession, d: str) -> DataFrame:
    s = _events(spark, d).where(F.col("event_type") == "view")
    return flatten_window(windowed_count(s, "ts", "1 hour", count_col="pv"))


@_streamed("stream_uv")
def stream_unique_visitors_hourly(spark: SparkSession, d: str) -> DataFrame:
    s = _events(spark, d).where(F.col("event_type") == "view")
    return flatten_window(chained_unique(s, "ts", "1 hour", "user_id"))


def _ranked(n: int, base: int):
    rank = top_n_per_batch("window_end", "cnt", "item_id", n, rank_base=base)
    return lambda b: rank(b).select("window_end", "rank", "item_id", "cnt")


RANKED = "window_end timestamp, rank long, item_id long, cnt long"


@_streamed("stream_hot_items", _ranked(3, 1), RANKED)
def stream_hot_items(spark: SparkSession, d: str) -> DataFrame:
    s = (_events(spark, d).where(F.col("event_type") == "view")
         .select("ts", json_long("props", "k").alias("item_id")))
    return windowed_count(s, "ts", "1 hour", "10 minutes", keys=["item_id"]).select(
        F.col("window.end").alias("window_end"), "item_id", "cnt")


def stream_lines_rejects(spark: SparkSession, d: str) -> DataFrame:
    """A folder of text lines as a stream that is read once: rows and rejects with their line numbers."""
    rows, rejects = run_lines(spark, line_files(spark, d, "behaviour"), "behaviour", order=BY_PATH)
    rows = rows.select("seq", F.lit("row").alias("kind"), format_line(rows, "behaviour").alias("line"))
    return rows.unionByName(rejects.withColumn("kind", F.lit("reject")))


def _signups(spark, d):
    return _events(spark, d, ("event_id", "ts", "user_id", "event_type")).where(F.col("event_type") == "signup").select(
        "user_id", F.col("event_id").alias("signup_id"), F.col("ts").alias("signup_ts"))


def _purchases(spark, d):
    return _events(spark, d, ("event_id", "ts", "user_id", "event_type")).where(F.col("event_type") == "purchase").select(
        "user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))


@_streamed("stream_tx_join")
def stream_tx_interval_join(spark: SparkSession, d: str) -> DataFrame:
    return stream_interval_join(_signups(spark, d), _purchases(spark, d), "user_id", "signup_ts", "purchase_ts",
                                "-1 hour", "1 hour")


#: Lateness of the keyed pattern queries: that of the login jobs.
DELAY = "3 seconds"


def _keyed(spark, d, types=None):
    """Events for the keyed patterns, their time also as microseconds."""
    e = table_stream(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    e = with_event_time(with_micros(e), "ts", DELAY)
    return e if types is None else e.where(F.col("event_type").isin(*types))


def _time(col: str):
    return F.timestamp_micros(F.col(col))


@_streamed("stream_ad_quota")
def stream_ad_quota(spark: SparkSession, d: str, max_passed: int = 2) -> DataFrame:
    """Per (user, event type) and UTC day: the first ``max_passed`` events
    pass, the next raises one alert."""
    out = ordered(_keyed(spark, d), ["user_id", "event_type"], Quota(max_passed), "us", "event_id", [])
    return out.select(F.col("seq").alias("event_id"), "user_id", "event_type", _time("us").alias("ts"), "n", "kind")


def _followed(spark, d, strict: bool):
    s = _keyed(spark, d, ("signup", "purchase")).withColumn("is_first", F.col("event_type") == "signup")
    return ordered(s, ["user_id"], FollowedBy(6 * 3600 * 1_000_000, strict), "us", "event_id", ["is_first"])


@_streamed("stream_order_timeout")
def stream_order_timeout(spark: SparkSession, d: str) -> DataFrame:
    """signup followed by the user's first later purchase within 6 h
    (successfully) or not (timeout), decided once the watermark has passed the
    purchase or the deadline.  Signups still undecided stay in state."""
    return _followed(spark, d, True).select(
        "user_id", _time("first_us").alias("create_ts"), F.col("first_seq").alias("create_id"), _time("then_us").alias("pay_ts"),
        F.col("then_seq").cast("string").alias("pay_id"), "kind")


@_streamed("stream_order_deadline")
def stream_order_deadline(spark: SparkSession, d: str) -> DataFrame:
    """Order deadline (E6/E7) on a stream: a purchase at most 6 h after the
    signup pays it (inclusive); whole-minute delay for paid orders."""
    result = F.when(F.col("kind") == "successfully", F.lit("Order Pay Successfully")).otherwise(F.lit("Order Pay Timeout"))
    return _followed(spark, d, False).select(
        "user_id", _time("first_us").alias("create_ts"), result.alias("result"), _time("then_us").alias("pay_ts"),
        F.floor((F.col("then_us") - F.col("first_us")) / F.lit(60_000_000)).cast("long").alias("delay_min"),
        F.lit(360).cast("long").alias("deadline_min"))


def _failures(spark, d, pattern):
    s = _keyed(spark, d).withColumn("is_fail", F.col("event_type") == "error")
    out = ordered(s, ["user_id"], pattern, "us", "event_id", ["is_fail"])
    return out.withColumn("first_ts", _time("first_us")).withColumn("last_ts", _time("last_us")).drop("first_us", "last_us")


@_streamed("stream_fail_bursts")
def stream_fail_bursts(spark: SparkSession, d: str) -> DataFrame:
    """Greedy 24 h error bursts (> 2 errors) on a stream, reported at opener +
    24 h, cancelled by any other event before it."""
    return _failures(spark, d, Bursts(24 * 3600 * 1_000_000, 2)).select("user_id", "first_ts", "last_ts", "fails")


@_streamed("stream_strict_pairs")
def stream_strict_pairs(spark: SparkSession, d: str) -> DataFrame:
    """error immediately followed by error of the same user < 2 h later."""
    return _failures(spark, d, StrictPairs(2 * 3600 * 1_000_000)).select("user_id", "first_ts", "last_ts", "first_seq", "n")


@_streamed("stream_fail_runs")
def stream_fail_runs(spark: SparkSession, d: str) -> DataFrame:
    """error runs with gaps <= 12 h, alert from the 3rd on."""
    return _failures(spark, d, Runs(12 * 3600 * 1_000_000, 3)).select(
        "user_id", "first_ts", "last_ts", F.col("seq").alias("event_id"), "fails")


@_streamed("stream_tx_reconcile")
def stream_tx_reconcile(spark: SparkSession, d: str) -> DataFrame:
    """signup and purchase of one user matched one to one within 12 h (J2-J4),
    decided once the watermark has passed the match or the tolerance."""
    s = _keyed(spark, d, ("signup", "purchase")).withColumn("side", F.when(F.col("event_type") == "signup", 0).otherwise(1))
    out = ordered(s, ["user_id"], Reconcile(12 * 3600 * 1_000_000), "us", "side", ["event_id"])
    return out.select("user_id", _time("left_us").alias("signup_ts"), F.col("left_id").cast("string").alias("signup_id"),
                      _time("right_us").alias("purchase_ts"), F.col("right_id").cast("string").alias("purchase_id"), "kind")


@_streamed("stream_tx_outer_join")
def stream_tx_interval_outer_join(spark: SparkSession, d: str) -> DataFrame:
    """signup left-outer purchase of the same user within +-1 h: the pairs,
    plus each signup without a purchase once the watermark (the smaller of
    the two inputs' watermarks) has passed its band."""
    out = stream_interval_join(_signups(spark, d), _purchases(spark, d), "user_id", "signup_ts", "purchase_ts",
                               "-1 hour", "1 hour", how="left_outer")
    return out.withColumn("purchase_id", F.col("purchase_id").cast("string"))


@_streamed("stream_uv_approx")
def stream_uv_approx_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Approximate distinct viewers per hour on a stream (no oracle SQL:
    an HLL estimate is not an exact result)."""
    s = _events(spark, d).where(F.col("event_type") == "view")
    return flatten_window(approx_unique(s, "ts", "1 hour", "user_id"))


def stream_hot_items_fine_top(spark: SparkSession, d: str) -> DataFrame:
    """Top 5 clicked items per 10 min window sliding by 5 s (rank from 0),
    with the hot-pages job's lateness: watermark delay 1 s + 60 s allowed
    lateness, one complete report per window (D3).  The stream counts 5 s panes;
    closed panes are folded into windows per micro-batch, up to the last closed pane."""
    base = scratch_path(spark, "stream_hot_items_fine_top")

    def panes(own: SparkSession) -> DataFrame:
        s = _events(own, d, ("ts", "event_type", "props"), "61 seconds")
        s = s.where(F.col("event_type") == "click").select("ts", json_long("props", "k").alias("item_id"))
        return windowed_count(s, "ts", "5 seconds", keys=["item_id"], count_col="c").select(
            F.col("window.start").alias("pane"), "item_id", "c")
    out = run_folded(spark, panes, base, sliding_top(base, "item_id", "10 minutes", "5 seconds", 5, 0), RANKED)
    return out.withColumn("window_end", utc_ntz(F.unix_micros("window_end")))


def stream_uv_running(spark: SparkSession, d: str) -> DataFrame:
    """Running distinct viewers of the hour after every view event (the
    bloom job's per-event firing) on a stream, in event-time order."""
    base = scratch_path(spark, "stream_uv_running")

    def views(own: SparkSession) -> DataFrame:
        s = table_stream(own, d, "events").select("event_id", "ts", "user_id", "event_type").where(F.col("event_type") == "view")
        return s.withColumn("ts", to_event_ts(s, "ts"))
    out = run_folded(spark, views, base, running_users(base, "ts", "event_id", "user_id", "1 hour", DELAY),
                     "seq long, us long, window_us long, uv long")
    return out.select(F.col("seq").alias("event_id"), utc_ntz(F.col("us")).alias("ts"),
                      utc_ntz(F.col("window_us")).alias("window_end"), "uv")


#: Arrivals of the late clicks, and how long after its time a click arrives, by the last digit of its id.
ARRIVALS, DELAYED = 5, {7: "5 minutes", 8: "40 minutes", 9: "1 day"}
LATE_CLICKS = "event_id long, ts timestamp_ntz, item_id long"


def _late_clicks(spark: SparkSession, d: str, name: str) -> str:
    """Clicks in the order of their arrival, one stream run for each of ``ARRIVALS`` spans of it; the folder of the windows."""
    base = scratch_path(spark, name)
    clicks = (table(spark, d, "events").where(F.col("event_type") == "click")
              .select("event_id", "ts", json_long("props", "k").alias("item_id")))
    wait = F.lit(0)
    for digit, delay in DELAYED.items():
        wait = F.when(F.col("event_id") % 10 == digit, micros_of(delay)).otherwise(wait)
    arrived = epoch_micros(clicks, "ts") + wait
    low, high = clicks.agg(F.min(arrived), F.max(arrived)).first()
    if low is None:
        return base
    (clicks.withColumn("arrival", F.floor((arrived - F.lit(low)) * ARRIVALS / F.lit(high - low + 1)))
     .write.partitionBy("arrival").parquet(f"{base}/staged"))
    fold = refiring_windows(base, "ts", "item_id", "6 hours", "10 minutes", "10 minutes", "1 hour")
    for k in range(ARRIVALS):
        if exists(spark, f"{base}/staged/arrival={k}"):
            spark.read.schema(LATE_CLICKS).parquet(f"{base}/staged/arrival={k}").write.mode("append").parquet(f"{base}/source")
            fold_available(spark, lambda own: own.readStream.schema(LATE_CLICKS).parquet(f"{base}/source"), base, fold, name,
                           output_mode="update")
    return base


def stream_hot_hosts_late(spark: SparkSession, d: str) -> DataFrame:
    """Top 5 clicked items per 6 h window sliding by 10 min (rank from 0), of which a tenth each arrives 5 min, 40 min and a day late:
    windows fire at the watermark (10 min) and again for rows up to 1 h late; the last version of each window holds."""
    base = _late_clicks(spark, d, "stream_hot_hosts_late")
    counts = latest(spark, base, "window_us long, item_id long, cnt long", ["window_us", "item_id"])
    ranked = top_n(counts.withColumn("window_end", utc_ntz(F.col("window_us"))), "window_end", "cnt", "item_id", 5, 0)
    return ranked.select("window_end", "rank", "item_id", "cnt")


def stream_late_rows(spark: SparkSession, d: str) -> DataFrame:
    """The clicks of ``stream_hot_hosts_late`` that came after all of their windows were closed."""
    base = _late_clicks(spark, d, "stream_late_rows")
    return late_table(spark, base, StructType.fromDDL(LATE_CLICKS)).drop("microbatch")


RUNS = "window_us long, last_us long, {key} string, cnt long"


def stream_ad_clicks_by_region(spark: SparkSession, d: str) -> DataFrame:
    """Clicks that passed the daily quota, per nation, peak 1 h / 5 s count, on a stream: the keyed quota gives its rows
    in event-time order, all up to its watermark; each micro-batch of them is folded into windows, which are closed by the largest
    time that the quota has reported."""
    base, key = scratch_path(spark, "stream_ad_clicks_by_region"), "province"
    windows = refiring_windows(base, "ts", key, "1 hour", "5 seconds", "0 seconds", "0 seconds", counted="passed", runs=True)
    def clicks(own: SparkSession) -> DataFrame:
        out = ordered(_keyed(own, d), ["user_id", "event_type"], Quota(2), "us", "event_id", [])
        return out.select("user_id", _time("us").alias("ts"), (F.col("kind") == "pass").alias("passed"))

    def fold(rows: DataFrame, batch: int) -> None:
        nations = nation_of_user(rows.sparkSession, d).withColumnRenamed("n_name", key)
        windows(rows.join(nations, "user_id", "left"), batch)
    fold_available(spark, clicks, base, fold, "stream_ad_clicks_by_region")
    found = read_table(spark, f"{base}/data", RUNS.format(key=key))
    return (found.groupBy(key).agg(F.max("cnt").alias("peak"), F.min_by("window_us", F.struct(-F.col("cnt"), F.col("window_us"))).alias("first"),
                                   F.sum((F.col("last_us") - F.col("window_us")) / 5_000_000 + 1).cast("long").alias("windows"))
            .select(key, "peak", utc_ntz(F.col("first")).alias("peak_window_end"), "windows"))


def stream_marketing_total(spark: SparkSession, d: str) -> DataFrame:
    """All events but 'error', 1 h windows sliding by 10 s, on a stream: panes wait in written state, closed windows come
    as runs of equal counts."""
    base, key = scratch_path(spark, "stream_marketing_total"), "behavior"
    windows = refiring_windows(base, "ts", key, "1 hour", "10 seconds", "0 seconds", "0 seconds", runs=True)

    def events(own: SparkSession) -> DataFrame:
        s = table_stream(own, d, "events").select("ts", "event_type").where(~F.col("event_type").eqNullSafe("error"))
        return s.select("ts", F.lit("total").alias(key))
    fold_available(spark, events, base, windows, "stream_marketing_total")
    ends = F.explode(F.sequence("window_us", "last_us", F.lit(10_000_000).cast("long"))).alias("end")
    found = read_table(spark, f"{base}/data", RUNS.format(key=key)).select(key, "cnt", ends)
    return found.select(utc_ntz(F.col("end") - 3_600_000_000).alias("window_start"), utc_ntz(F.col("end")).alias("window_end"),
                        F.lit("app marketing").alias("channel"), key, "cnt")


STREAM_QUERIES = {
    "stream_lines_rejects": stream_lines_rejects,
    "stream_ad_clicks_by_region": stream_ad_clicks_by_region,
    "stream_marketing_total": stream_marketing_total,
    "stream_hot_hosts_late": stream_hot_hosts_late,
    "stream_late_rows": stream_late_rows,
    "stream_page_views_hourly": stream_page_views_hourly,
    "stream_unique_visitors_hourly": stream_unique_visitors_hourly,
    "stream_uv_approx_hourly": stream_uv_approx_hourly,
    "stream_uv_running": stream_uv_running,
    "stream_hot_items": stream_hot_items,
    "stream_hot_items_fine_top": stream_hot_items_fine_top,
    "stream_tx_interval_join": stream_tx_interval_join,
    "stream_ad_quota": stream_ad_quota,
    "stream_order_timeout": stream_order_timeout,
    "stream_order_deadline": stream_order_deadline,
    "stream_fail_bursts": stream_fail_bursts,
    "stream_strict_pairs": stream_strict_pairs,
    "stream_fail_runs": stream_fail_runs,
    "stream_tx_interval_outer_join": stream_tx_interval_outer_join,
    "stream_tx_reconcile": stream_tx_reconcile,
}

# The watermark is the largest event time of the rows reaching the
# aggregation: Catalyst pushes the type filter below the watermark node.
_ORDER = "'signup', 'purchase'"
_ALL = "'signup', 'error', 'click', 'view', 'purchase'"
# passed by the watermark of the keyed patterns, in whole milliseconds
_DECIDED = "epoch_us({t}) < 1000 * (SELECT floor(epoch_us(max(ts)) / 1000) - 3000 FROM events WHERE event_type IN ({types}))"
_CLOSED = "(SELECT max(ts) FROM events WHERE event_type = 'view')"

_LATE = """
WITH v AS (SELECT event_id, ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
                  epoch_us(ts) + CAST(1000000 AS BIGINT) * CASE event_id % 10 WHEN 7 THEN 300 WHEN 8 THEN 2400 WHEN 9 THEN 86400 ELSE 0 END AS arrived
           FROM events WHERE event_type = 'click'),
b AS (SELECT min(arrived) AS low, max(arrived) - min(arrived) + 1 AS span FROM v),
a AS (SELECT event_id, ts, item_id, (arrived - low) * 5 // span AS f FROM v CROSS JOIN b),
m AS (SELECT k AS f, max(ts) AS seen FROM range(5) AS r(k) LEFT JOIN a ON a.f < k GROUP BY k),
"""

STREAM_ORACLE_SQL = {
    "stream_lines_rejects": f"""SELECT row_number() OVER (ORDER BY event_id) - 1 AS seq,
  CASE event_type WHEN 'error' THEN 'reject' ELSE 'row' END AS kind,
  user_id || ',' || json_extract_string(props, '$.k') || ',7,' || event_type || ','
  || CASE event_type WHEN 'error' THEN '{HUGE}' ELSE CAST(epoch_us(ts) // 1000000 AS VARCHAR) END AS line FROM events""",

    "stream_marketing_total": "SELECT * FROM (" + _BATCH_SQL["marketing_total"] + """) b
WHERE window_end <= (SELECT max(ts) FROM events WHERE event_type IS DISTINCT FROM 'error')""",

    "stream_ad_clicks_by_region": "WITH " + _QUOTA + f""",
nu AS ({_NATION_OF_USER}),
r AS (SELECT * FROM q WHERE n <= 3 AND {_DECIDED.format(t="ts", types=_ALL)}),
e AS (SELECT r.ts, nu.n_name AS province FROM r LEFT JOIN nu ON r.user_id = nu.user_id WHERE r.n <= 2),
c AS (SELECT * FROM (
        SELECT time_bucket(INTERVAL 5 SECOND, ts) + to_seconds(5 * k) AS window_end, province, count(*) AS cnt
        FROM e CROSS JOIN range(1, 721) AS s(k) GROUP BY 1, 2)
      WHERE window_end <= (SELECT max(ts) FROM r)),
""" + _PEAK.format(keys="province"),

    "stream_hot_hosts_late": _LATE + """
c AS (SELECT window_end, item_id, count(*) AS cnt
      FROM (SELECT time_bucket(INTERVAL 10 MINUTE, ts) + to_minutes(10 * j) AS window_end, item_id, seen
            FROM a JOIN m USING (f) CROSS JOIN range(1, 37) AS r(j))
      WHERE seen IS NULL OR window_end > seen - INTERVAL 70 MINUTE GROUP BY 1, 2)
SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) - 1 AS BIGINT) AS rank, item_id, cnt
FROM c WHERE window_end <= (SELECT max(ts) FROM v) - INTERVAL 10 MINUTE QUALIFY rank < 5""",

    "stream_late_rows": _LATE + """
z AS (SELECT 1)
SELECT event_id, ts, item_id FROM a JOIN m USING (f)
WHERE time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 6 HOUR <= seen - INTERVAL 70 MINUTE""",

    "stream_page_views_hourly": f"""
SELECT * FROM (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
         count(*) AS pv
  FROM events WHERE event_type = 'view' GROUP BY 1, 2)
WHERE window_end <= {_CLOSED}""",

    "stream_unique_visitors_hourly": f"""
SELECT * FROM (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
         count(DISTINCT user_id) AS uv
  FROM events WHERE event_type = 'view' GROUP BY 1, 2)
WHERE window_end <= {_CLOSED}""",

    "stream_hot_items": f"""
WITH v AS (SELECT ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events WHERE event_type = 'view'),
c AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) + to_minutes(10 * k) AS window_end, item_id, count(*) AS cnt
      FROM v CROSS JOIN range(1, 7) AS r(k) GROUP BY 1, 2)
SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS BIGINT) AS rank,
       item_id, cnt
FROM c WHERE window_end <= {_CLOSED} QUALIFY rank <= 3""",

    "stream_tx_interval_join": """
SELECT s.user_id, s.event_id AS signup_id, s.ts AS signup_ts, p.event_id AS purchase_id, p.ts AS purchase_ts
FROM events s JOIN events p
  ON s.user_id = p.user_id AND p.ts BETWEEN s.ts - INTERVAL 1 HOUR AND s.ts + INTERVAL 1 HOUR
WHERE s.event_type = 'signup' AND p.event_type = 'purchase'""",

    "stream_ad_quota": """
WITH q AS (SELECT event_id, user_id, event_type, ts,
                  CAST(row_number() OVER (PARTITION BY user_id, event_type, time_bucket(INTERVAL 1 DAY, ts)
                                          ORDER BY ts, event_id) AS BIGINT) AS n
           FROM events)
SELECT event_id, user_id, event_type, ts, n, CASE WHEN n <= 2 THEN 'pass' ELSE 'alert' END AS kind
FROM q WHERE n <= 3 AND """ + _DECIDED.format(t="ts", types=_ALL),

    "stream_order_timeout": """
WITH e AS (SELECT * FROM events WHERE event_type IN ('signup', 'purchase')),
n AS (SELECT user_id, ts, event_id, event_type,
             first_value(CASE WHEN event_type = 'purchase' THEN ts END IGNORE NULLS) OVER w AS nts,
             first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER w AS nid
      FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT user_id, ts AS create_ts, event_id AS create_id,
       CASE WHEN nts < ts + INTERVAL 6 HOUR THEN nts END AS pay_ts,
       CASE WHEN nts < ts + INTERVAL 6 HOUR THEN CAST(nid AS VARCHAR) END AS pay_id,
       CASE WHEN nts < ts + INTERVAL 6 HOUR THEN 'successfully' ELSE 'timeout' END AS kind
FROM n
WHERE event_type = 'signup' AND """ + _DECIDED.format(t="least(coalesce(nts, ts + INTERVAL 6 HOUR), ts + INTERVAL 6 HOUR)", types=_ORDER),

    "stream_fail_bursts": "SELECT b.* FROM (" + _BATCH_SQL["fail_bursts"] + ") b WHERE "
    + _DECIDED.format(t="b.first_ts + INTERVAL 24 HOUR", types=_ALL),

    "stream_strict_pairs": "SELECT b.* FROM (" + _BATCH_SQL["strict_pairs"] + ") b WHERE " + _DECIDED.format(t="b.last_ts", types=_ALL),
    "stream_fail_runs": "SELECT b.* FROM (" + _BATCH_SQL["fail_runs"] + ") b WHERE " + _DECIDED.format(t="b.last_ts", types=_ALL),

    "stream_tx_reconcile": "SELECT b.* FROM (" + _BATCH_SQL["tx_reconcile_dup"] + ") b WHERE " + _DECIDED.format(
        t="CASE WHEN kind = 'match' THEN greatest(signup_ts, purchase_ts) "
          "ELSE coalesce(signup_ts, purchase_ts) + INTERVAL 12 HOUR END", types=_ORDER),

    "stream_tx_interval_outer_join": """
WITH s AS (SELECT user_id, event_id AS signup_id, ts AS signup_ts FROM events WHERE event_type = 'signup'),
p AS (SELECT user_id, event_id AS purchase_id, ts AS purchase_ts FROM events WHERE event_type = 'purchase'),
j AS (SELECT s.user_id, s.signup_id, s.signup_ts, CAST(p.purchase_id AS VARCHAR) AS purchase_id, p.purchase_ts
      FROM s LEFT JOIN p ON s.user_id = p.user_id
       AND p.purchase_ts BETWEEN s.signup_ts - INTERVAL 1 HOUR AND s.signup_ts + INTERVAL 1 HOUR)
SELECT * FROM j
WHERE purchase_ts IS NOT NULL
   OR signup_ts + INTERVAL 1 HOUR < least((SELECT max(signup_ts) FROM s), (SELECT max(purchase_ts) FROM p))""",

    "stream_order_deadline": "SELECT * FROM (" + _BATCH_SQL["order_deadline"] + ") b WHERE " + _DECIDED.format(
        t="least(coalesce(pay_ts, create_ts + INTERVAL 6 HOUR), create_ts + INTERVAL 6 HOUR)", types=_ORDER),

    "stream_hot_items_fine_top": """
WITH v AS (SELECT ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events WHERE event_type = 'click'),
c AS (SELECT time_bucket(INTERVAL 5 SECOND, ts) + to_seconds(5 * k) AS window_end, item_id, count(*) AS cnt
      FROM v CROSS JOIN range(1, 121) AS r(k) GROUP BY 1, 2)
SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) - 1 AS BIGINT) AS rank,
       item_id, cnt
FROM c WHERE window_end <= (
  SELECT max(time_bucket(INTERVAL 5 SECOND, ts)) + INTERVAL 5 SECOND FROM v
  WHERE time_bucket(INTERVAL 5 SECOND, ts) + INTERVAL 5 SECOND <= (SELECT max(ts) FROM v) - INTERVAL 61 SECOND)
QUALIFY rank < 5""",

    "stream_uv_running": "SELECT b.* FROM (" + _BATCH_SQL["uv_running"] + ") b WHERE b.ts <= " + _CLOSED + " - INTERVAL 3 SECOND",
}
