"""Text-line queries: lines of each record layout are formed from ``events``,
then read back by the parsers, ``lines_in_order`` through text files.  An event of type 'error' gives a bad line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import json_long
from ..functions.times import epoch_micros
from ..operators import drop_static_urls, merge_unique_state, unique_count
from ..operators.unique_state import BitmapState, window_counts
from ..operators.uniques import with_bit_offset
from ..session import scratch_path
from .oracle import ORACLE_SQL as _BATCH_SQL
from ..sources.lines import LAYOUTS, parse_lines, parsed_fields, read_lines
from ..sources.tables import table

#: An epoch that no timestamp holds.
HUGE = "99999999999999999"


def _events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("*", json_long("props", "k").alias("k"))


def _text(e: DataFrame, layout: str) -> Column:
    """The line of an event in a layout."""
    us = epoch_micros(e, "ts")
    s = F.floor(us / 1_000_000).cast("long").cast("string")
    bad = F.col("event_type") == "error"
    epoch = F.when(bad, F.lit(HUGE)).otherwise(s)
    pay = F.col("event_type") == "purchase"
    kind = F.when(pay, "pay").otherwise("create")
    clock = F.date_format("ts", "dd/MM/yyyy:HH:mm:ss")
    suffix = F.when(F.col("event_type") == "click", ".css").when(F.col("event_type") == "signup", ".js?x").otherwise("")
    fields: dict[str, list[Column]] = {
        "behaviour": [F.col("user_id"), F.col("k"), F.lit(7), F.col("event_type"), epoch],
        "login": [F.col("user_id"), F.concat(F.lit("10.0.0."), "k"), F.col("event_type"), epoch],
        "ad": [F.when(bad, F.lit("x1")).otherwise(F.col("user_id").cast("string")), F.col("k"), F.lit("north"), F.col("event_type"), s],
        "order": [F.col("event_id"), kind, F.lit(""), epoch],
        "order_tx": [F.col("event_id"), kind, F.when(pay, F.concat(F.lit("tx"), "k")).otherwise(""), epoch],
        "receipt": [F.concat(F.lit("tx"), "k"), F.col("event_type"), epoch],
        "access_log": [F.concat(F.lit("10.0.0."), "k"), F.col("user_id"), F.lit("-"),
                       F.when(bad, F.lit("31/02/2024:00:00:00")).otherwise(clock), F.lit("+0000"), F.lit("GET"),
                       F.concat(F.lit("/p"), "k", suffix)],
        "marketing": [F.concat(F.lit("u"), "user_id"), F.col("event_type"), F.lit("AppStore"),
                      F.when(bad, F.lit("")).otherwise(F.floor(us / 1000).cast("long").cast("string"))],
    }
    return F.concat_ws(LAYOUTS[layout].sep, *[c.cast("string") for c in fields[layout]])


def _lines(spark: SparkSession, d: str, layout: str) -> DataFrame:
    e = _events(spark, d)
    return e.select(_text(e, layout).alias("value"))


def line_files(spark: SparkSession, d: str, layout: str) -> str:
    """Folder of text files with the events' lines, in event order over the files by name."""
    e = _events(spark, d)
    folder = scratch_path(spark, f"text-{layout}")
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (e.select("event_id", _text(e, layout).alias("value")).repartitionByRange(files, "event_id").sortWithinPartitions("event_id")
     .select("value").write.text(folder))
    return folder


def lines_in_order(spark: SparkSession, d: str) -> DataFrame:
    """Good lines of a folder of text files with their line numbers over all files and splits."""
    rows, _ = read_lines(spark, line_files(spark, d, "behaviour"), "behaviour", on_error="reject", in_order=True)
    return rows


def _parsed(layout: str):
    def query(spark: SparkSession, d: str) -> DataFrame:
        return parse_lines(_lines(spark, d, layout), layout).where("_ok").select(*[n for n, _, _ in LAYOUTS[layout].fields])
    query.__name__ = f"lines_{layout}"
    query.__doc__ = f"Events as lines of the {layout} layout, parsed; bad lines left out."
    return query


def lines_rejects(spark: SparkSession, d: str) -> DataFrame:
    """The bad lines of every layout: impossible dates, epochs out of range, no number.  One scan for all layouts."""
    e = _events(spark, d)
    lines = e.select(F.explode(F.array(*[F.struct(F.lit(n).alias("layout"), _text(e, n).alias("line")) for n in sorted(LAYOUTS)])).alias("x"))
    lines = lines.select("x.layout", "x.line")
    ok = F.lit(False)
    for n in LAYOUTS:
        ok = F.when(F.col("layout") == n, parsed_fields(F.col("line"), n)[1]).otherwise(ok)
    return lines.where(~ok).groupBy("layout").agg(F.count(F.lit(1)).alias("rejects"), F.min("line").alias("first"))


def pages_without_static(spark: SparkSession, d: str) -> DataFrame:
    """Requests per URL of the access log, without .css and .js files."""
    return (drop_static_urls(lines_queries["lines_access_log"](spark, d), "url").groupBy("url")
            .agg(F.count(F.lit(1)).alias("cnt")))


def pays_with_tx(spark: SparkSession, d: str) -> DataFrame:
    """Pays of the order lines; creates carry an empty transaction id."""
    from .jobs import _pays
    return _pays(lines_queries["lines_order_tx"](spark, d))


def uv_two_runs(spark: SparkSession, d: str) -> DataFrame:
    """Hourly unique viewers from state kept across two runs (U4): the first
    run stores what it has seen, the second brings everything again."""
    v = with_bit_offset(table(spark, d, "events").where(F.col("event_type") == "view").select("ts", "user_id"), "user_id")
    seen = v.select(F.window("ts", "1 hour").end.alias("window_end"), "offset", "ts")
    path = scratch_path(spark, "uv-state")
    empty = spark.createDataFrame([], "window_end timestamp_ntz, offset long")
    first, _ = merge_unique_state(seen.where("ts < TIMESTAMP_NTZ'2024-01-16 00:30:00'"), empty)
    first.write.parquet(path)
    _, counts = merge_unique_state(seen, spark.read.parquet(path))
    return counts


def uv_kept_runs(spark: SparkSession, d: str) -> DataFrame:
    """Hourly unique viewers by bitmaps kept over three runs, of which the second is brought twice (U4)."""
    v = table(spark, d, "events").where(F.col("event_type") == "view").select("event_id", "ts", "user_id")
    state = BitmapState(spark, scratch_path(spark, "uv-bitmaps"))
    for run in (0, 1, 1, 2):
        state.add(v.where(F.col("event_id") % 3 == run), f"run-{run}", "ts", "user_id")
    return window_counts(state)


def uv_approx_close(spark: SparkSession, d: str) -> DataFrame:
    """Per hour, whether the HLL estimate is within 5 % (or 1) of the exact count."""
    v = table(spark, d, "events").where(F.col("event_type") == "view")
    a = unique_count(v, "ts", "1 hour", "user_id", method="hll", out="estimate")
    b = unique_count(v, "ts", "1 hour", "user_id", out="uv").drop("window_start")
    close = F.abs(F.col("estimate") - F.col("uv")) <= F.greatest(F.lit(1), 0.05 * F.col("uv"))
    return a.join(b, "window_end").select("window_end", "uv", close.alias("close"))


lines_queries = {f"lines_{n}": _parsed(n) for n in LAYOUTS}
QUERIES = {**lines_queries, "lines_rejects": lines_rejects, "lines_in_order": lines_in_order, "pages_without_static": pages_without_static, "pays_with_tx": pays_with_tx,
           "uv_two_runs": uv_two_runs, "uv_kept_runs": uv_kept_runs, "uv_approx_close": uv_approx_close}

_E = """e AS (SELECT *, json_extract_string(props, '$.k') AS k, date_trunc('second', ts) AS s,
  CASE WHEN event_type = 'purchase' THEN 'pay' ELSE 'create' END AS kind FROM events)"""
_GOOD = "FROM e WHERE event_type <> 'error'"
_URL = "'/p' || k || CASE event_type WHEN 'click' THEN '.css' WHEN 'signup' THEN '.js?x' ELSE '' END"

ORACLE_SQL = {
    "lines_behaviour": f"WITH {_E} SELECT user_id, CAST(k AS BIGINT) AS item_id, 7 AS category_id, event_type AS behavior, s AS ts {_GOOD}",
    "lines_login": f"WITH {_E} SELECT user_id, '10.0.0.' || k AS ip, event_type, s AS ts {_GOOD}",
    "lines_ad": f"WITH {_E} SELECT user_id, CAST(k AS BIGINT) AS ad_id, 'north' AS province, event_type AS city, s AS ts {_GOOD}",
    "lines_order": f"WITH {_E} SELECT event_id AS order_id, kind AS event_type, s AS ts {_GOOD}",
    "lines_order_tx": f"WITH {_E} SELECT event_id AS order_id, kind AS event_type, CASE kind WHEN 'pay' THEN 'tx' || k ELSE '' END AS tx_id, s AS ts {_GOOD}",
    "lines_receipt": f"WITH {_E} SELECT 'tx' || k AS tx_id, event_type AS pay_channel, s AS ts {_GOOD}",
    "lines_access_log": f"WITH {_E} SELECT '10.0.0.' || k AS ip, CAST(user_id AS VARCHAR) AS user_id, s AS ts, 'GET' AS method, {_URL} AS url {_GOOD}",
    "lines_marketing": f"WITH {_E} SELECT 'u' || user_id AS user_id, event_type AS behavior, 'AppStore' AS channel, date_trunc('millisecond', ts) AS ts {_GOOD}",
    "lines_in_order": f"WITH {_E}, o AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS seq FROM e) SELECT seq, user_id, CAST(k AS BIGINT) AS item_id, 7 AS category_id, event_type AS behavior, s AS ts FROM o WHERE event_type <> 'error'",
    "lines_rejects": f"""WITH {_E}, b AS (SELECT *, CAST(epoch_us(s) // 1000000 AS VARCHAR) AS t FROM e WHERE event_type = 'error'),
l AS (SELECT unnest([
  {{'n': 'behaviour', 'v': user_id || ',' || k || ',7,error,{HUGE}'}}, {{'n': 'login', 'v': user_id || ',10.0.0.' || k || ',error,{HUGE}'}},
  {{'n': 'ad', 'v': 'x1,' || k || ',north,error,' || t}}, {{'n': 'order', 'v': event_id || ',' || kind || ',,{HUGE}'}},
  {{'n': 'order_tx', 'v': event_id || ',' || kind || ',,{HUGE}'}}, {{'n': 'receipt', 'v': 'tx' || k || ',error,{HUGE}'}},
  {{'n': 'access_log', 'v': '10.0.0.' || k || ' ' || user_id || ' - 31/02/2024:00:00:00 +0000 GET /p' || k}},
  {{'n': 'marketing', 'v': 'u' || user_id || ',error,AppStore,'}}]) AS x FROM b)
SELECT x.n AS layout, count(*) AS rejects, min(x.v) AS first FROM l GROUP BY 1""",
    "pages_without_static": f"WITH {_E}, u AS (SELECT {_URL} AS url {_GOOD}) SELECT url, count(*) AS cnt FROM u WHERE url NOT LIKE '%.css' AND url NOT LIKE '%.js' GROUP BY 1",
    "pays_with_tx": f"WITH {_E} SELECT 'tx' || k AS tx_id, event_id AS order_id, s AS pay_ts FROM e WHERE event_type = 'purchase'",
    "uv_kept_runs": _BATCH_SQL["uv_bitmap_hourly"],
    "uv_two_runs": "SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(DISTINCT user_id) AS uv FROM events WHERE event_type = 'view' GROUP BY 1",
    "uv_approx_close": "SELECT time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(DISTINCT user_id) AS uv, true AS close FROM events WHERE event_type = 'view' GROUP BY 1",
}
