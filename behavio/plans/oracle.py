"""DuckDB SQL equivalents of the catalogue (the correctness oracle).

Written independently of the Spark plans: sliding windows by joining each
row with the list of its window ends, next-event lookups with
``first_value ... IGNORE NULLS`` over following rows, the greedy bursts
with a recursive CTE.  Column names and types match the Spark results."""

_VIEW_ITEMS = "SELECT event_id, ts, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id FROM events WHERE event_type = '{t}'"

_NATION_OF_USER = "SELECT c_custkey AS user_id, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey"

_HOT_ITEMS_TOP = f"""
WITH v AS ({_VIEW_ITEMS.format(t='view')}),
c AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) + to_minutes(10 * k) AS window_end, item_id, count(*) AS cnt
      FROM v CROSS JOIN range(1, 7) AS r(k) GROUP BY 1, 2),
top AS (SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS BIGINT) AS rank,
               item_id, cnt FROM c QUALIFY rank <= 3)
"""

_QUOTA = """
q AS (SELECT event_id, user_id, event_type, ts, time_bucket(INTERVAL 1 DAY, ts) AS day,
             CAST(row_number() OVER (PARTITION BY user_id, event_type, time_bucket(INTERVAL 1 DAY, ts)
                                     ORDER BY ts, event_id) AS BIGINT) AS n
      FROM events)
"""

_NEXT_PAY = """
n AS (SELECT user_id, ts, event_id, event_type,
             first_value(CASE WHEN event_type = 'purchase' THEN ts END IGNORE NULLS) OVER w AS nts,
             first_value(CASE WHEN event_type = 'purchase' THEN event_id END IGNORE NULLS) OVER w AS nid
      FROM events
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
"""

_TX = """
WITH p AS (SELECT o_orderkey AS tx_id, o_orderdate AS pay_ts FROM orders),
r AS (SELECT l_orderkey AS tx_id, min(l_shipdate) AS receipt_ts FROM lineitem GROUP BY l_orderkey),
j AS (SELECT coalesce(p.tx_id, r.tx_id) AS tx_id, p.pay_ts, r.receipt_ts,
             CASE WHEN p.tx_id IS NOT NULL AND r.tx_id IS NOT NULL THEN 'match'
                  WHEN p.tx_id IS NOT NULL THEN 'pay_without_receipt' ELSE 'receipt_without_pay' END AS kind
      FROM p FULL OUTER JOIN r ON p.tx_id = r.tx_id
           AND r.receipt_ts BETWEEN p.pay_ts - INTERVAL 10 DAY AND p.pay_ts + INTERVAL 10 DAY)
SELECT * FROM j WHERE kind = '{kind}'
"""

_PEAK = """
p AS (SELECT *, max(cnt) OVER (PARTITION BY {keys}) AS peak FROM c)
SELECT {keys}, peak, min(window_end) FILTER (WHERE cnt = peak) AS peak_window_end, count(*) AS windows
FROM p GROUP BY {keys}, peak
"""

# windows of equal counts on one day, without a gap, as one row
_RUNS = """
f AS (SELECT *, date_trunc('day', window_end) AS d,
             CASE WHEN lag(cnt) OVER w = cnt AND lag(window_end) OVER w = window_end - to_seconds({slide}) THEN 0 ELSE 1 END AS s
      FROM c WINDOW w AS (PARTITION BY {keys}, date_trunc('day', window_end) ORDER BY window_end)),
g AS (SELECT *, sum(s) OVER (PARTITION BY {keys}, d ORDER BY window_end ROWS UNBOUNDED PRECEDING) AS r FROM f)
SELECT {keys}, min(window_end) AS first_end, max(window_end) AS last_end, any_value(cnt) AS cnt FROM g GROUP BY {keys}, d, r"""

ORACLE_SQL = {
    "hot_items": _HOT_ITEMS_TOP + "SELECT window_end, rank, item_id, cnt FROM top",

    "hot_items_report": _HOT_ITEMS_TOP + """
SELECT window_end,
       'time: ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || chr(10) ||
       string_agg('No:' || rank || chr(9) || 'item:' || item_id || chr(9) || 'count:' || cnt, chr(10) ORDER BY rank) AS report
FROM top GROUP BY window_end""",

    "hot_items_fine_top": f"""
WITH v AS ({_VIEW_ITEMS.format(t='click')}),
c AS (SELECT time_bucket(INTERVAL 5 SECOND, ts) + to_seconds(5 * k) AS window_end, item_id, count(*) AS cnt
      FROM v CROSS JOIN range(1, 121) AS r(k) GROUP BY 1, 2)
SELECT window_end, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) - 1 AS BIGINT) AS rank,
       item_id, cnt FROM c QUALIFY rank < 5""",

    "hot_items_fine": f"""
WITH v AS ({_VIEW_ITEMS.format(t='click')}),
c AS (SELECT time_bucket(INTERVAL 5 SECOND, ts) + to_seconds(5 * k) AS window_end, item_id, count(*) AS cnt
      FROM v CROSS JOIN range(1, 121) AS r(k) GROUP BY 1, 2),
""" + _PEAK.format(keys="item_id"),

    "hot_hosts": r"""
WITH h AS (SELECT lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)) AS host
           FROM pages WHERE NOT regexp_matches(url, '\.(css|js)$')),
c AS (SELECT host, count(*) AS cnt FROM h GROUP BY host)
SELECT host, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, host) - 1 AS BIGINT) AS rank FROM c QUALIFY rank < 5""",

    "page_views_hourly": """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS pv
FROM events WHERE event_type = 'view' GROUP BY 1, 2""",

    "unique_visitors_hourly": """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(DISTINCT user_id) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1, 2""",

    "uv_bitmap_hourly": """
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
       count(DISTINCT list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''),
                                                 lambda ch: CAST(ascii(ch) AS BIGINT)),
                                  lambda a, ch: (a * 73 + ch) % 536870912)) AS uv
FROM events WHERE event_type = 'view' GROUP BY 1, 2""",

    "uv_running": """
WITH v AS (SELECT event_id, ts, user_id, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end
           FROM events WHERE event_type = 'view'),
f AS (SELECT *, row_number() OVER (PARTITION BY window_end, user_id ORDER BY ts, event_id) = 1 AS first FROM v)
SELECT event_id, ts, window_end,
       CAST(sum(CASE WHEN first THEN 1 ELSE 0 END) OVER (PARTITION BY window_end ORDER BY ts, event_id
                                                          ROWS UNBOUNDED PRECEDING) AS BIGINT) AS uv
FROM f""",

    "marketing_total": """
WITH c AS (SELECT time_bucket(INTERVAL 10 SECOND, ts) + to_seconds(10 * k) AS window_end, count(*) AS cnt
           FROM events CROSS JOIN range(1, 361) AS r(k)
           WHERE event_type IS DISTINCT FROM 'error' GROUP BY 1)
SELECT window_end - INTERVAL 1 HOUR AS window_start, window_end, 'app marketing' AS channel, 'total' AS behavior, cnt FROM c""",

    "tx_reconcile_dup": """
WITH RECURSIVE e AS (
  SELECT user_id, event_type = 'purchase' AS buys, ts, event_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type = 'purchase', event_id) AS rn
  FROM events WHERE event_type IN ('signup', 'purchase')),
walk AS (
  SELECT user_id, rn, buys AS qside, [{'t': ts, 'i': event_id}] AS q, CAST(NULL AS BIGINT) AS a, CAST(NULL AS BIGINT) AS b
  FROM e WHERE rn = 1
  UNION ALL
  SELECT user_id, rn, CASE WHEN hit THEN qside ELSE buys END,
         CASE WHEN hit THEN live[2:] ELSE list_append(live, {'t': ts, 'i': event_id}) END,
         CASE WHEN hit THEN live[1].i END, CASE WHEN hit THEN event_id END
  FROM (SELECT *, len(live) > 0 AND qside <> buys AS hit FROM (
    SELECT e.user_id, e.rn, e.buys, e.ts, e.event_id, w.qside, list_filter(w.q, lambda x: x.t >= e.ts - INTERVAL 12 HOUR) AS live
    FROM walk w JOIN e ON e.user_id = w.user_id AND e.rn = w.rn + 1))),
m AS (SELECT CASE WHEN s.event_type = 'signup' THEN a ELSE b END AS l, CASE WHEN s.event_type = 'signup' THEN b ELSE a END AS r
      FROM walk JOIN events s ON s.event_id = walk.a WHERE a IS NOT NULL)
SELECT l.user_id, l.ts AS signup_ts, CAST(l.event_id AS VARCHAR) AS signup_id, r.ts AS purchase_ts,
       CAST(r.event_id AS VARCHAR) AS purchase_id, 'match' AS kind
FROM m JOIN events l ON l.event_id = m.l JOIN events r ON r.event_id = m.r
UNION ALL
SELECT user_id, ts, CAST(event_id AS VARCHAR), NULL, NULL, 'pay_without_receipt' FROM events
WHERE event_type = 'signup' AND event_id NOT IN (SELECT l FROM m)
UNION ALL
SELECT user_id, NULL, NULL, ts, CAST(event_id AS VARCHAR), 'receipt_without_pay' FROM events
WHERE event_type = 'purchase' AND event_id NOT IN (SELECT r FROM m)""",

    "marketing_windows": f"""
WITH nu AS ({_NATION_OF_USER}),
e AS (SELECT ev.ts, nu.n_name AS channel, ev.event_type AS behavior
      FROM events ev LEFT JOIN nu ON ev.user_id = nu.user_id WHERE ev.event_type IS DISTINCT FROM 'error'),
c AS (SELECT time_bucket(INTERVAL 10 SECOND, ts) + to_seconds(10 * k) AS window_end, channel, behavior, count(*) AS cnt
      FROM e CROSS JOIN range(1, 361) AS r(k) GROUP BY 1, 2, 3),
""" + _RUNS.format(keys="channel, behavior", slide=10),

    "ad_click_windows": "WITH " + _QUOTA + f""",
nu AS ({_NATION_OF_USER}),
e AS (SELECT q.ts, nu.n_name AS province FROM q LEFT JOIN nu ON q.user_id = nu.user_id WHERE q.n <= 2),
c AS (SELECT time_bucket(INTERVAL 5 SECOND, ts) + to_seconds(5 * k) AS window_end, province, count(*) AS cnt
      FROM e CROSS JOIN range(1, 721) AS r(k) GROUP BY 1, 2),
""" + _RUNS.format(keys="province", slide=5),

    "marketing_by_channel": f"""
WITH nu AS ({_NATION_OF_USER}),
e AS (SELECT ev.ts, nu.n_name AS channel, ev.event_type AS behavior
      FROM events ev LEFT JOIN nu ON ev.user_id = nu.user_id WHERE ev.event_type IS DISTINCT FROM 'error'),
c AS (SELECT time_bucket(INTERVAL 10 SECOND, ts) + to_seconds(10 * k) AS window_end, channel, behavior, count(*) AS cnt
      FROM e CROSS JOIN range(1, 361) AS r(k) GROUP BY 1, 2, 3),
""" + _PEAK.format(keys="channel, behavior"),

    "ad_quota_passed": "WITH " + _QUOTA + "SELECT event_id, user_id, event_type, ts, n FROM q WHERE n <= 2",

    "ad_quota_alerts": "WITH " + _QUOTA + """
SELECT user_id, event_type, day, ts, 'click over 2 times today' AS msg FROM q WHERE n = 3""",

    "ad_clicks_by_region": "WITH " + _QUOTA + f""",
nu AS ({_NATION_OF_USER}),
e AS (SELECT q.ts, nu.n_name AS province FROM q LEFT JOIN nu ON q.user_id = nu.user_id WHERE q.n <= 2),
c AS (SELECT time_bucket(INTERVAL 5 SECOND, ts) + to_seconds(5 * k) AS window_end, province, count(*) AS cnt
      FROM e CROSS JOIN range(1, 721) AS r(k) GROUP BY 1, 2),
""" + _PEAK.format(keys="province"),

    "strict_pairs": """
WITH l AS (SELECT user_id, ts, event_id, event_type,
                  lead(event_type) OVER w AS nt, lead(ts) OVER w AS nts
           FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, ts AS first_ts, nts AS last_ts, event_id AS first_seq, CAST(2 AS BIGINT) AS n
FROM l WHERE event_type = 'error' AND nt = 'error' AND nts < ts + INTERVAL 2 HOUR""",

    "fail_runs": """
WITH e AS (SELECT user_id, ts, event_id, event_type = 'error' AS c FROM events),
l AS (SELECT *, lag(c) OVER w AS pc, lag(ts) OVER w AS pt FROM e
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CASE WHEN c AND (NOT coalesce(pc, false) OR ts > pt + INTERVAL 12 HOUR) THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM l),
r AS (SELECT user_id, ts, event_id,
             row_number() OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS fails,
             first_value(ts) OVER (PARTITION BY user_id, island ORDER BY ts, event_id) AS first_ts
      FROM s WHERE c)
SELECT user_id, first_ts, ts AS last_ts, event_id, CAST(fails AS BIGINT) AS fails FROM r WHERE fails >= 3""",

    "fail_bursts": """
WITH RECURSIVE e AS (
  SELECT user_id, ts, event_id, event_type = 'error' AS c,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
ns AS (SELECT *, min(CASE WHEN NOT c THEN rn END) OVER w AS next_other,
              min(CASE WHEN NOT c THEN ts END) OVER w AS next_other_ts FROM e
       WINDOW w AS (PARTITION BY user_id ORDER BY rn ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
f AS (SELECT user_id, ts, rn, coalesce(next_other, 9223372036854775807) AS stop, next_other_ts AS stop_ts
      FROM ns WHERE c),
nxt AS (SELECT a.user_id, a.rn, min(b.rn) AS nrn FROM f a JOIN f b
          ON a.user_id = b.user_id AND b.rn > a.rn AND (b.ts > a.ts + INTERVAL 24 HOUR OR b.rn > a.stop)
        GROUP BY a.user_id, a.rn),
chain(user_id, rn) AS (
  SELECT user_id, min(rn) FROM f GROUP BY user_id
  UNION ALL
  SELECT n.user_id, n.nrn FROM chain c JOIN nxt n ON n.user_id = c.user_id AND n.rn = c.rn)
SELECT o.user_id, o.ts AS first_ts, max(m.ts) AS last_ts, count(*) AS fails
FROM chain c JOIN f o ON o.user_id = c.user_id AND o.rn = c.rn
JOIN f m ON m.user_id = o.user_id AND m.rn >= o.rn AND m.rn < o.stop AND m.ts <= o.ts + INTERVAL 24 HOUR
WHERE o.stop_ts IS NULL OR o.stop_ts > o.ts + INTERVAL 24 HOUR
GROUP BY o.user_id, o.ts, o.rn HAVING count(*) > 2""",

    "order_paid": "WITH " + _NEXT_PAY + """
SELECT user_id, ts AS create_ts, event_id AS create_id, nts AS pay_ts, nid AS pay_id
FROM n WHERE event_type = 'signup' AND nts < ts + INTERVAL 6 HOUR""",

    "order_timeout": "WITH " + _NEXT_PAY + """
SELECT user_id, ts AS create_ts, event_id AS create_id
FROM n WHERE event_type = 'signup' AND NOT coalesce(nts < ts + INTERVAL 6 HOUR, false)""",

    "order_deadline": "WITH " + _NEXT_PAY + """,
d AS (SELECT user_id, ts AS create_ts, CASE WHEN nts <= ts + INTERVAL 6 HOUR THEN nts END AS pay_ts
      FROM n WHERE event_type = 'signup')
SELECT user_id, create_ts,
       CASE WHEN pay_ts IS NOT NULL THEN 'Order Pay Successfully' ELSE 'Order Pay Timeout' END AS result,
       pay_ts, CAST(floor((epoch_us(pay_ts) - epoch_us(create_ts)) / 60000000) AS DOUBLE) AS delay_min,
       CAST(360 AS BIGINT) AS deadline_min
FROM d""",

    "tx_interval_join": """
SELECT s.user_id, s.event_id AS signup_id, s.ts AS signup_ts, p.event_id AS purchase_id, p.ts AS purchase_ts
FROM events s JOIN events p
  ON s.user_id = p.user_id AND p.ts BETWEEN s.ts - INTERVAL 1 HOUR AND s.ts + INTERVAL 1 HOUR
WHERE s.event_type = 'signup' AND p.event_type = 'purchase'""",

    "tx_match": _TX.format(kind="match"),
    "pay_without_receipt": _TX.format(kind="pay_without_receipt"),
    "receipt_without_pay": _TX.format(kind="receipt_without_pay"),
}
