"""Per-key daily click quota with one alert per limited key.

The reference keeps a counter per (user, ad): a click passes while the
counter is <= max_count, so max_count + 1 clicks pass (D5), and the first
blocked click raises one alert.  Here the click's position ``n`` in
(ts, seq) order within (keys, day) decides: passed = n <= max_passed,
alert = n == max_passed + 1.  Only rows with n <= max_passed + 1 are ever
needed, so the filter lets Catalyst put a partial WindowGroupLimit before
the shuffle: a hot key sends at most max_passed + 1 rows per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Fixed value: the reference lets 101 clicks per (user, ad) and day pass.
DEFAULT_MAX_PASSED = 101


def alert_text(max_passed: int):
    # Fixed message format of the reference's blacklist warning.
    return F.lit(f"click over {max_passed} times today")


def quota(df: DataFrame, keys, ts: str, seq: str, max_passed: int = DEFAULT_MAX_PASSED,
          reset: str = "day") -> DataFrame:
    """Rows with n <= max_passed + 1 plus columns day, n, passed, alert, msg.

    reset="day": the count restarts at each UTC day of event time (D6);
    reset="none": one count for the whole input (a file replay)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    part = list(keys)
    x = df
    if reset == "day":
        x = x.withColumn("day", F.window(ts, "1 day").start)
        part.append("day")
    elif reset == "none":
        x = x.withColumn("day", F.lit(None).cast(df.schema[ts].dataType))
    else:
        raise ValueError(reset)
    w = Window.partitionBy(*part).orderBy(ts, seq)
    x = (x.withColumn("n", F.row_number().over(w))
          .where(F.col("n") <= max_passed + 1)
          .withColumn("n", F.col("n").cast("long")))
    return (x.withColumn("passed", F.col("n") <= max_passed)
             .withColumn("alert", F.col("n") == max_passed + 1)
             .withColumn("msg", F.when(F.col("alert"), alert_text(max_passed))))
