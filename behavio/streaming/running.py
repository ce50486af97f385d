"""Running distinct users and fine sliding rankings on a stream, by folding
micro-batches into tables.

For running users, a micro-batch joins the rows that still wait; rows up to the new watermark (the
largest time minus the delay) are taken in (time, seq) order.  What later
batches need is written per batch: the waiting rows, the users seen in open windows,
and one count per open window.  All steps are joins and aggregations, and the
running count is taken per (window, slice), so neither a busy window nor a
batch meets in one task.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.times import epoch_micros, micros_of, positive_micros, window_text
from ..operators.topn import top_n
from ..operators.windows import sliding_count_of_panes

SCHEMAS = {"waiting": "seq long, us long, user_id long, window_us long", "seen": "window_us long, user_id long",
           "counts": "window_us long, base long", "mark": "wm long, late long"}


def running_users(base: str, ts: str, seq: str, user: str, size="1 hour", delay="0 seconds", slice_="1 minute"):
    """A ``foreachBatch`` function that writes (seq, us, window_us, uv) below
    ``{base}/data``, rows behind the watermark (seq, us, user_id) below ``{base}/late`` and its
    state below ``{base}/state``; re-running a batch replaces all three."""
    slice_us, delay_us = positive_micros(slice_), micros_of(delay)

    def stored(spark: SparkSession, name: str, batch: int) -> DataFrame:
        if batch < 0:
            return spark.createDataFrame([], SCHEMAS[name])
        return spark.read.schema(SCHEMAS[name]).parquet(f"{base}/state/{name}/microbatch={batch}").select(
            *[c.split(" ")[0] for c in SCHEMAS[name].split(", ")])

    def fold(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession

        def keep(df: DataFrame, name: str) -> DataFrame:
            path = f"{base}/state/{name}/microbatch={batch}"
            df.write.mode("overwrite").parquet(path)
            return stored(spark, name, batch)
        old = {n: stored(spark, n, batch - 1) for n in SCHEMAS}
        new = rows.select(F.col(seq).cast("long").alias("seq"), F.unix_micros(ts).alias("us"), F.col(user).cast("long").alias("user_id"),
                          F.unix_micros(F.window(ts, window_text(size)).end).alias("window_us"))
        last = old["mark"].agg(F.max("wm")).first()[0]
        late = 0
        if last is not None:
            at = f"{base}/late/microbatch={batch}"
            new.where(F.col("us") <= last).select("seq", "us", "user_id").write.mode("overwrite").parquet(at)
            late = spark.read.parquet(at).count()
            new = new.where(F.col("us") > last)
        top = new.agg(F.max("us")).first()[0]
        wm = max(x for x in (last, None if top is None else top - delay_us, -(1 << 62)) if x is not None)
        waiting = new.unionByName(old["waiting"])
        ready = waiting.where(F.col("us") <= wm)
        firsts = (ready.where("user_id IS NOT NULL").groupBy("window_us", "user_id").agg(F.min(F.struct("us", "seq")).alias("f"))
                  .join(old["seen"], ["window_us", "user_id"], "left_anti"))
        marks = firsts.select("window_us", "f.us", "f.seq")
        of_slice = F.floor(F.col("us") / F.lit(slice_us)).alias("slice")
        per_slice = marks.groupBy("window_us", of_slice).agg(F.count(F.lit(1)).alias("n"))
        end = F.floor((F.col("window_us") - 1) / F.lit(slice_us))
        carry = per_slice.where(F.col("slice") < end).select(
            "window_us", F.explode(F.sequence(F.col("slice") + 1, end)).alias("slice"), F.col("n").alias("m"))
        none = [F.lit(None).cast("long").alias(c) for c in ("us", "seq")]
        every = (ready.select("window_us", of_slice, "us", "seq", F.lit(0).cast("long").alias("m"))
                 .unionByName(marks.select("window_us", of_slice, "us", "seq", F.lit(1).cast("long").alias("m")))
                 .unionByName(carry.select("window_us", "slice", *none, "m")))
        w = (Window.partitionBy("window_us", "slice").orderBy(F.col("us").asc_nulls_first(), F.col("seq").asc_nulls_first(), F.col("m").desc())
             .rowsBetween(Window.unboundedPreceding, 0))
        out = (every.withColumn("c", F.sum("m").over(w)).where("us IS NOT NULL AND m = 0")
               .join(old["counts"], "window_us", "left")
               .select("seq", "us", "window_us", (F.col("c") + F.coalesce("base", F.lit(0))).alias("uv")))
        out.write.mode("overwrite").parquet(f"{base}/data/microbatch={batch}")
        is_open = F.col("window_us") > wm
        keep(waiting.where(F.col("us") > wm), "waiting")
        keep(old["seen"].unionByName(firsts.select("window_us", "user_id")).where(is_open), "seen")
        keep(old["counts"].unionByName(marks.groupBy("window_us").agg(F.count(F.lit(1)).alias("base")))
             .where(is_open).groupBy("window_us").agg(F.sum("base").alias("base")), "counts")
        keep(spark.createDataFrame([(wm, late)], SCHEMAS["mark"]), "mark")

    return fold


def sliding_top(base: str, key: str, size, slide, n: int, rank_base: int = 1):
    """A ``foreachBatch`` function over closed pane counts (pane, key, c), each
    emitted once: ranks the windows that end at the batch's last pane end or
    before and after the previous batch's.  The panes of the last ``size`` are
    written for the next batch, so a window's rows never enter stream state; counts come in
    the difference form, whose work follows the windows."""
    size_us = positive_micros(size)
    pane_us = gcd(size_us, positive_micros(slide))
    schema = f"pane timestamp, {key} long, c long"

    def fold(panes: DataFrame, batch: int) -> None:
        spark = panes.sparkSession
        state = f"{base}/state/panes/microbatch="
        old = spark.read.schema(schema).parquet(f"{state}{batch - 1}") if batch else spark.createDataFrame([], schema)
        new = panes.select("pane", key, "c")
        end = lambda df: df.agg(F.max(F.unix_micros("pane"))).first()[0]
        low, high = end(old), end(new)
        every = old.unionByName(new)
        if high is not None:
            counts = sliding_count_of_panes(every, size, slide, [key])
            ends = epoch_micros(counts, "window_end")
            done = counts.where(ends <= high + pane_us)
            if low is not None:
                done = done.where(ends > low + pane_us)
            out = top_n(done, "window_end", "cnt", key, n, rank_base).select("window_end", "rank", key, "cnt")
            out.write.mode("overwrite").parquet(f"{base}/data/microbatch={batch}")
            every = every.where(F.unix_micros("pane") > high - size_us)
        every.write.mode("overwrite").parquet(f"{state}{batch}")

    return fold
