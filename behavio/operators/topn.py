"""Top-N per group (T1, T2) and the text report per group (T4).

``row_number() <= n`` over a partition is planned by Catalyst as a
partial WindowGroupLimit before the shuffle, so each map task sends at
most n rows per group; hot groups are cut down before the exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def _list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def top_n(counts: DataFrame, by, order_col: str, key, n: int, rank_base: int = 1,
          rank_col: str = "rank") -> DataFrame:
    """Keep the n rows with the largest ``order_col`` per ``by`` group.

    Ties are broken by ``key`` ascending, so the result is deterministic.
    ``rank`` starts at ``rank_base`` (1 for hot items, 0 for hot pages)."""
    by, key = _list(by), _list(key)
    order = [F.col(order_col).desc(), *[F.col(k).asc() for k in key]]
    if not by:
        # Global top-n: TakeOrderedAndProject keeps n rows per task, then
        # ranks the n survivors.
        top = counts.orderBy(*order).limit(n)
        return (top.withColumn(rank_col, (F.row_number().over(Window.orderBy(*order))
                                          + F.lit(rank_base - 1)).cast("long")))
    w = Window.partitionBy(*by).orderBy(F.col(order_col).desc(), *[F.col(k).asc() for k in key])
    return (counts.withColumn("_rn", F.row_number().over(w))
                  .where(F.col("_rn") <= n)
                  .withColumn(rank_col, (F.col("_rn") + F.lit(rank_base - 1)).cast("long"))
                  .drop("_rn"))


def top_n_report(top: DataFrame, by: str, key: str, order_col: str, rank_col: str = "rank",
                 label: str = "item", report_col: str = "report") -> DataFrame:
    """One text row per group: a header with the group value and one line
    ``No:<rank>\\t<label>:<key>\\tcount:<n>`` per ranked row, best first.
    The list per group holds at most n rows (input of ``top_n``)."""
    line = F.format_string(f"No:%d\t{label}:%s\tcount:%d", F.col(rank_col), F.col(key).cast("string"),
                           F.col(order_col))
    lines = F.sort_array(F.collect_list(F.struct(F.col(rank_col).alias("r"), line.alias("l"))))
    body = F.array_join(F.transform(lines, lambda x: x["l"]), "\n")
    header = F.concat(F.lit("time: "), F.date_format(F.col(by), "yyyy-MM-dd HH:mm:ss"))
    return (top.groupBy(by)
               .agg(body.alias("_body"))
               .select(by, F.concat_ws("\n", header, F.col("_body")).alias(report_col)))
