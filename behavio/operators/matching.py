"""Two-stream matching.

* ``interval_join``: inner band join, all pairs with
  left.ts + lower <= right.ts <= left.ts + upper (both ends inclusive).
  Equi-join on (key, time bucket) plus the exact band predicate: each
  left row is replicated to the 1-2 buckets of width upper - lower that
  its band touches, so a hot key is split by time and only pairs from
  neighbouring buckets are ever compared.
* ``reconcile``: one-to-one matching with a tolerance, reporting the
  unmatched rows of both sides in a ``kind`` column.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.times import epoch_micros, interval, micros_of, positive_micros
from ..session import written

MATCH, PAY_ONLY, RECEIPT_ONLY = "match", "pay_without_receipt", "receipt_without_pay"


def interval_join(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str,
                  lower="-10 seconds", upper="10 seconds", how: str = "inner") -> DataFrame:
    """Inner band join on ``key`` (all pairs in the band, as the
    reference's interval join).  Column names other than ``key`` must
    differ between the sides."""
    lo_us, hi_us = micros_of(lower), micros_of(upper)
    if hi_us < lo_us:
        raise ValueError("upper < lower")
    width = max(hi_us - lo_us, 1)
    lm = epoch_micros(left, lts)
    lb = left.withColumn("_b", F.explode(F.sequence(
        F.floor((lm + F.lit(lo_us)) / F.lit(width)), F.floor((lm + F.lit(hi_us)) / F.lit(width))))).alias("_lt")
    rb = right.withColumn("_b", F.floor(epoch_micros(right, rts) / F.lit(width))).alias("_rt")
    lc = lambda c: F.col(f"_lt.`{c}`")
    rc = lambda c: F.col(f"_rt.`{c}`")
    cond = ((lc(key) == rc(key)) & (lc("_b") == rc("_b"))
            & (rc(rts) >= lc(lts) + interval(lower)) & (rc(rts) <= lc(lts) + interval(upper)))
    pairs = lb.join(rb, cond, "inner").select(
        *[lc(c).alias(c) for c in left.columns], *[rc(c).alias(c) for c in right.columns if c != key])
    if how != "inner":
        raise ValueError(how)
    return pairs


def _kind_rows(l: DataFrame, r: DataFrame, key: str, left: list[str], right: list[str], on, kind: str | None) -> DataFrame:
    """The join of aliased sides for one kind, or for all three (full outer)."""
    lc = lambda c: F.col(f"_lt.`{c}`")
    rc = lambda c: F.col(f"_rt.`{c}`")
    null = lambda d, c: F.lit(None).cast(d.schema[c].dataType).alias(c)
    if kind == MATCH:
        return l.join(r, on, "inner").select(lc(key).alias(key), *[lc(c) for c in left], *[rc(c) for c in right],
                                             F.lit(MATCH).alias("kind"))
    if kind == PAY_ONLY:
        return l.join(r, on, "left_anti").select(key, *left, *[null(r, c) for c in right], F.lit(PAY_ONLY).alias("kind"))
    if kind == RECEIPT_ONLY:
        return r.join(l, on, "left_anti").select(key, *[null(l, c) for c in left], *right, F.lit(RECEIPT_ONLY).alias("kind"))
    if kind is not None:
        raise ValueError(kind)
    j = l.withColumn("_l", F.lit(True)).alias("_lt").join(r.withColumn("_r", F.lit(True)).alias("_rt"), on, "full_outer")
    which = (F.when(F.col("_l") & F.col("_r"), MATCH).when(F.col("_l"), PAY_ONLY).otherwise(RECEIPT_ONLY))
    return j.select(F.coalesce(lc(key), rc(key)).alias(key), *[lc(c) for c in left], *[rc(c) for c in right], which.alias("kind"))


def reconcile(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str, tolerance="5 seconds",
              pair_duplicates: bool = True, kind: str | None = None) -> DataFrame:
    """One-to-one matching within ``tolerance`` (inclusive) by key; ``kind``
    asks for one kind of row only.

    With ``pair_duplicates`` a key may have several rows on either side, taken
    in time order (left before right at equal times, then by the other columns): a
    row consumes the oldest waiting row of the other side within the
    tolerance, or waits itself.  Rows without any of the other side within the tolerance are
    decided in SQL; the others are matched by time groups of a key, see
    ``_reconcile_chains``.  Without it keys are taken to be unique, and each kind is a plain
    inner or anti join with the band.

    Rows with a null key or time match nothing and are reported unmatched.

    Columns: key, left columns, right columns, kind in
    {'match', 'pay_without_receipt', 'receipt_without_pay'}."""
    left_cols = [c for c in left.columns if c != key]
    right_cols = [c for c in right.columns if c != key]
    if not pair_duplicates:
        tol = interval(tolerance)
        # aliases keep the sides apart even when both come from one DataFrame
        l, r = left.alias("_lt"), right.alias("_rt")
        on = ((F.col(f"_lt.`{key}`") == F.col(f"_rt.`{key}`")) & (F.col(f"_rt.`{rts}`") >= F.col(f"_lt.`{lts}`") - tol)
              & (F.col(f"_rt.`{rts}`") <= F.col(f"_lt.`{lts}`") + tol))
        return _kind_rows(l, r, key, left_cols, right_cols, on, kind)
    out = _reconcile_chains(left, right, key, lts, rts, positive_micros(tolerance) if micros_of(tolerance) else 0)
    return out if kind is None else out.where(F.col("kind") == kind)


#: Tolerances in one time group of a key's rows.
GROUP = 64


def _frames(rows: DataFrame, tol_us: int, wide: int, *found: Column) -> DataFrame:
    """``rows`` (k, us, ...) with aggregates ``found`` over the rows of the key up to ``tol_us`` away, by time group ``g``
    with copies of what lies so near to a neighbouring group."""
    g = F.floor(F.col("us") / F.lit(wide))
    start = g * F.lit(wide)
    near = F.array(F.lit(0), F.when(F.col("us") - start <= tol_us, F.lit(-1)), F.when(start + F.lit(wide) - F.col("us") <= tol_us, F.lit(1)))
    dealt = rows.withColumn("_to", F.explode(F.filter(near, lambda x: x.isNotNull()))).withColumn("g", g + F.col("_to"))
    w = Window.partitionBy("k", "g").orderBy("us").rangeBetween(-tol_us, tol_us)
    names = [f"_f{i}" for i in range(len(found))]
    return dealt.select("*", *[c.over(w).alias(n) for c, n in zip(found, names)]).where("_to = 0").drop("_to")


def _reconcile_chains(left: DataFrame, right: DataFrame, key: str, lts: str, rts: str, tol_us: int) -> DataFrame:
    """Consuming match without folding a key as a whole.

    The left rows of a key are numbered in order, those without a right row within the tolerance aside, and the
    same for the right rows.  Taken in order, a right row matches the first left row that is neither taken nor too old,
    if that is within the tolerance.  What is passed on is one number, the first left row not yet passed: with ``f`` the first left
    row within the tolerance and ``h`` the one after the last, a right row turns ``i`` into
    ``x + 1`` if ``x = max(i, f) < h``, else into ``x``.  A time group's right rows are first folded for all numbers at once with which they
    can be entered, which are those near to the group's first row; then the numbers
    are passed from group to group, and each group is replayed from its own."""
    left_cols = [c for c in left.columns if c != key]
    right_cols = [c for c in right.columns if c != key]
    names = ([f"l{i}" for i in range(len(left_cols))], [f"r{i}" for i in range(len(right_cols))])
    every = names[0] + names[1]
    wide = GROUP * (tol_us or 1)

    def tagged(df, ts, own, side, other, other_names, own_names):
        return df.select(F.col(key).alias("k"), epoch_micros(df, ts).alias("us"), F.lit(side).alias("side"),
                         *[F.col(c).alias(n) for c, n in zip(own, own_names)],
                         *[F.lit(None).cast(other.schema[c].dataType).alias(n) for c, n in other_names])
    rows = tagged(left, lts, left_cols, 0, right, list(zip(right_cols, names[1])), names[0]).unionByName(
        tagged(right, rts, right_cols, 1, left, list(zip(left_cols, names[0])), names[1]))
    known = F.col("k").isNotNull() & F.col("us").isNotNull()
    of_side = lambda s: F.count(F.when(F.col("side") == s, 1))
    met = _frames(rows.where(known), tol_us, wide, of_side(0), of_side(1))
    both = F.when(F.col("side") == 0, F.col("_f1")).otherwise(F.col("_f0")) > 0
    in_group = F.row_number().over(Window.partitionBy("k", "side", "g", both).orderBy("us", *every)) - 1
    met = written(met.select("k", "us", "side", "g", *every, both.alias("both"), in_group.cast("long").alias("place")), "met")
    # numbers of a key's rows: those of the groups before, and the place in the group
    pairs = met.where("both")
    counts = pairs.groupBy("k", "side", "g").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("k", "side").orderBy("g").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("k", "side", "g", F.coalesce(before, F.lit(0)).alias("before"))
    numbered = written(pairs.join(counts, ["k", "side", "g"]).select("k", "us", "side", *every, (F.col("before") + F.col("place")).alias("i")), "numbered")
    number = F.when(F.col("side") == 0, F.col("i"))
    bounds = _frames(numbered.select("k", "us", "side", "i"), tol_us, wide, F.min(number), F.max(number)).where("side = 1")
    bounds = written(bounds.select("k", "g", F.col("i").alias("j"), F.col("_f0").alias("f"), (F.col("_f1") + 1).alias("h")), "bounds")
    matches = written(_matched(bounds), "matches")
    l = numbered.where("side = 0").join(matches.withColumnRenamed("x", "i"), ["k", "i"], "left").select("k", "j", *names[0]).alias("_lt")
    r = numbered.where("side = 1").select("k", F.col("i").alias("j"), *names[1]).alias("_rt")
    joined = l.withColumn("_l", F.lit(True)).alias("_lt").join(
        r.withColumn("_r", F.lit(True)).alias("_rt"), (F.col("_lt.k") == F.col("_rt.k")) & (F.col("_lt.j") == F.col("_rt.j")), "full_outer")
    kind = F.when(F.col("_l") & F.col("_r"), MATCH).when(F.col("_l"), PAY_ONLY).otherwise(RECEIPT_ONLY)
    folded = joined.select(F.coalesce("_lt.k", "_rt.k").alias("k"), *every, kind.alias("kind"))
    alone = met.where("NOT both").select("k", "side", *every).unionByName(rows.where(~known).select("k", "side", *every))
    out = folded.unionByName(alone.select("k", *every, F.when(F.col("side") == 0, PAY_ONLY).otherwise(RECEIPT_ONLY).alias("kind")))
    return out.select(F.col("k").alias(key), *[F.col(n).alias(c) for c, n in zip(left_cols, names[0])],
                      *[F.col(n).alias(c) for c, n in zip(right_cols, names[1])], "kind")


def _matched(bounds: DataFrame) -> DataFrame:
    """(k, j, x) of the right rows ``j`` and the left rows ``x`` that they match, from their ``bounds`` (k, g, j, f, h)."""
    kind = bounds.schema["k"].dataType.simpleString()
    of_group = bounds.repartition("k", "g").sortWithinPartitions("k", "g", "j")
    passed = of_group.mapInPandas(_each_group(_pass_all), f"k {kind}, g long, j long, f long, h long")
    # a few numbers of each group
    passed = passed.repartition("k").sortWithinPartitions("k", "g", "f").mapInPandas(_pass_on, f"k {kind}, g long, j long, f long, h long")
    replayed = bounds.unionByName(passed).repartition("k", "g").sortWithinPartitions("k", "g", "j")
    return replayed.mapInPandas(_each_group(_replay), f"k {kind}, g long, j long, f long, h long").select("k", "j", F.col("f").alias("x"))


def _each_group(fold):
    """``fold`` over the (j, f, h) of each (k, g), which gives rows of the same columns; the rows of a group are streamed."""
    def over(batches):
        import pandas as pd
        group, state = None, None

        for pdf in batches:
            out = []
            for k, g, j, f, h in zip(*(pdf[c].tolist() for c in "kgjfh")):
                if group != (k, g):
                    if group is not None:
                        out += [(*group, *x) for x in fold(state, None)]
                    group, state = (k, g), {}
                out += [(*group, *x) for x in fold(state, (j, f, h))]
            if out:
                yield pd.DataFrame(out, columns=list("kgjfh"))
        if group is not None and (last := list(fold(state, None))):
            yield pd.DataFrame([(*group, *x) for x in last], columns=list("kgjfh"))
    return over


def _pass_all(state: dict, row: tuple | None):
    """Into what the right rows of a group turn each number with which the group can be entered: (-1, number, result) at its end.

    Numbers that have become equal stay so.  Those below ``h`` all go up by one with each row, so they are kept less
    a common shift, in order, and those from ``h`` on as they are; both are runs of the entered numbers' parents."""
    if row is None:
        values = {}
        for v, p in state["low"]:
            values[p] = v + state["shift"]
        for v, p in state["high"]:
            values[p] = v
        first, out = state["first"], []
        # a number's parent is the first later one that has not been merged upwards
        for i in range(len(state["parent"]) - 1, -1, -1):
            p = state["parent"][i]
            if p != i:
                values[i] = values[p]
            out.append((-1, first + i, values[i]))
        return out
    _, f, h = row
    if not state:
        state.update(first=f, parent=list(range(h - f + 1)), shift=0, low=deque(), high=deque((f + i, i) for i in range(h - f + 1)))
    low, high, parent = state["low"], state["high"], state["parent"]
    while high and high[0][0] < h:
        v, p = high.popleft()
        low.append((v - state["shift"], p))
    # too old left rows are passed: all numbers below f become f
    last = None
    while low and low[0][0] + state["shift"] < f:
        if last is not None:
            parent[last] = low[0][1]
        last = low.popleft()[1]
    if last is not None:
        if low and low[0][0] + state["shift"] == f:
            parent[last] = low[0][1]
        else:
            low.appendleft((f - state["shift"], last))
    state["shift"] += 1
    if low and low[-1][0] + state["shift"] >= h:
        v, p = low.pop()
        if high and high[0][0] == h:
            parent[p] = high[0][1]
        else:
            high.appendleft((h, p))
    return ()


def _pass_on(batches):
    """Over the (number, result) of a key's groups in order: the number with which each group is entered, as (-1, number, null)."""
    import pandas as pd
    key, group, now, entered, last = None, None, 0, 0, 0
    for pdf in batches:
        out = []
        for k, g, i, result in zip(*(pdf[c].tolist() for c in "kgfh")):
            if k != key:
                key, group, now = k, None, 0
            if g != group:
                if group is not None:
                    now = last
                group = g
                # the first number stands for all smaller ones
                entered = max(now, i)
                out.append((k, g, -1, entered, 0))
            if i <= entered:
                last = result
        if out:
            yield pd.DataFrame(out, columns=list("kgjfh"))


def _replay(state: dict, row: tuple | None):
    """(j, x, 0) of the matches of a group, which begins with the number it is entered with."""
    if row is None:
        return
    j, f, h = row
    if j < 0:
        state["i"] = f
        return
    x = max(state["i"], f)
    if x < h:
        yield j, x, 0
        x += 1
    state["i"] = x
