"""Delimited text sources (S1) and row parsing with rejects.

A layout names the fields by position; numeric fields are parsed with
``try_cast`` so a bad line becomes a reject instead of killing the job
(the reference throws on the first bad line; ``on_error="fail"`` keeps
that behaviour lazily through ``raise_error``).  Event times become
TIMESTAMP_NTZ holding the UTC wall clock, computed arithmetically so the
result does not depend on the session time zone.  ``seq`` is the tie-break
of equal times: the input order with ``in_order``, else that of each split.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.times import EPOCH_NTZ, epoch_micros
from .numbering import numbered, positioned


@dataclass(frozen=True)
class Layout:
    sep: str
    # (output name, position, kind); kind in long, int, string, epoch_s, epoch_ms, clf_time
    fields: tuple = field(default_factory=tuple)


# Fixed record layouts of the reference's input files (positions as read there).
LAYOUTS = {
    "behaviour": Layout(",", (("user_id", 0, "long"), ("item_id", 1, "long"), ("category_id", 2, "int"),
                              ("behavior", 3, "string"), ("ts", 4, "epoch_s"))),
    "login": Layout(",", (("user_id", 0, "long"), ("ip", 1, "string"), ("event_type", 2, "string"),
                          ("ts", 3, "epoch_s"))),
    "ad": Layout(",", (("user_id", 0, "long"), ("ad_id", 1, "long"), ("province", 2, "string"),
                       ("city", 3, "string"), ("ts", 4, "epoch_s"))),
    "order": Layout(",", (("order_id", 0, "long"), ("event_type", 1, "string"), ("ts", 3, "epoch_s"))),
    "order_tx": Layout(",", (("order_id", 0, "long"), ("event_type", 1, "string"), ("tx_id", 2, "string"),
                             ("ts", 3, "epoch_s"))),
    "receipt": Layout(",", (("tx_id", 0, "string"), ("pay_channel", 1, "string"), ("ts", 2, "epoch_s"))),
    "access_log": Layout(" ", (("ip", 0, "string"), ("user_id", 1, "string"), ("ts", 3, "clf_time"),
                               ("method", 5, "string"), ("url", 6, "string"))),
    "marketing": Layout(",", (("user_id", 0, "string"), ("behavior", 1, "string"), ("channel", 2, "string"),
                              ("ts", 3, "epoch_ms"))),
}

_CLF = r"^(\d{2})/(\d{2})/(\d{4}):(\d{2}):(\d{2}):(\d{2})$"  # dd/MM/yyyy:HH:mm:ss


def _parse(kind: str, raw: Column) -> Column:
    if kind == "string":
        return raw
    if kind in ("long", "int"):
        return raw.try_cast(kind)
    if kind == "epoch_s":
        return _epoch(raw, "SECOND")
    if kind == "epoch_ms":
        return _epoch(raw, "MILLISECOND")
    if kind == "clf_time":
        parts = [F.regexp_extract(raw, _CLF, i).try_cast("int") for i in range(1, 7)]
        d, mo, y, h, mi, s = parts
        return F.try_make_timestamp_ntz(y, mo, d, h, mi, s)
    raise ValueError(kind)


#: Largest distance from the epoch that a timestamp holds, in seconds.
MAX_EPOCH_S = 200_000_000_000


def _epoch(raw: Column, unit: str) -> Column:
    n = raw.try_cast("long")
    most = MAX_EPOCH_S * (1000 if unit == "MILLISECOND" else 1)
    # out of range is a bad line, not an overflow; null in, null out
    return F.timestamp_add(unit, F.when(n.between(-most, most), n), F.expr(EPOCH_NTZ))


def format_line(df: DataFrame, layout: str | Layout) -> Column:
    """The text line of a layout's typed row; positions it does not name are empty."""
    lay = LAYOUTS[layout] if isinstance(layout, str) else layout
    out = [F.lit("")] * (max(p for _, p, _ in lay.fields) + 1)
    for name, pos, kind in lay.fields:
        if kind == "epoch_s":
            c = F.floor(epoch_micros(df, name) / 1_000_000).cast("long").cast("string")
        elif kind == "epoch_ms":
            c = F.floor(epoch_micros(df, name) / 1000).cast("long").cast("string")
        elif kind == "clf_time":
            c = F.date_format(name, "dd/MM/yyyy:HH:mm:ss")
        else:
            c = F.col(name).cast("string")
        out[pos] = F.coalesce(c, F.lit(""))
    return F.concat_ws(lay.sep, *out)


def parsed_fields(value: Column, layout: str | Layout) -> tuple[list[Column], Column]:
    """The typed fields of a text line, and whether it is a good line."""
    lay = LAYOUTS[layout] if isinstance(layout, str) else layout
    parts = F.split(value, F.lit(lay.sep))
    need = max(p for _, p, _ in lay.fields) + 1
    cols, ok = [], F.size(parts) >= need
    for name, pos, kind in lay.fields:
        raw = F.trim(F.get(parts, pos))
        c = _parse(kind, raw)
        cols.append(c.alias(name))
        ok = ok & c.isNotNull() if kind != "string" else ok & raw.isNotNull()
    return cols, F.coalesce(ok, F.lit(False))


def parse_lines(lines: DataFrame, layout: str | Layout, value: str = "value", seq: str | None = None) -> DataFrame:
    """Text rows -> typed columns + ``_ok`` flag + ``seq``.

    ``seq`` is the column of that name, such as the line numbers of
    ``numbering.numbered``.  Without one it follows the line order within each
    input split of a batch read; across files and splits it follows the order in
    which Spark numbers them, which is not an input order.  On a stream it is then
    a hash of the line: a deterministic tie-break between rows with equal times,
    in no particular order."""
    cols, ok = parsed_fields(F.col(value), layout)
    own = F.xxhash64(F.col(value)) if lines.isStreaming else F.monotonically_increasing_id()
    return lines.select(*cols, (F.col(seq) if seq else own).alias("seq"), ok.alias("_ok"), F.col(value).alias("_line"))


def read_lines(spark: SparkSession, path: str, layout: str | Layout, on_error: str = "fail",
               streaming: bool = False, in_order: bool = False):
    """Read delimited text lines as typed rows.

    on_error="fail": a bad line raises when the row is evaluated.
    on_error="reject": returns (rows, rejects); rejects has the raw line.
    streaming=True reads the folder as a file stream (one micro-batch per
    new file; use trigger(availableNow=True) for a replay; ``streaming.lines.run_lines``
    keeps rows and rejects of a stream in one pass).
    in_order=True numbers the lines of a batch read over all files and splits
    (``seq`` from 0, files by path), which reads the text twice and starts a job."""
    if in_order and streaming:
        raise ValueError("in_order is for batch reads; run_lines numbers the lines of a stream")
    reader = spark.readStream if streaming else spark.read
    lines = numbered(positioned(reader.text(path))) if in_order else reader.text(path)
    parsed = parse_lines(lines, layout, seq="line_no" if in_order else None)
    names = [n for n, _, _ in (LAYOUTS[layout] if isinstance(layout, str) else layout).fields]
    if on_error == "fail":
        guard = F.coalesce(F.when(~F.col("_ok"), F.raise_error(F.concat(F.lit("bad input line: "),
                                                                         F.col("_line")))), F.lit(True))
        return parsed.where(guard).select(*names, "seq")
    if on_error == "reject":
        return (parsed.where("_ok").select(*names, "seq"),
                parsed.where(~F.col("_ok")).select(F.col("_line").alias("line"), "seq"))
    raise ValueError(on_error)
