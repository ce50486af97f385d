"""Windows of texts that recur, found without comparing all windows.

A window is ``width`` consecutive units (bytes or words).  Its *anchor* is the
leftmost k-gram of smallest hash in it with the ``(width - k) // 2`` units before it, or, where the
window begins later than these, with as many after it.  The window's content alone tells
which, so equal windows have equal anchors at equal places.  A k-gram recurs by chance
the oftener the larger the corpus is; with its neighbours it mostly recurs where windows do.
Consecutive windows with the same anchor are a *run*; runs of one text are
at most some ``4 / (width - k + 2)`` per unit.  Only the runs' hashes are shuffled:

1. anchors alone are counted (with map-side combination); those of a single
   run are done with, and only the other anchors' runs are written;
2. runs of equal content are one class; each but its first has all of its windows
   earlier in the corpus;
3. where an anchor has several classes, the text of the first run of each is
   fetched, and an exact string method decides which of its windows
   occur in an earlier one.  An anchor of more than ``HOT_CLASSES`` classes is
   split into its windows, whose first ones are found by their digests (128 bits) with
   map-side minima, so equal windows never gather in a task.

Before a join shuffles the runs or the texts, those without a partner are
taken out by a broadcast of the partner's keys alone, if these are counted to be at most
``BROADCAST_KEYS`` longs; whole rows are broadcast up to ``BROADCAST_ROWS`` only.
Beyond these counts the same joins shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .vectors import BASE, batches, mixed, powers, sliding_min

BROADCAST_KEYS = 4_000_000
BROADCAST_ROWS = 1_000_000
#: Runs that one anchor may have in one shard: some 4 MB of passages, and seconds of work.
HOT_CLASSES = 20_000
SECOND = 0xC2B2AE3D27D4EB4F
#: Units of a batch must stay below 2**PLACE_BITS: their place is the low part of the ordering key.
PLACE_BITS = 32
LAST_ID = (1 << 63) - 1


def prefix(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * powers(base, n)[:n], out=total[1:])
    return total, powers(pow(base, -1, 1 << 64), n)


def runs_of(values: np.ndarray, edges: np.ndarray, width: int, k: int) -> tuple[np.ndarray, ...]:
    """(document, first window, number of windows, anchor hash, content hash) of
    the runs of a batch; ``values`` are hashes of the units, ``edges`` where
    each document starts (and the end)."""
    n, beside = len(values), (width - k) // 2
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    if n < width:
        return none
    total, inverse = prefix(values, BASE)
    grams = mixed((total[k:] - total[:-k]) * inverse[:n - k + 1])
    place = np.uint64((1 << PLACE_BITS) - 1)
    least = sliding_min((grams & ~place) | np.arange(len(grams), dtype=np.uint64), width - k + 1)
    anchor = (least & place).astype(np.int64)
    inside = np.zeros(n + 1, np.int32)  # windows that lie in one document
    first, last = edges[:-1], np.maximum(edges[1:] - width + 1, edges[:-1])
    np.add.at(inside, first, 1)
    np.add.at(inside, last, -1)
    inside = np.cumsum(inside)[:len(anchor)] > 0
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | ~inside[:-1])) & inside
    # two documents never share an anchor, as no window crosses their edge
    start = np.flatnonzero(new)
    if not len(start):
        return none
    stop = np.concatenate((start[1:], [len(anchor)]))
    ends = np.flatnonzero(~np.concatenate((inside[1:], [False])) & inside) + 1
    stop = np.minimum(stop, ends[np.searchsorted(ends, start, "right")])
    at = anchor[start]
    turn = np.clip(at - beside + 1, start, stop)  # later windows lack some of the units before the k-gram
    early, late = np.flatnonzero(turn > start), np.flatnonzero(turn < stop)
    least = np.concatenate((at[early] - beside, at[late]))
    fp = mixed((total[least + k + beside] - total[least]) * inverse[least]) ^ np.repeat(np.array([0, SECOND], np.uint64), (len(early), len(late)))
    start, stop = np.concatenate((start[early], turn[late])), np.concatenate((turn[early], stop[late]))
    total, inverse = prefix(values, SECOND)
    content = mixed((total[stop + width - 1] - total[start]) * inverse[start])
    doc = np.searchsorted(edges, start, "right") - 1
    return doc, start - edges[doc], stop - start, fp, content


def run_table(docs: DataFrame, cut: Callable, width: int, k: int) -> DataFrame:
    """(fp, ht, doc_id, row, pos, n) of all runs of ``docs`` (doc_id long, row long, text);
    ``cut(texts)`` gives unit hashes and document edges."""
    def run(frames: Iterator) -> Iterator:
        import pyarrow as pa
        for got in batches(frames, ["doc_id", "row", "text"]):
            doc, pos, n, fp, ht = runs_of(*cut(got["text"]), width, k)
            yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(ht.view(np.int64)),
                                              pa.array(np.array(got["doc_id"], np.int64)[doc]),
                                              pa.array(np.array(got["row"], np.int64)[doc]), pa.array(pos), pa.array(n)],
                                             ["fp", "ht", "doc_id", "row", "pos", "n"])
    return docs.mapInArrow(run, "fp long, ht long, doc_id long, row long, pos long, n long")


def small(df: DataFrame, most: int = BROADCAST_KEYS) -> DataFrame:
    """``df`` (a written table of one long) with a broadcast hint if it has at most ``most`` rows."""
    return F.broadcast(df) if df.count() <= most else df


def partners(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` with a partner in the written table ``other``, where its keys are
    few enough to broadcast; else ``df`` as it is, for a join that shuffles."""
    if other.count() > BROADCAST_KEYS:
        return df
    return df.join(F.broadcast(other.select(key)), key, "left_semi")


def recurring(docs: DataFrame, cut: Callable, pieces: Callable, decide: Callable, *, width: int, k: int,
              same_document: bool) -> DataFrame:
    """Per row of ``docs`` (doc_id, row, text; see ``keyed``) with recurring windows: ``doc_id``, ``row`` and ``spans``, the
    maximal (start, end) in units that earlier windows cover, in order.

    Earlier is a smaller doc_id or, if ``same_document``, the same one and a
    smaller start.  ``pieces(text, [(pos, n)])`` gives the bytes of runs;
    ``decide(frames)`` maps shards of (key, text, doc_id, row, pos, n, run), whole keys
    together in ascending order of key, to (doc_id, row, start, n, run) of recurring windows;
    ``run`` is where the run starts that a row belongs to.
    """
    order = F.struct("doc_id", "pos") if same_document else F.col("doc_id")
    found = run_table(docs, cut, width, k)
    # nothing but the anchors (and whose they are) is shuffled of the runs that do not recur
    seen = found.groupBy("fp")
    seen = (seen.agg(F.count(F.lit(1)).alias("n")).where("n > 1") if same_document else
            seen.agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first <> last"))
    anchors = written(seen.select("fp"), "anchors")
    shared = written(found.join(small(anchors), "fp", "left_semi"), "runs")
    classes = written(shared.groupBy("fp", "ht").agg(F.min(F.struct("doc_id", "pos", "n", "row")).alias("run"),
                                                     # the last of the runs that are first alike
                                                     F.min(F.struct("doc_id", *(["pos"] if same_document else []), F.bitwise_not("pos").alias("to_pos"),
                                                                    F.bitwise_not("row").alias("to_row"))).alias("last"))
                      .withColumn("first", F.struct("run.doc_id", "run.pos") if same_document else F.col("run.doc_id")), "classes")
    again = shared.join(classes.select("fp", "ht", "first"), ["fp", "ht"]).where(order > F.col("first")).select("doc_id", "row", "pos", "n")
    several = written(classes.groupBy("fp").agg(F.count(F.lit(1)).alias("many")).where("many > 1"), "several-classes")
    hot = written(several.where(F.col("many") > HOT_CLASSES).select("fp", F.lit(True).alias("hot")), "hot")
    # where an anchor has one class, that class's first run settles all
    classes = classes.join(small(several.select("fp")), "fp", "left_semi")
    wanted = written(classes.join(hot, "fp", "left").groupBy(F.col("run.doc_id").alias("doc_id"), F.col("run.row").alias("row"))
                     .agg(F.collect_list(F.struct("fp", "run.pos", "run.n", F.coalesce("hot", F.lit(False)).alias("hot"))).alias("runs")),
                     "wanted")
    sources = partners(docs, wanted, "doc_id").join(wanted, ["doc_id", "row"])
    texts = sources.mapInArrow(
        _fetch(pieces, width), "key long, text binary, doc_id long, row long, pos long, n long, run long")
    windows = (texts.repartition("key").sortWithinPartitions("key", "doc_id", "pos")
               .mapInArrow(decide, "doc_id long, row long, pos long, n long, run long"))
    if hot.count():
        held = wanted.where(F.exists("runs", lambda r: r["hot"]))  # only the texts of hot anchors are shuffled once more
        windows = windows.unionByName(_hot_repeats(partners(docs, held, "doc_id").join(held, ["doc_id", "row"]), pieces, width, order))
    windows = _in_all_runs(windows, shared, classes, order).select("doc_id", "row", "pos", "n")
    spans = again.unionByName(windows).select(
        "doc_id", "row", F.struct(F.col("pos").alias("start"), (F.col("pos") + F.col("n") + (width - 1)).alias("end")).alias("span"))
    merged = spans.groupBy("doc_id", "row").agg(F.collect_set("span").alias("spans")).mapInArrow(
        _merge, "doc_id long, row long, spans array<struct<start:long,end:long>>")
    return written(merged, "spans")


def _in_all_runs(windows: DataFrame, shared: DataFrame, classes: DataFrame, order: Column) -> DataFrame:
    """``windows``, decided for one first run of each class, and the same windows of the
    class's other runs that no run is earlier than: those in the same document where that is
    the order, and those of other rows of the same id."""
    several = written(classes.where((F.bitwise_not("last.to_pos") != F.col("run.pos")) | (F.bitwise_not("last.to_row") != F.col("run.row")))
                      .select("fp", "ht", "first", F.col("run.row").alias("of_row"), F.col("run.pos").alias("run")), "several")
    n = several.count()
    if not n:
        return windows
    windows = written(windows, "windows")
    several = F.broadcast(several) if n <= BROADCAST_ROWS else several
    others = written(shared.join(several, ["fp", "ht"]).where(order == F.col("first"))
                     .where((F.col("pos") != F.col("run")) | (F.col("row") != F.col("of_row")))
                     .select("doc_id", "of_row", "run", F.col("row").alias("to_row"), (F.col("pos") - F.col("run")).alias("by")).distinct(), "others")
    others = F.broadcast(others) if others.count() <= BROADCAST_ROWS else others
    return windows.unionByName(windows.withColumnRenamed("row", "of_row").join(others, ["doc_id", "of_row", "run"])
                               .select("doc_id", F.col("to_row").alias("row"), (F.col("pos") + F.col("by")).alias("pos"), "n", "run"))


def span_type():
    import pyarrow as pa
    return pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _merge(frames):
    import pyarrow as pa
    for frame in frames:
        merged = [[{"start": a, "end": b} for a, b in covered(s)] for s in frame["spans"].to_pylist()]
        yield pa.RecordBatch.from_arrays([frame["doc_id"], frame["row"], pa.array(merged, span_type())], ["doc_id", "row", "spans"])


def _fetch(pieces: Callable, width: int) -> Callable:
    def run(frames):
        import pyarrow as pa
        for got in batches(frames, ["doc_id", "row", "text", "runs"]):
            keys, texts, docs, rows, places, sizes, starts = [], [], [], [], [], [], []
            for doc, row, text, wanted in zip(got["doc_id"], got["row"], got["text"], got["runs"]):
                where = [(r["pos"], r["n"], r["fp"]) for r in wanted if not r["hot"]]
                for (p, n, fp), piece in zip(where, pieces(text, [(p, n + width - 1) for p, n, _ in where])):
                    keys.append(fp)
                    texts.append(piece)
                    docs.append(doc)
                    rows.append(row)
                    places.append(p)
                    sizes.append(n)
                    starts.append(p)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.binary()), pa.array(docs, pa.int64()), pa.array(rows, pa.int64()),
                                              pa.array(places, pa.int64()), pa.array(sizes, pa.int64()), pa.array(starts, pa.int64())],
                                             ["key", "text", "doc_id", "row", "pos", "n", "run"])
    return run


def _hot_repeats(sources: DataFrame, pieces: Callable, width: int, order: Column) -> DataFrame:
    """(doc_id, row, pos, n, run) of the windows of hot anchors that an earlier one equals."""
    def run(frames):
        import pyarrow as pa
        from hashlib import blake2b
        names = ["one", "two", "doc_id", "row", "pos", "run"]
        for got in batches(frames, ["doc_id", "row", "text", "runs"]):
            for doc, row, text, wanted in zip(got["doc_id"], got["row"], got["text"], got["runs"]):
                alone = [(p, r["pos"]) for r in wanted if r["hot"] for p in range(r["pos"], r["pos"] + r["n"])]
                digests = np.frombuffer(b"".join(blake2b(x, digest_size=16).digest() for x in pieces(text, [(p, width) for p, _ in alone])), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(digests[::2]), pa.array(digests[1::2])] + [
                    pa.array(c, pa.int64()) for c in ([doc] * len(alone), [row] * len(alone), [p for p, _ in alone], [s for _, s in alone])], names)
    found = written(sources.mapInArrow(run, "one long, two long, doc_id long, row long, pos long, run long"), "hot-windows")
    first = written(found.groupBy("one", "two").agg(F.min(order).alias("first"), F.max(order).alias("last"))
                    .where(F.col("first") != F.col("last")).drop("last"), "hot-firsts")
    first = F.broadcast(first) if first.count() <= BROADCAST_ROWS else first
    return found.join(first, ["one", "two"]).where(order > F.col("first")).select("doc_id", "row", "pos", F.lit(1).cast("long").alias("n"), "run")


def shards(frames, size: int) -> Iterator[tuple[list, ...]]:
    """Columns of runs with whole keys together, cut when a shard has ``size`` bytes."""
    held: list[list] = [[], [], [], [], [], [], []]
    n = 0
    for frame in frames:
        columns = [frame[c].to_pylist() for c in ("key", "text", "doc_id", "row", "pos", "n", "run")]
        for row in zip(*columns):
            if n >= size and held[0][-1] != row[0]:
                yield tuple(held)
                held, n = [[], [], [], [], [], [], []], 0
            for column, value in zip(held, row):
                column.append(value)
            n += len(row[1])
    if held[0]:
        yield tuple(held)


def covered(spans: list, n: int = LAST_ID) -> list[tuple[int, int]]:
    """Maximal runs of units below ``n`` that the spans cover."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], min(s["end"], n)) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        elif a < b:
            out.append((a, b))
    return out


def with_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with their spans, null without any."""
    size = spans.agg(F.sum(F.size("spans") + 1)).first()[0] or 0
    return docs.join(F.broadcast(spans) if size <= BROADCAST_ROWS else spans, ["doc_id", "row"], "left")


def ordered_id(column: str) -> Column:
    """A null id comes after all others."""
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))
