"""Benchmark decontamination by winnowing, in DataFrame functions only.

Of each window of ``window`` words the smallest hash of its k-grams is the
window's fingerprint.  A window of a document that equals a window of a
benchmark item has the same fingerprint, so every shared span of ``window``
words or more is found; the fingerprints of documents and items are joined,
and each hit is extended to its whole window, which must equal the item's
window word by word.  Items shorter than the window are one window of their
own length, winnowed alike at that length.

The fingerprints of documents are made, exploded and looked up in one stage;
only hits go on.  The benchmark's distinct windows are counted first and
broadcast if at most ``BROADCAST_WINDOWS``; beyond that the same joins
shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed, let, written

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A window is some 100 bytes here: 30 MB on each executor.
BROADCAST_WINDOWS = 300_000


def words_of(text: Column) -> Column:
    """The words, A-Z in lower case; none for null."""
    ascii_only = F.length(text) == F.octet_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.regexp_extract_all(low, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def gram_size(window: int) -> int:
    return (window + 1) // 2


def fingerprints(words: Column, window: int) -> Column:
    """For each start of a window, the smallest hash of its k-grams."""
    k = gram_size(window)
    w = window - k + 1

    def minima(grams: Column) -> Column:
        if w == 1:
            return grams
        return F.transform(F.sequence(F.lit(0), F.size(grams) - w), lambda i: F.least(*[grams[i + j] for j in range(w)]))

    def hashes(h: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.xxhash64(*[h[i + j] for j in range(k)]))
        return let(grams, minima)
    return (F.when(F.size(words) >= window, let(F.transform(words, lambda x: F.xxhash64(x)), hashes))
            .otherwise(F.array().cast("array<bigint>")))


def window_text(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start + 1, length), " ")


def item_windows(items: DataFrame, window: int) -> DataFrame:
    """(length, fp, gram, item_id): the distinct windows of each item."""
    cut = items.withColumn("length", F.least(F.size("words"), F.lit(window))).where("length > 0")
    by_length = [cut.where(F.col("length") == n).select("item_id", "words", "length", F.posexplode(
        fingerprints(F.col("words"), n)).alias("start", "fp")) for n in range(1, window + 1)]
    return (reduce(DataFrame.unionByName, by_length)
            .select("length", "fp", window_text(F.col("words"), F.col("start"), F.col("length")).alias("gram"), "item_id")
            .distinct())


def window_hits(docs: DataFrame, windows: DataFrame, lengths: list[int], small: bool) -> DataFrame:
    """(doc_id, row, start, length, gram) of document windows that an item has."""
    side = (lambda d: F.broadcast(d)) if small else (lambda d: d)
    found = []
    for n in lengths:
        of = windows.where(F.col("length") == n)
        near = (docs.select("doc_id", "row", "words", F.posexplode(fingerprints(F.col("words"), n)).alias("start", "fp"))
                .join(side(of.select("fp").distinct()), "fp", "left_semi")
                .select("doc_id", "row", "start", F.lit(n).alias("length"),
                        window_text(F.col("words"), F.col("start"), F.lit(n)).alias("gram")))
        found.append(near.join(side(of.select("gram").distinct()), "gram", "left_semi"))
    return reduce(DataFrame.unionByName, found)


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", rows: bool = False) -> DataFrame:
    """One row per document row: ``doc_id``, ``n_words``, ``n_hit`` (words
    inside an occurrence of an item's window), ``item_ids`` (sorted as
    strings) and ``spans`` (the hit windows as (start, length), sorted).

    A null text has no words; it and a document without hits have 0 and empty
    arrays.  Items of no words (or null) have no window; items with equal
    windows all count; a repeated item counts once, and a null item id once as
    an empty string.  Rows that share a document id, or have none, have the hits of
    their own text.  Empty tables: no hits, or no rows.  Other columns are not read.
    With ``rows``, the column ``row`` of ``keyed`` goes with ``doc_id``.
    """
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item_id"),
                             words_of(F.col(item_text_col).cast("string")).alias("words"))
    windows = written(item_windows(items, window), "windows")
    counted = windows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `window` rows
    read = keyed(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")))
    base = read.select("doc_id", "row", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    none = [F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("item_ids"),
            F.array().cast("array<struct<start:int,length:int>>").alias("spans")]
    if not counted:
        return base.select("doc_id", *(["row"] if rows else []), "n_words", *none)
    small = sum(r["n"] for r in counted) <= BROADCAST_WINDOWS
    hits = window_hits(read.select("doc_id", "row", words_of(F.col("text")).alias("words")), windows,
                       [r["length"] for r in counted], small)
    # one checkpointed table of hits serves the spans and the items
    hits = written(hits, "hits")
    covered = lambda s: F.size(F.array_distinct(F.flatten(F.transform(
        s, lambda x: F.sequence(x["start"], x["start"] + x["length"] - 1))))).cast("long")
    spans = hits.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans"))
    of_items = (hits.select("doc_id", "row", "gram").distinct()
                .join(windows.select("gram", "item_id"), "gram").select("doc_id", "row", "item_id").distinct()
                .groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids")))
    per_doc = (spans.alias("a").join(of_items.alias("b"), F.expr("a.doc_id <=> b.doc_id AND a.row = b.row"))
               .select("a.doc_id", "a.row", covered(F.col("spans")).alias("n_hit"), "item_ids", "spans"))
    return (base.alias("d").join(per_doc.alias("h"), F.expr("d.doc_id <=> h.doc_id AND d.row = h.row"), "left")
            .select("d.doc_id", *(["d.row"] if rows else []), "n_words", *[F.coalesce(F.col(f"h.{c}"), v).alias(c)
                                             for c, v in zip(("n_hit", "item_ids", "spans"), none)]))
