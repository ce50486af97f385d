"""Exact deduplication by content-defined chunk recipes, in DataFrame
functions only.

A text is cut after every token whose hash is 0 modulo ``CHUNK_TOKENS`` (and
after ``MAX_TOKENS`` tokens at the latest), so where a cut lies depends on the
words near it alone.  A chunk's identifier is its MD5; it is *verified* by
comparing the bytes of all chunks that carry it, for which every distinct chunk
moves once.  A document is then the ordered list of its chunk identifiers,
some 16 bytes for 250 of text; equal lists of verified identifiers are equal
texts, and only those lists are grouped and joined.  A document that holds an
identifier under which two different chunks were found (a forged MD5
collision) is compared by its text as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed, let, written

CHUNK_TOKENS = 32
MAX_TOKENS = 256
#: A token is at most 256 characters of a word and the blank after it.
TOKEN = "[^ ]{1,256} ?| "
WHITE = r"[ \t-\r]+"


def normalised(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one blank."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def chunks(text: Column, every: int = CHUNK_TOKENS, most: int = MAX_TOKENS) -> Column:
    """The text's chunks in order; joined they are the text."""
    def cut(tokens: Column) -> Column:
        n = F.size(tokens)
        after = F.filter(F.transform(tokens, lambda t, i: F.when(F.pmod(F.xxhash64(t), F.lit(every)) == 0, i + 1)
                                     .otherwise(0)), lambda e: e > 0)
        bounds = F.array_distinct(F.concat(F.array(F.lit(0)), after, F.array(n)))

        def pieces(b: Column) -> Column:
            starts = F.flatten(F.transform(F.slice(b, F.lit(1), F.size(b) - 1),
                                           lambda s, i: F.sequence(s, b[i + 1] - 1, F.lit(most))))
            ends = lambda s: F.concat(F.slice(s, F.lit(2), F.size(s)), F.array(n))
            return let(starts, lambda s: F.transform(
                F.arrays_zip(s.alias("a"), ends(s).alias("b")),
                lambda p: F.array_join(F.slice(tokens, p["a"] + 1, p["b"] - p["a"]), "")))
        return F.when(n > 0, let(bounds, pieces)).otherwise(F.array().cast("array<string>"))
    return let(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0)), cut)


def identifier(chunk: Column) -> Column:
    return F.unhex(F.md5(chunk.cast("binary")))


def exact_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rows: bool = False) -> DataFrame:
    """One row per input row: ``doc_id``, ``keep_id`` (smallest id among the
    rows of equal text), ``group_size``, ``kept`` and ``text_sha256`` of the
    normalised text.

    Null and empty texts are equal to each other; a text of white space only is
    one blank.  Repeated rows count in ``group_size`` and share their flag.  A
    null id is larger than any other.  An empty table gives an empty result.
    Other columns are not read.  With ``rows``, the column ``row`` of ``keyed`` goes with ``doc_id``.
    """
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    names = ["doc_id"]
    if rows:
        read, names = keyed(read), ["doc_id", "row"]
    read = read.withColumn("text", normalised(F.col("text")))
    recipes = written(read.select(
        *names, F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
        F.transform(chunks(F.col("text")), identifier).alias("recipe")), "recipes")
    stored = (read.select(F.explode(chunks(F.col("text"))).alias("chunk"))
              .groupBy(identifier(F.col("chunk")).alias("id"), "chunk").agg(F.count(F.lit(1)).alias("n")))
    forged = stored.groupBy("id").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("id")
    suspects = (recipes.select("text_sha256", F.explode(F.array_distinct("recipe")).alias("id"))
                .join(forged, "id", "left_semi").groupBy("text_sha256").agg(F.lit(True).alias("by_text")))
    named = (recipes.join(suspects, "text_sha256", "left")
             # a recipe with a forged identifier is told apart by the digest of the whole text
             .select(*names, "text_sha256", "recipe",
                     F.when(F.col("by_text"), F.col("text_sha256")).otherwise(F.lit("")).alias("apart")))
    groups = named.groupBy("recipe", "apart").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return (named.join(groups, ["recipe", "apart"])
            .select(*names, "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    "text_sha256"))
