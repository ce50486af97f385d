"""The corpus pipeline: quality, exact copies, near copies, benchmark
passages, packing.

Each stage takes (spark, docs, sf_dir), where ``docs`` has the columns of
``documents``, works on all rows its predecessor kept and returns the rows it
keeps; the last returns the packed sequences' pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from behavio.llm import decontam, exact_dedup, jaccard_join, packing, quality
from behavio.llm.catalogue import tokenizer_path, trusted_positives
from behavio.llm.common import keyed, table, written
from behavio.llm.shared_runs import BROADCAST_KEYS, ordered_id, small


def _with_rows(docs: DataFrame, found: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``docs`` (with ``row``) whose id (null being one too) and row are in the written table ``found``."""
    named = found.select(F.col("doc_id").alias("kept_id"), F.col("row").alias("kept_row"))
    return docs.join(small(named, BROADCAST_KEYS // 2), F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("row") == F.col("kept_row")), how)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.5 and above)."""
    scored = written(quality.score(docs, trusted_positives(spark, sf_dir), rows=True), "scores")
    return _with_rows(keyed(docs), scored.where("score >= 0.5").select("doc_id", "row").distinct()).drop("row")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the smallest id, once."""
    equal = written(exact_dedup.exact_groups(docs, rows=True).where("kept").select("doc_id", "row", "text_sha256"), "equal")
    # rows of one id may be equal but for their white space
    kept = written(equal.groupBy("doc_id", "text_sha256").agg(F.min("row").alias("row")).select("doc_id", "row"), "kept")
    repeated = written(equal.groupBy("doc_id", "row").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                       .join(kept.withColumnsRenamed({"doc_id": "kept_id", "row": "kept_row"}),
                             F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("row") == F.col("kept_row")), "left_semi"), "repeated")
    docs = keyed(docs)
    once = _with_rows(_with_rows(docs, kept), repeated, "left_anti")
    return once.unionByName(_with_rows(docs, repeated).dropDuplicates(["doc_id", "row"])).drop("row")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id."""
    groups = jaccard_join.similar_groups(docs, rows=True)
    first = written(groups.where("first").select("node").distinct(), "first")
    named = keyed(docs).withColumn("ordered", ordered_id("doc_id")).withColumn("node", jaccard_join.node_of("ordered", "row"))
    return named.join(small(first), "node", "left_semi").select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontam.contamination(docs, table(spark, sf_dir, "benchmark"), rows=True)
    return _with_rows(keyed(docs), written(found.where("n_hit > 0").select("doc_id", "row").distinct(), "hit"), "left_anti").drop("row")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 ids."""
    # the executors still hold the memory of the stages before
    return packing.pack(docs, tokenizer_path(), cache_words=1 << 18).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", keep_good),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: A trained classifier and a tokenizer are not SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
