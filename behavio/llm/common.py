"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from behavio.session import checkpoint_dir, scratch_path

#: Ids of several rows, up to which they are broadcast.
SHARED_IDS = 1_000_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often a
    lambda inside ``body`` refers to it."""
    return F.transform(F.array(value), body)[0]


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet below the shared checkpoint
    folder of the session and read it again."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with ``row``, which tells rows apart that share an id (null
    being one too) but not their text: a hash of the text, and 0 where the id is of one row only."""
    shared = written(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("shared_id")), "shared-ids")
    shared = F.broadcast(shared) if shared.count() <= SHARED_IDS else shared
    return (docs.join(shared.withColumn("is_shared", F.lit(True)), F.col("doc_id").eqNullSafe(F.col("shared_id")), "left")
            .withColumn("row", F.when(F.col("is_shared"), F.xxhash64(F.coalesce("text", F.lit("")))).otherwise(F.lit(0))).drop("shared_id", "is_shared"))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fold_mod(column: str, parts: int) -> Column:
    """crc32 of an id's decimal text modulo ``parts``: the fold of a row.
    A null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts, F.lit(0)).cast("int")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
