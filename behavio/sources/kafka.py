"""Kafka source and sink (S2, S3) as option sets of Spark's own Kafka
connector.  The connector jar (spark-sql-kafka) must be on the cluster's
classpath; it is not bundled here, so these are untested locally."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .lines import Layout, format_line


def read_kafka(spark: SparkSession, servers: str, topic: str = "UserBehavior",
               starting: str | None = None, streaming: bool = True, **options) -> DataFrame:
    """Topic values as text lines in column ``value`` (feed to parse_lines).
    ``starting`` defaults to ``latest`` for a stream and to ``earliest`` for
    a batch read, which Spark refuses to start at the latest offsets."""
    starting = starting or ("latest" if streaming else "earliest")
    reader = spark.readStream if streaming else spark.read
    r = (reader.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"),
                           F.col("timestamp").alias("kafka_ts"))


def kafka_records(df: DataFrame, layout: str | Layout | None = None) -> DataFrame:
    """One record per row as ``value``, with no key.  A frame of the single
    string column ``value`` holds lines, which pass unchanged (as the reference
    producer sends them); typed rows of a ``layout`` are written back in its
    field order, times as epochs; other frames become CSV text of all columns."""
    if layout is not None:
        return df.select(format_line(df, layout).alias("value"))
    if df.dtypes == [("value", "string")]:
        return df
    return df.select(F.to_csv(F.struct(*df.columns)).alias("value"))


def write_kafka(df: DataFrame, servers: str, topic: str = "UserBehavior", checkpoint: str | None = None,
                layout: str | Layout | None = None):
    """Write ``kafka_records(df, layout)`` to a topic.  Batch DataFrames are
    written directly; streaming ones return the started query
    (``checkpoint`` required: a shared folder)."""
    out = kafka_records(df, layout)
    if df.isStreaming:
        return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("topic", topic).option("checkpointLocation", checkpoint).start())
    out.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    return None
