"""Batch and streaming readers.  All of them give text records in a column ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.cdc import CORRUPT, parse_cdc, parse_json, split_cdc
from millrace.operators.logs import parse_logs


def text_files(spark: SparkSession, path: str) -> DataFrame:
    """Records in text files, one per line."""
    return spark.read.text(path)


def text_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New text files below ``path`` as a stream of records."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path)


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, starting: str = "latest", **options: str
) -> DataFrame:
    """Values of a topic as a stream of records (needs the Kafka package of Spark).

    The checkpoint of the query holds the offsets, so a restart goes on where it stopped.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def json_table(records: DataFrame, schema) -> DataFrame:
    """Records as typed columns; broken records are dropped."""
    return parse_json(records, schema).where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def change_records(records: DataFrame) -> DataFrame:
    """Change envelopes of the business database."""
    return parse_cdc(records)


def broken_changes(records: DataFrame) -> DataFrame:
    """Text of change records that are no JSON object, for a dirty output of their own."""
    return split_cdc(records)[1]


def log_records(records: DataFrame) -> DataFrame:
    """Behaviour logs with ``_corrupt`` for broken records."""
    return parse_logs(records)


def route_changes(records: DataFrame) -> DataFrame:
    """Changes of the routing configuration."""
    return json_table(records, schemas.ROUTE_CHANGE)


def page_table(records: DataFrame, delay: str = "2 seconds") -> DataFrame:
    """Page logs with event time ``rt`` and, on streams, its watermark."""
    pages = json_table(records, schemas.LOG).withColumn("rt", F.timestamp_millis(F.col("ts")))
    return pages.withWatermark("rt", delay) if pages.isStreaming else pages


def jdbc_dictionary(
    spark: SparkSession, url: str, table: str = "base_dic", **options: str
) -> DataFrame:
    """The dictionary table of the business database.

    Each batch or micro-batch reads it anew when used as the static side of a
    ``foreachBatch`` job.
    """
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .options(**options)
        .load()
        .select(*schemas.DICTIONARY.fieldNames())
    )
