"""Kafka sources. Reading needs the Kafka connector on the class path; decoding works on any (key, value) table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def topic(spark: SparkSession, servers: str, name: str, starting: str = "latest", **options: str) -> DataFrame:
    return (
        spark.readStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "subscribe": name, "startingOffsets": starting, **options})
        .load()
    )


def values(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("value").cast("string").alias("value"))


def keys_and_values(messages: DataFrame) -> DataFrame:
    """Keys and values as text; nulls stay null."""
    return messages.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def table_with_key(messages: DataFrame, key_column: str, key_type: str, value_schema: str) -> DataFrame:
    """A table whose key column is the message key and whose other columns are the CSV value."""
    row = F.from_csv(F.col("value").cast("string"), value_schema)
    return messages.select(F.col("key").cast("string").cast(key_type).alias(key_column), row.alias("_row")).select(key_column, "_row.*")
