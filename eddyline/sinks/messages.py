"""Encoding rows as (key, value) messages. Writing them to a topic needs the Kafka connector."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eddyline.operators.changelog import DELETE


def value_message(df: DataFrame, *columns: str, sep: str = "-") -> DataFrame:
    return df.select(F.concat_ws(sep, *[F.col(c).cast("string") for c in columns]).alias("value"))


def key_value_message(df: DataFrame, key: Column, value: Column) -> DataFrame:
    return df.select(key.cast("string").alias("key"), value.cast("string").alias("value"))


def row_message(df: DataFrame, key: str) -> DataFrame:
    """The key column as key and all columns, the key included, as CSV value."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_csv(F.struct(*df.columns)).alias("value"))


def upsert_message(log: DataFrame, key: str, order: str, kind: str = "row_kind") -> DataFrame:
    """Key and latest value per change; a deletion has a null value."""
    body = F.to_json(F.struct(*[c for c in log.columns if c not in (key, order, kind)]))
    return log.select(
        F.col(key).cast("string").alias("key"), F.when(F.col(kind) != DELETE, body).alias("value"), F.col(order)
    )


def compacted(messages: DataFrame, order: str) -> DataFrame:
    """What remains of an upsert log: the last message per key, without tombstones."""
    last = messages.groupBy("key").agg(F.max_by(F.struct("value"), order).alias("_v"))
    return last.select("key", "_v.value").where("value IS NOT NULL")


def to_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """At-least-once: a consumer drops duplicates by key and value or by a sequence in the message."""
    return (
        messages.writeStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint})
        .start()
    )
