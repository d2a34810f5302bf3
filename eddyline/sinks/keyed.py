"""Keyed sinks: tables in which the last write per key wins.

Writes are appended per micro-batch and resolved on read, so a batch costs what it changes, not the size of the table, and replaying a batch changes nothing.
`compact` rewrites the resolved table when the log has grown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eddyline.operators.changelog import DELETE, latest_per_key
from eddyline.streaming.run import batch_folders, read_batches


class KeyedTable:
    """`order` must grow with every write to a key; rows of kind -D in `kind` remove their key."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], order: str, kind: str | None = None) -> None:
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.order, self.kind = keys, order, kind

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """Micro-batch function. Only the last write per key of a batch is kept."""
        batch_folders(self.path)(latest_per_key(batch, self.keys, F.col(self.order)), batch_id)

    def read(self) -> DataFrame:
        rows = read_batches(self.spark, self.path, self.schema).select(*self.schema.names)
        current = latest_per_key(rows, self.keys, F.col(self.order))
        return current.where(F.col(self.kind) != DELETE).drop(self.kind) if self.kind else current

    def compact(self, path: str) -> "KeyedTable":
        """A new table at `path` with one row per key, deletions included so that older writes stay hidden."""
        fresh = KeyedTable(self.spark, path, self.schema, self.keys, self.order, self.kind)
        fresh(read_batches(self.spark, self.path, self.schema).select(*self.schema.names), 0)
        return fresh


def hash_fields(df: DataFrame, hash_key: Column, field: Column, value: Column, order: Column) -> DataFrame:
    """Rows of a hash store: the value of a field under a key."""
    return df.select(
        hash_key.cast("string").alias("hash_key"),
        field.cast("string").alias("field"),
        value.cast("string").alias("value"),
        order.alias("seq"),
    )


def wide_rows(df: DataFrame, row_key: Column, order: Column, **families: Column) -> DataFrame:
    """Rows of a wide-column store: a text key and one struct per column family."""
    return df.select(row_key.cast("string").alias("rowkey"), *[c.alias(n) for n, c in families.items()], order.alias("seq"))
