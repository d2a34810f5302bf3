"""File and catalog sinks. Streaming sinks are micro-batch functions for `foreachBatch` or plain file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eddyline.streaming.run import batch_folders, read_batches


def console(stream: DataFrame, checkpoint: str, rows: int = 20) -> StreamingQuery:
    """Print each micro-batch."""
    return (
        stream.writeStream.format("console")
        .option("numRows", rows)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def rolling_text(stream: DataFrame, path: str, checkpoint: str, rows_per_file: int, every: str | None = None) -> StreamingQuery:
    """Text files rolled by row count within a micro-batch and by time between micro-batches (`every`)."""
    writer = (
        stream.writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", rows_per_file)
    )
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def csv_stream(stream: DataFrame, path: str, checkpoint: str, sep: str = "|", rows_per_file: int = 0) -> StreamingQuery:
    """Delimited files with exactly-once file commits; `rows_per_file` bounds each file."""
    return (
        stream.writeStream.format("csv")
        .option("sep", sep)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", rows_per_file)
        .trigger(availableNow=True)
        .start()
    )


class TwoPhaseTable:
    """Batches become visible only when committed.

    A micro-batch is first written to its own folder (begin, invoke, pre-commit) and then entered in the commit table. A batch replayed after a
    crash overwrites its folder and its entry, so committing twice is a no-op; a folder without entry is an aborted transaction and
    is never read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType) -> None:
        self.spark, self.path, self.schema = spark, path, schema

    def prepare(self, batch: DataFrame, batch_id: int) -> None:
        batch_folders(f"{self.path}/rows")(batch, batch_id)

    def commit(self, batch_id: int) -> None:
        entry = self.spark.range(1).select(F.lit(batch_id).cast("long").alias("committed"))
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/commits/batch={batch_id}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.prepare(batch, batch_id)
        self.commit(batch_id)

    def read(self) -> DataFrame:
        commits = read_batches(self.spark, f"{self.path}/commits", StructType().add("committed", "long"))
        rows = read_batches(self.spark, f"{self.path}/rows", self.schema)
        return rows.join(commits.select("batch"), "batch", "left_semi").select(*self.schema.names)


# partition columns and their formats, from coarse to fine; a unit has its own column and all coarser ones
PARTS = (("day", "dt", "yyyyMMdd"), ("hour", "hr", "HH"), ("minute", "mm", "mm"), ("second", "ss", "ss"))


class PartitionCommitter:
    """Write rows into time partitions and publish a partition once the watermark is `delay` past its end.

    The watermark of a batch is the largest event time seen up to it, minus the allowed disorder. Rows and the
    watermark per batch are written as small tables; published partitions are a query over them. `unit` is the length of a
    partition: day, hour, minute or second. `publish` also lists the finished partitions in a table of their own, for readers
    that wait for a marker.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, ts: str, zone: str, unit: str = "hour") -> None:
        units = [u for u, _, _ in PARTS]
        if unit not in units:
            raise ValueError(f"unit must be one of {units}")
        self.spark, self.path, self.schema = spark, path, schema
        self.ts, self.zone, self.unit = ts, zone, unit
        self.parts = PARTS[: units.index(unit) + 1]
        self.columns = [c for _, c, _ in self.parts]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        local = F.from_utc_timestamp(F.col(self.ts), self.zone)
        parts = batch.withColumns({c: F.date_format(local, form) for _, c, form in self.parts})
        # rows of one partition together, but a large partition in several tasks
        parts = parts.hint("rebalance", *self.columns)
        parts.write.mode("overwrite").partitionBy(*self.columns).parquet(f"{self.path}/rows/batch={batch_id}")
        top = batch.agg(F.max(self.ts).alias("seen"))
        top.write.mode("overwrite").parquet(f"{self.path}/marks/batch={batch_id}")

    def read(self, disorder: str, delay: str) -> DataFrame:
        """Rows of published partitions only."""
        stamp = self.schema[self.ts].dataType
        marks = read_batches(self.spark, f"{self.path}/marks", StructType().add("seen", stamp))
        limit = marks.agg((F.max("seen") - F.expr(f"INTERVAL {disorder}") - F.expr(f"INTERVAL {delay}")).alias("_l"))
        layout = StructType([*self.schema.fields]).add("batch", "long")
        for c in self.columns:
            layout = layout.add(c, "string")
        rows = self.spark.read.schema(layout).parquet(f"{self.path}/rows")
        start = F.to_timestamp(F.concat(*self.columns), "".join(form for _, _, form in self.parts))
        end = F.to_utc_timestamp(start, self.zone) + F.expr(f"INTERVAL 1 {self.unit}")
        return rows.where(end <= limit.scalar()).select(*self.schema.names, *self.columns)

    def publish(self, disorder: str, delay: str) -> DataFrame:
        """Write and return the list of finished partitions with their row counts."""
        done = self.read(disorder, delay).groupBy(*self.columns).agg(F.count(F.lit(1)).alias("n"))
        done.write.mode("overwrite").parquet(f"{self.path}/published")
        return self.spark.read.schema(done.schema).parquet(f"{self.path}/published")


def save_table(df: DataFrame, name: str, path: str, partition_by: list[str] | None = None) -> None:
    """A catalog table at `path`; with partitions, rows of one partition are written together, large ones by several tasks."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("path", path)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


