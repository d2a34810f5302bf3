"""Starting streams, draining them into tables, and reading tables as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from eddyline.session import work_path

BatchSink = Callable[[DataFrame, int], None]


def stream_table(spark: SparkSession, sf_dir: str, name: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """A stored table as a stream, with its time column as a zoned timestamp so that it can carry a watermark."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # a glob, because a table may be one file or a folder of files
    stream = reader.parquet(f"{sf_dir}/{name}.parque[t]")
    return stream.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in schema.names else stream


def start(stream: DataFrame, sink: BatchSink, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything available now through `sink`, remembering progress in `checkpoint`."""
    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )


def drain(stream: DataFrame, label: str, mode: str = "append", keys: tuple[str, ...] = ()) -> DataFrame:
    """Run a stream over all input there is and return what it wrote.

    In update mode a key may be written by several batches; with `keys` the latest batch wins.
    """
    spark = stream.sparkSession
    path = work_path(spark, label)
    sink = batch_folders(f"{path}/rows")
    start(stream, sink, f"{path}/checkpoint", mode).awaitTermination()
    schema = StructType([*stream.schema.fields]).add("batch", "long")
    rows = spark.read.schema(schema).parquet(f"{path}/rows")
    if keys:
        last = F.max_by(F.struct(*stream.columns), "batch")
        rows = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(last.alias("_row")).select("_row.*")
    return rows.select(*stream.columns)


def batch_folders(path: str) -> BatchSink:
    """Write each micro-batch to its own folder. A replayed batch overwrites its folder, so nothing is doubled."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields]).add("batch", "long")).parquet(path)


def run_all(queries: list[StreamingQuery]) -> None:
    """Wait for several independent streams of one program."""
    for q in queries:
        q.awaitTermination()
