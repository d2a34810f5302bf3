"""A user-defined sink: hash-store rows as tab-separated files, visible after a commit.

Tasks write to names of their own; the commit lists the files of successful tasks, so retried or
speculative tasks leave nothing behind that is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv as pacsv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from eddyline.sources.storage import resolve


@dataclass
class Written(WriterCommitMessage):
    file: str | None
    rows: int


def written(uri: str, batches: Iterator[pa.RecordBatch]) -> Written:
    """The batches as one file with a name of its own."""
    store, path = resolve(uri)
    store.create_dir(path)
    name, rows, out, file = f"{uuid.uuid4().hex}.tsv", 0, None, None
    options = pacsv.WriteOptions(include_header=False, delimiter="\t")
    for batch in batches:
        if out is None:
            file = store.open_output_stream(f"{path}/{name}")
            out = pacsv.CSVWriter(file, batch.schema, write_options=options)
        out.write_batch(batch)
        rows += batch.num_rows
    if out is None:
        return Written(None, 0)
    out.close()
    file.close()
    return Written(name, rows)


def entered(uri: str, entry: str, messages: list[Written]) -> None:
    """The commit entry; written again it says the same."""
    store, path = resolve(uri)
    store.create_dir(f"{path}/commits")
    done = [m for m in messages if m and m.file]
    with store.open_output_stream(f"{path}/commits/{entry}.json") as f:
        f.write(json.dumps({"files": [m.file for m in done], "rows": sum(m.rows for m in done)}).encode())


class HashWriter(DataSourceArrowWriter):
    def __init__(self, uri: str) -> None:
        self.uri = uri

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return written(self.uri, iterator)

    def commit(self, messages: list[Written]) -> None:
        entered(self.uri, uuid.uuid4().hex, messages)

    def abort(self, messages: list[Written]) -> None:
        """Nothing to undo: files without a commit entry are not read."""


class HashStreamWriter(DataSourceStreamArrowWriter):
    """The same per micro-batch. A batch has one entry, so if it is repeated the files of its first run are forgotten."""

    def __init__(self, uri: str) -> None:
        self.uri = uri

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return written(self.uri, iterator)

    def commit(self, messages: list[Written], batchId: int) -> None:
        entered(self.uri, f"batch-{batchId}", messages)

    def abort(self, messages: list[Written], batchId: int) -> None:
        """Nothing to undo: files without a commit entry are not read."""


class HashSink(DataSource):
    """`df.write.format("hash_store").option("path", uri)` and `df.writeStream...`; the folder must be visible to all executors."""

    @classmethod
    def name(cls) -> str:
        return "hash_store"

    def writer(self, schema: StructType, overwrite: bool) -> HashWriter:
        if overwrite:
            raise ValueError("hash_store only appends")
        return HashWriter(self.options["path"])

    def streamWriter(self, schema: StructType, overwrite: bool) -> HashStreamWriter:
        return HashStreamWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(HashSink)


def read_committed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the files named in the commit entries."""
    commits = spark.read.schema("files array<string>, rows bigint").json(f"{path}/commits")
    files = commits.select(F.explode("files").alias("_file"))
    rows = spark.read.schema(schema).option("sep", "\t").option("pathGlobFilter", "*.tsv").csv(path)
    return rows.withColumn("_file", F.col("_metadata.file_name")).join(files, "_file", "left_semi").drop("_file")
