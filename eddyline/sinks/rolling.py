"""Text files that are rolled by size, age and inactivity, over micro-batches.

A stream writer of its own: every task appends lines to a part file and begins the next one before the bound on bytes is passed. A ledger per micro-batch lists the
finished parts and the open ones. In the next micro-batch a task takes an open part over: it writes its lines and the new ones to a new file, and the commit puts that
one in the old one's place. A part is finished when it is full, when it is older than `max_age` seconds, or when no line came for `inactive` seconds.

The ledger of a batch follows from the ledger of the batch before it and the files of its tasks, so a batch that is repeated writes the same ledger again, and
files that no ledger lists are never read. Part files are small copies of themselves at most once per micro-batch and task.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from eddyline.sources.storage import resolve

Part = dict[str, Any]  # file, bytes, since, touched


@dataclass
class Parts(WriterCommitMessage):
    took: str | None
    parts: list[Part] = field(default_factory=list)


def ledger(uri: str, batch: int) -> dict[str, list[Part]]:
    """Finished and open parts as of the end of a batch."""
    store, path = resolve(uri)
    name = f"{path}/ledger/{batch}.json"
    if batch < 0 or store.get_file_info(name).type == fs.FileType.NotFound:
        return {"done": [], "open": []}
    with store.open_input_stream(name) as f:
        return json.loads(f.read())


class RollingWriter(DataSourceStreamArrowWriter):
    def __init__(self, uri: str, max_bytes: int, max_age: float, inactive: float) -> None:
        self.uri, self.max_bytes, self.max_age, self.inactive = uri, max_bytes, max_age, inactive

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        task = TaskContext.get()
        return self.written(iterator, task.partitionId(), int(task.getLocalProperty("streaming.sql.batchId")))

    def written(self, iterator: Iterator[pa.RecordBatch], number: int, batch: int) -> Parts:
        store, path = resolve(self.uri)
        store.create_dir(f"{path}/parts")
        now = time.time()
        found = ledger(self.uri, batch - 1)["open"]
        taken = found[number] if number < len(found) else None
        out, made = None, Parts(None)
        for lines in iterator:
            for line in lines.column(0).to_pylist():
                raw = (line or "").encode() + b"\n"
                if out is None and taken and made.took is None:
                    # the open part goes on under a new name
                    made.took = taken["file"]
                    made.parts.append(self._new(taken["since"], now))
                    out = store.open_output_stream(f"{path}/parts/{made.parts[-1]['file']}")
                    with store.open_input_stream(f"{path}/parts/{taken['file']}") as old:
                        out.write(old.read())
                    made.parts[-1]["bytes"] = taken["bytes"]
                if out is None or made.parts[-1]["bytes"] + len(raw) > self.max_bytes and made.parts[-1]["bytes"]:
                    if out is not None:
                        out.close()
                    made.parts.append(self._new(now, now))
                    out = store.open_output_stream(f"{path}/parts/{made.parts[-1]['file']}")
                out.write(raw)
                made.parts[-1]["bytes"] += len(raw)
        if out is not None:
            out.close()
        return made

    @staticmethod
    def _new(since: float, now: float) -> Part:
        return {"file": f"{uuid.uuid4().hex}.txt", "bytes": 0, "since": since, "touched": now}

    def commit(self, messages: list[Parts], batchId: int) -> None:
        store, path = resolve(self.uri)
        before, now = ledger(self.uri, batchId - 1), time.time()
        told = [m for m in messages if m]
        taken = {m.took for m in told}
        done = before["done"] + [p for m in told for p in m.parts[:-1]]  # all but a task's last part are full
        waiting = [p for p in before["open"] if p["file"] not in taken] + [p for m in told for p in m.parts[-1:]]
        opened = [p for p in waiting if p["bytes"] < self.max_bytes and now - p["since"] < self.max_age and now - p["touched"] < self.inactive]
        done += [p for p in waiting if p not in opened]
        store.create_dir(f"{path}/ledger")
        with store.open_output_stream(f"{path}/ledger/{batchId}.json") as f:
            f.write(json.dumps({"done": done, "open": opened}).encode())

    def abort(self, messages: list[Parts], batchId: int) -> None:
        """Nothing to undo: files that no ledger lists are not read."""


class RollingText(DataSource):
    """`stream.writeStream.format("rolling_text")` of one string column; options: path (any URI), maxBytes, maxAge and inactive in seconds."""

    @classmethod
    def name(cls) -> str:
        return "rolling_text"

    def streamWriter(self, schema: StructType, overwrite: bool) -> RollingWriter:
        limit = float("inf")
        return RollingWriter(self.options["path"], int(self.options["maxBytes"]), float(self.options.get("maxAge", limit)), float(self.options.get("inactive", limit)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RollingText)


def parts(spark: SparkSession, uri: str) -> DataFrame:
    """(file, bytes, since, touched, finished) as of the last ledger."""
    store, path = resolve(uri)
    found = store.get_file_info(fs.FileSelector(f"{path}/ledger", allow_not_found=True))
    last = max((int(f.base_name.removesuffix(".json")) for f in found), default=-1)
    entry = ledger(uri, last)
    rows = [(p["file"], p["bytes"], p["since"], p["touched"], kind == "done") for kind in ("done", "open") for p in entry[kind]]
    return spark.createDataFrame(rows, "file string, bytes long, since double, touched double, finished boolean")


def read(spark: SparkSession, uri: str) -> DataFrame:
    """(value, file) of all listed parts."""
    lines = spark.read.schema("value string").text(f"{uri}/parts").withColumn("file", F.col("_metadata.file_name"))
    return lines.join(F.broadcast(parts(spark, uri).select("file")), "file", "left_semi").select("value", "file")
