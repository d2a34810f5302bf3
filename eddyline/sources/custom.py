"""A user-defined source: folders of call-log text files, in batch and as a stream.

Files are divided into byte ranges of `splitBytes`; a line belongs to the range in which it begins, so large files are read by several tasks. Filters on
single columns are taken over from the plan and applied while the lines are parsed. As a stream the source remembers how many bytes of each file it has
read, up to the last complete line, so files may grow and new ones may come.
"""

from __future__ import annotations

import functools
import json
import operator
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql.types import StructType

from eddyline.sources.files import CALL_SCHEMA
from eddyline.sources.storage import resolve, sizes

SPLIT_BYTES = 32 << 20
TAIL = 64 << 10
COLUMNS = {
    "sid": pa.string(),
    "call_out": pa.string(),
    "call_in": pa.string(),
    "call_type": pa.string(),
    "call_time": pa.int64(),
    "duration": pa.int64(),
}
COMPARISONS = {ds.EqualTo: operator.eq, ds.GreaterThan: operator.gt, ds.GreaterThanOrEqual: operator.ge, ds.LessThan: operator.lt, ds.LessThanOrEqual: operator.le}


@dataclass
class LogRange(ds.InputPartition):
    path: str
    start: int
    end: int


def ranges(path: str, start: int, end: int, size: int) -> Iterator[LogRange]:
    for a in range(start, end, size):
        yield LogRange(path, a, min(a + size, end))


def lines_of(uri: str, part: LogRange) -> bytes:
    """The lines that begin inside the range."""
    store, _ = resolve(uri)
    with store.open_input_file(part.path) as f:
        first = max(0, part.start - 1)
        f.seek(first)
        data = f.read(part.end - first)
        if part.start:
            data = data[data.find(b"\n") + 1 :] if b"\n" in data else b""
        while data and not data.endswith(b"\n"):
            more = f.read(TAIL)
            if not more:
                break
            data += more[: more.find(b"\n") + 1] if b"\n" in more else more
        return data


def expression(test: ds.Filter) -> pc.Expression | None:
    """A filter on one column for pyarrow; None for those that are left to Spark."""
    if isinstance(test, ds.Not):
        return None
    name = getattr(test, "attribute", ())
    if len(name) != 1 or name[0] not in COLUMNS:
        return None
    field = pc.field(name[0])
    if isinstance(test, ds.IsNotNull):
        return field.is_valid()
    if isinstance(test, ds.IsNull):
        return field.is_null()
    if isinstance(test, ds.In):
        return field.isin(list(test.value))
    if isinstance(test, ds.StringStartsWith):
        return pc.starts_with(field, pattern=test.value)
    compare = COMPARISONS.get(type(test))
    return compare(field, test.value) if compare else None


def parsed(data: bytes, tests: list[pc.Expression]) -> Iterator[pa.RecordBatch]:
    if not data:
        return
    table = pacsv.read_csv(pa.BufferReader(data), pacsv.ReadOptions(column_names=list(COLUMNS)), convert_options=pacsv.ConvertOptions(column_types=COLUMNS))
    if tests:
        table = table.filter(functools.reduce(operator.and_, tests))
    yield from table.to_batches()


class CallLogReader(ds.DataSourceReader):
    def __init__(self, uri: str, split: int) -> None:
        self.uri, self.split, self.filters = uri, split, []

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for f in filters:
            if expression(f) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list[LogRange]:
        return [r for path, size in sizes(self.uri, ".txt").items() for r in ranges(path, 0, size, self.split)]

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        yield from parsed(lines_of(self.uri, partition), [expression(f) for f in self.filters])


class CallLogStream(ds.DataSourceStreamReader):
    """Offsets are the bytes read of each file; one number per file of the folder."""

    def __init__(self, uri: str, split: int) -> None:
        self.uri, self.split = uri, split

    def initialOffset(self) -> dict:
        return {"files": "{}"}

    def latestOffset(self) -> dict:
        return {"files": json.dumps({path: self._complete(path, size) for path, size in sizes(self.uri, ".txt").items()}, sort_keys=True)}

    def _complete(self, path: str, size: int) -> int:
        """Bytes up to the last line end."""
        store, _ = resolve(self.uri)
        with store.open_input_file(path) as f:
            at = size
            while at > 0:
                low = max(0, at - TAIL)
                f.seek(low)
                tail = f.read(at - low)
                if b"\n" in tail:
                    return low + tail.rfind(b"\n") + 1
                at = low
        return 0

    def partitions(self, start: dict, end: dict) -> list[LogRange]:
        before, now = json.loads(start["files"]), json.loads(end["files"])
        return [r for path, size in now.items() for r in ranges(path, before.get(path, 0), size, self.split)]

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        yield from parsed(lines_of(self.uri, partition), [])


class CallLogSource(ds.DataSource):
    """`spark.read.format("call_log").load(folder)` or `spark.readStream...`; options: path (any URI), splitBytes."""

    @classmethod
    def name(cls) -> str:
        return "call_log"

    def schema(self) -> str:
        return CALL_SCHEMA

    def reader(self, schema: StructType) -> CallLogReader:
        return CallLogReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))

    def streamReader(self, schema: StructType) -> CallLogStream:
        return CallLogStream(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


def register(spark: SparkSession) -> None:
    """Make the source known, and let it take filters over."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(CallLogSource)
