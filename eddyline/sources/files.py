"""File sources: text lines, delimited files, nested rows, and named sources with options."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CALL_SCHEMA = "sid string, call_out string, call_in string, call_type string, call_time bigint, duration bigint"


def from_rows(spark: SparkSession, rows: list, schema: str | StructType) -> DataFrame:
    """A small in-memory collection."""
    return spark.createDataFrame(rows, schema)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def text_line_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def parse_calls(lines: DataFrame, value: str = "value") -> DataFrame:
    """Comma-separated lines to typed call rows; fields are trimmed. Works on streams.

    Missing and empty fields are null, and so is a number that doesn't parse; `bad_lines` has the lines that lost something.
    """
    parts = F.split(F.col(value), ",")
    field = lambda i: F.nullif(F.trim(F.get(parts, i)), F.lit(""))
    names = ["sid", "call_out", "call_in", "call_type"]
    texts = [field(i).alias(n) for i, n in enumerate(names)]
    numbers = [field(i).try_cast("bigint").alias(n) for i, n in ((4, "call_time"), (5, "duration"))]
    return lines.select(*texts, *numbers)


def bad_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines with another number of fields than a call, or with a number that doesn't parse."""
    parts = F.split(F.col(value), ",")
    numbers = [F.trim(F.get(parts, i)) for i in (4, 5)]
    wrong = [(n != "") & n.try_cast("bigint").isNull() for n in numbers]
    return lines.where((F.size(parts) != 6) | F.coalesce(wrong[0], F.lit(True)) | F.coalesce(wrong[1], F.lit(True)))


def delimited(columns: Sequence[str], sep: str = ",") -> Column:
    """The columns as one delimited text; a null is an empty field, so the others keep their places."""
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def call_lines(calls: DataFrame) -> DataFrame:
    """Call rows as comma-separated lines."""
    return calls.select(delimited(["sid", "call_out", "call_in", "call_type", "call_time", "duration"]).alias("value"))


@dataclass(frozen=True)
class Source:
    """A table definition: format, schema, location and default options. Options given on use override the defaults."""

    format: str
    schema: str
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)

    def _options(self, hints: Mapping[str, str]) -> dict[str, str]:
        return {**self.options, **hints}

    def read(self, spark: SparkSession, **hints: str) -> DataFrame:
        reader = spark.read.format(self.format).schema(self.schema).options(**self._options(hints))
        return reader.load(self.path) if self.path else reader.load()

    def read_stream(self, spark: SparkSession, **hints: str) -> DataFrame:
        reader = spark.readStream.format(self.format).schema(self.schema).options(**self._options(hints))
        return reader.load(self.path) if self.path else reader.load()


def csv_calls(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """A folder of delimited call files with an event-time column computed from the epoch milliseconds."""
    rows = Source("csv", CALL_SCHEMA, path, {"sep": sep}).read(spark)
    return rows.withColumn("row_time", F.timestamp_millis("call_time"))
