"""User-defined functions: built-in expressions first, then the Arrow surfaces for arbitrary Python."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def concat_bar(*columns: Column) -> Column:
    """Values of any type joined by a bar. A null argument gives null rather than being skipped."""
    text = [c.cast("string") for c in columns]
    out = text[0]
    for c in text[1:]:
        out = F.concat(out, F.lit("|"), c)
    return out


def average(column: str) -> Column:
    """True average; null on empty input."""
    return F.avg(column)


def integer_average(column: str) -> Column:
    """Sum divided by count in integers, cut towards zero; null on empty input."""
    return F.call_function("div", F.sum(column), F.nullif(F.count(column), F.lit(0)))


def split_bar(df: DataFrame, text: str) -> DataFrame:
    """One row (word, length) per bar-separated word, next to the other columns."""
    word = F.explode(F.split(F.col(text), r"\|"))
    return df.withColumn("word", word).withColumn("length", F.length("word"))


def register_sql_functions(spark: SparkSession) -> None:
    """The same functions under SQL names; bodies are SQL, so they are inlined into the plan."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION concat_bar3(a STRING, b STRING, c STRING) RETURNS STRING "
        "RETURN concat(a, '|', b, '|', c)"
    )
    spark.sql(
        r"CREATE OR REPLACE TEMPORARY FUNCTION split_bar(s STRING) RETURNS TABLE(word STRING, length INT) "
        r"RETURN SELECT w, length(w) FROM explode(split(s, '\\|')) AS t(w)"
    )


def with_lifecycle(df: DataFrame, open_: Callable, process: Callable, close: Callable, schema: str) -> DataFrame:
    """Run `process(resource, batch)` on Arrow batches with `open_` / `close` once per task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resource = open_()
        try:
            for batch in batches:
                yield process(resource, batch)
        finally:
            close(resource)

    return df.mapInArrow(task, schema)
