"""Row-level transforms. All work on batch and streaming DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_words(df: DataFrame, text: str, separator: str = " ", out: str = "word") -> DataFrame:
    """One row per token; `separator` is a regular expression."""
    return df.select(F.explode(F.split(F.col(text), separator)).alias(out))


STRETCH = 10_000


def word_count(df: DataFrame, text: str, separator: str = " ") -> DataFrame:
    return split_words(df, text, separator).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def word_count_with_prefix(df: DataFrame, text: str, prefix: str, separator: str = " ") -> DataFrame:
    words = split_words(df, text, separator).where(F.col("word").startswith(prefix))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def countdown(df: DataFrame, number: str, out: str = "x") -> DataFrame:
    """The feedback loop x, x-1, ... as two generators: every positive value down to 1, or the value itself.

    The rows come in stretches of `STRETCH` values, so the lists in memory stay short however large the value is.
    """
    x, size, zero, one = F.col(number).cast("long"), F.lit(STRETCH).cast("long"), F.lit(0).cast("long"), F.lit(1).cast("long")
    parts = F.sequence(zero, F.greatest(F.call_function("div", x - 1, size), zero))
    each = df.withColumn("_part", F.explode(F.coalesce(parts, F.array(zero))))
    top = x - F.col("_part") * size
    values = F.when(x >= 1, F.sequence(top, F.greatest(top - size + 1, one), -one)).otherwise(F.array(x))
    return each.withColumn(out, F.explode(values)).drop("_part")


def countdown_exit(df: DataFrame, number: str, out: str = "x") -> DataFrame:
    """The other form of the loop: only the value with which each element leaves it."""
    return df.withColumn(out, F.least(F.col(number).cast("long"), F.lit(0)))


def split_outputs(df: DataFrame, tags: Mapping[str, Column], tag: str = "output") -> tuple[DataFrame, dict[str, DataFrame]]:
    """Tag each row with the first output whose condition holds; return the tagged rows and one view per output."""
    expr = F.lit(None).cast("string")
    for name, condition in reversed(list(tags.items())):
        expr = F.when(condition, F.lit(name)).otherwise(expr)
    tagged = df.withColumn(tag, expr)
    return tagged, {name: tagged.where(F.col(tag) == name).drop(tag) for name in tags}


def describe_call(start_us: Column, duration: Column, call_out: Column, call_in: Column) -> Column:
    """Text of a call. The end time adds the duration to the start in milliseconds, not seconds; the report
    this reproduces does the same."""
    start = F.date_format(F.timestamp_micros(start_us), "yyyy-MM-dd HH:mm:ss")
    end = F.date_format(F.timestamp_micros(start_us + duration * 1000), "yyyy-MM-dd HH:mm:ss")
    return F.concat_ws(
        ",",
        F.concat(F.lit("caller:"), call_out.cast("string")),
        F.concat(F.lit("callee:"), call_in.cast("string")),
        F.concat(F.lit("start:"), start),
        F.concat(F.lit("end:"), end),
    )
