"""Column helpers and distributed row numbers shared by the operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.session import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# monotonically_increasing_id(): the task's number above, the row's number within the task below
TASK_BITS = 33


def release() -> None:
    """Give freed memory of a Python worker back: it lives on for other tasks, beside the executor's heap."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once a row, however often `body` or a lambda inside it uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def text_hash(text: Column) -> Column:
    """Names a text next to its key where keys may repeat; a null text is an empty one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fits(df: DataFrame, row_bytes: Column, limit: int) -> bool:
    """Whether `df` is measured to be small enough for a broadcast."""
    return (df.agg(F.sum(row_bytes)).first()[0] or 0) <= limit


def numbered(df: DataFrame, order: Sequence[str], label: str) -> DataFrame:
    """Rows in the global order of `order`, with `_task` and `_at`: the row's number is `_at` plus the rows of all earlier tasks.

    A range-partitioned sort, written once: the numbers are part of the table, so a lost executor cannot change them.
    Rows equal in all of `order` may swap numbers, so `order` should name every column that matters.
    """
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id())
    return cut(laid, label).select(
        *df.columns,
        F.shiftright("_row", TASK_BITS).cast("int").alias("_task"),
        F.col("_row").bitwiseAND(F.lit((1 << TASK_BITS) - 1)).alias("_at"),
    )


def with_position(rows: DataFrame) -> DataFrame:
    """`numbered` rows with `_position` (0-based, gapless) and `_total` instead of `_task` and `_at`.

    The broadcast table has one row per task of the sort, however many rows there are.
    """
    sizes = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_task",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_total"),
    )
    return rows.join(F.broadcast(starts), "_task").withColumn("_position", F.col("_start") + F.col("_at")).drop("_task", "_at", "_start")


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on `keys` with null equal to null; the keys appear once, as `left` has them."""
    right = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[k].eqNullSafe(right[f"_right_{k}"]) for k in keys]
    joined = left.join(right, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*(f"_right_{k}" for k in keys))
