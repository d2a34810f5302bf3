"""Window operators.

Tumbling and sliding windows are Spark's own `window`; this module holds the kinds Spark does not have, and
the session and count windows in a form that keeps hot keys spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.operators.blocks import BLOCK, HOT, Width, block_start, cut_into_blocks, once, running
from eddyline.session import cut


def tumble(df: DataFrame, keys: Sequence[str], ts: str, size: str, *aggs: Column) -> DataFrame:
    return _flat(df.groupBy(*keys, F.window(ts, size).alias("_win")).agg(*aggs), keys)


def slide(df: DataFrame, keys: Sequence[str], ts: str, size: str, step: str, *aggs: Column) -> DataFrame:
    return _flat(df.groupBy(*keys, F.window(ts, size, step).alias("_win")).agg(*aggs), keys)


def _flat(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in (*keys, "_win")]
    return df.select(*keys, F.col("_win.start").alias("win_start"), F.col("_win.end").alias("win_end"), *rest)


def sessions(df: DataFrame, keys: Sequence[str], t: str, gap: Column, value: Column, width: Width) -> DataFrame:
    """Session windows on an integer time column: rows (keys, t_start, t_end, total, n).

    An event at exactly the gap distance joins the session. `gap` may depend on the row. Sessions are
    built inside (key, block), so a hot key is spread over its blocks; only the partial sessions of hot keys are then merged, of
    which such a key has at most one per gap and block.
    """
    gap_interval = F.make_interval(secs=((F.col("_gap_end") - F.col("_t")) / 1_000_000).cast("decimal(18,6)"))
    rows = df.select(*keys, F.col(t).alias("_t"), (F.col(t) + gap).alias("_gap_end"), value.alias("_x"))
    laid, split = cut_into_blocks(rows, keys, "_t", width)
    own = [*keys, BLOCK, HOT] if split else [*keys]
    parts = (
        laid.withColumn("_at", F.timestamp_micros("_t"))
        .groupBy(*own, F.session_window("_at", gap_interval).alias("_s"))
        .agg(F.min("_t").alias("_from"), F.max("_gap_end").alias("_to"), F.sum("_x").alias("_total"), F.count(F.lit(1)).alias("_n"))
    )
    whole = [*keys, F.col("_from").alias("t_start"), F.col("_to").alias("t_end"), F.col("_total").alias("total"), F.col("_n").alias("n")]
    if not split:
        return parts.select(*whole)
    written = cut(parts.withColumn(HOT, F.coalesce(HOT, F.lit(False))).drop("_s"), "sessions")
    merged = merge_sessions(written.where(HOT).drop(HOT, BLOCK), keys)
    return written.where(~F.col(HOT)).select(*whole).unionByName(merged)


def merge_sessions(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merge partial sessions (keys, _from, _to, _total, _n) that touch or overlap.

    How far the earlier ones reach and which session a part belongs to are running aggregates, so neither a hot key nor the
    whole table (without keys) is one task.
    """
    order = ["_from", "_to"]
    seen = running(parts, keys, order, {"_reach": ("max", F.col("_to"))}, None, exclusive=True)
    opens = F.when(F.col("_from") <= F.col("_reach"), 0).otherwise(1).cast("long")
    opened = once(seen.withColumn("_opens", opens).drop("_reach"), "openings")
    return (
        running(opened, keys, order, {"_id": ("sum", F.col("_opens"))}, None)
        .groupBy(*keys, "_id")
        .agg(
            F.min("_from").alias("t_start"),
            F.max("_to").alias("t_end"),
            F.sum("_total").alias("total"),
            F.sum("_n").alias("n"),
        )
        .drop("_id")
    )


def cumulate(df: DataFrame, keys: Sequence[str], t: str, step: int, size: int, value: Column) -> DataFrame:
    """Cumulating windows: the same start, an end growing by `step` up to `size`.

    Rows are summed per step first; each non-empty step then stands for all window ends up to the next
    non-empty step, so neither raw rows nor empty steps are multiplied before the aggregation.
    """
    if size % step:
        raise ValueError("size must be a multiple of step")
    steps = (
        df.groupBy(*keys, block_start(F.col(t), step).alias("_step"))
        .agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_n"))
        .withColumn("t_start", block_start(F.col("_step"), size))
    )
    w = Window.partitionBy(*keys, "t_start").orderBy("_step")
    frame = w.rowsBetween(Window.unboundedPreceding, 0)
    last_end = F.coalesce(F.lead("_step").over(w), F.col("t_start") + size)
    return (
        steps.select(
            *keys,
            "t_start",
            (F.col("_step") + step).alias("_first"),
            last_end.alias("_last"),
            F.sum("_sum").over(frame).alias("total"),
            F.sum("_n").over(frame).alias("n"),
        )
        .withColumn("t_end", F.explode(F.sequence("_first", "_last", F.lit(step).cast("long"))))
        .drop("_first", "_last")
    )


def count_windows(df: DataFrame, keys: Sequence[str], order: str, size: int, value: Column, width: Width) -> DataFrame:
    """Every full group of `size` rows per key (or of the whole input with no keys); a partial tail is not emitted."""
    one = F.lit(1).cast("long")
    return (
        running(df.select(*keys, order, value.alias("_x")), keys, [order], {"_rn": ("sum", one)}, width)
        .groupBy(*keys, F.floor((F.col("_rn") - 1) / size).alias("win_no"))
        .agg(F.min(order).alias("first_seq"), F.max(order).alias("last_seq"), F.sum("_x").alias("total"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") == size)
        .drop("n")
    )


def count_windows_sliding(
    df: DataFrame, keys: Sequence[str], order: str, size: int, step: int, value: Column, width: Width
) -> DataFrame:
    """After every `step` rows of a key, the last (at most) `size` rows.

    Each numbered row is added to the firings that see it, so one ordinary aggregation does the rest.
    """
    rn = F.col("_rn")
    first = F.ceil(rn / step)
    last = F.floor((rn + size - 1) / step)
    return (
        running(df.select(*keys, order, value.alias("_x")), keys, [order], {"_rn": ("sum", F.lit(1).cast("long"))}, width)
        .withColumn("firing", F.explode(F.sequence(first, last)))
        .groupBy(*keys, "firing")
        .agg(F.max("_rn").alias("_max"), F.max(order).alias("last_seq"), F.sum("_x").alias("total"), F.count(F.lit(1)).alias("n"))
        .where(F.col("_max") == F.col("firing") * step)
        .drop("_max")
    )


def delta_evicted(df: DataFrame, keys: Sequence[str], ts: str, size: str, order: str, value: str, threshold: int) -> DataFrame:
    """Tumbling sum over the rows whose value differs from the window's last value by less than `threshold`.

    Rows are counted per distinct value first; the last value is an aggregate of these counts that joins back by key and window.
    """
    grouped = df.groupBy(*keys, F.window(ts, size).alias("_win"), value).agg(
        F.count(F.lit(1)).alias("_n"), F.max(order).alias("_at")
    )
    on = [*keys, "_win"]
    last = grouped.groupBy(*[F.col(c).alias(f"_of_{c}") for c in on]).agg(F.max_by(value, "_at").alias("_last"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in on])
    return _flat(
        grouped.join(last, same)
        .where(F.abs(F.col(value) - F.col("_last")) < threshold)
        .groupBy(*keys, "_win")
        .agg(F.sum(F.col(value) * F.col("_n")).alias("total"), F.sum("_n").alias("n")),
        keys,
    )
