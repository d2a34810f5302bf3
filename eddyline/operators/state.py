"""Keyed state as batch queries: gaps, running maps, expiring totals, timers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.operators.anchored import anchored_windows
from eddyline.operators.blocks import Width, block_window, once, own_rows, running, with_neighbours
from eddyline.session import cut


def gap_to_previous(df: DataFrame, key: str, order: str, t: str, width: Width, out: str = "gap") -> DataFrame:
    """Time since the key's previous row; null on its first row."""
    names = df.columns
    near = with_neighbours(df, [key], [order], [t], width, before=1)
    lagged = near.withColumn(out, F.col(t) - F.lag(t).over(block_window([key], [order])))
    return own_rows(lagged).select(*names, out)


def expiring_total(df: DataFrame, key: str, order: str, t: str, value: str, ttl: int, width: Width, out: str = "total") -> DataFrame:
    """Running total per key that starts again when the key was silent for `ttl` or longer."""
    rows = df.select(*dict.fromkeys([key, order, t, value]))
    before = {"_last": ("last", F.col(t)), "_sum": ("sum", F.col(value))}
    seen = running(rows, [key], [order], before, width, exclusive=True)
    so_far = F.coalesce("_sum", F.lit(0))
    fresh = F.coalesce(F.col(t) - F.col("_last") >= ttl, F.lit(True))
    # a total is the running sum minus the running sum where it last started again
    sums = once(seen.select(*rows.columns, (so_far + F.col(value)).alias("_sum"), F.when(fresh, so_far).alias("_start")), "sums")
    kept = running(sums, [key], [order], {"_base": ("last", F.col("_start"))}, width)
    return kept.withColumn(out, F.col("_sum") - F.col("_base")).select(key, order, t, value, out)


def silent_failures(
    df: DataFrame, key: str, order: str, t: str, failed: Column, timeout: int, width: Width, block: int | None = None
) -> DataFrame:
    """Alerts (key, fail_t, alert_t): the first failure arms a timer, any other row disarms it, firing re-arms on the next failure.

    A stretch of failures is named by the row that ends it; the timers inside a stretch are anchored windows.
    `width` cuts the order column; time is in ticks as for anchored windows, with `block` ticks per block.
    """
    ok = F.coalesce(failed, F.lit(False))
    end = F.when(~ok, F.struct(F.col(order).alias("seq"), F.col(t).alias("t")))
    rows = df.select(*dict.fromkeys([key, order, t]), ok.alias("_fail"), end.alias("_row"))
    stretches = running(rows, [key], [order], {"_end": ("last", F.col("_row"))}, width, exclusive=True, reverse=True)
    open_end = F.lit(2**62)
    failures = cut(
        stretches.where("_fail").select(
            key, t, F.coalesce(F.col("_end.seq"), open_end).alias("_stop"), F.coalesce(F.col("_end.t"), open_end).alias("_stop_t")
        )
    )
    timers = anchored_windows(failures, [key, "_stop", "_stop_t"], t, timeout, F.lit(1), block)
    return timers.where(F.col("fire_at") < F.col("_stop_t")).select(
        key, F.col("anchor").alias("fail_t"), F.col("fire_at").alias("alert_t")
    )
