"""Watermarks on stored data.

A stream decides lateness by the watermark at the moment a row arrives. Given the arrival order as a column,
the same decision is a running maximum, so every late-data rule becomes an ordinary query.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.operators.blocks import Width, block_start, running


def with_watermark(
    df: DataFrame,
    arrival: Sequence[str],
    t: str,
    delay: int,
    width: Width,
    source: Sequence[str] = (),
    advances: Column | None = None,
    before: bool = True,
    out: str = "wm",
) -> DataFrame:
    """Add the watermark max(t) - delay - 1 seen before (or with `before=False` after) each row.

    `arrival` is the order of arrival, integer first; `source` the columns that have a watermark of their own;
    only rows meeting `advances` move it. Null until a row has moved it.
    """
    seen = F.col(t) if advances is None else F.when(advances, F.col(t))
    rows = running(df, source, arrival, {"_max": ("max", seen)}, width, exclusive=before)
    return rows.withColumn(out, F.col("_max") - delay - 1).drop("_max")


def classify_late(df: DataFrame, t: str, size: int, lateness: int, wm: str = "wm") -> DataFrame:
    """Add the tumbling window bounds and `arrival`: on_time, late_ok (the window fires again) or dropped."""
    end = block_start(F.col(t), size) + size
    closed = F.coalesce(end - 1 <= F.col(wm), F.lit(False))
    gone = F.coalesce(end - 1 + lateness <= F.col(wm), F.lit(False))
    kind = F.when(gone, "dropped").when(closed, "late_ok").otherwise("on_time")
    return df.withColumns({"t_start": end - size, "t_end": end, "arrival": kind})
