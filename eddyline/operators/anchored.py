"""Anchored windows: a key's first row opens a window of fixed length, the first row at or after its end opens the next.

They are neither tumbling nor session windows: where a window starts depends on all earlier ones. Each
block of a key's rows is therefore summarised as a step function "no window can open before time d on entry
-> nor before time e on exit"; the functions are chained per key, and then every block places its windows on its own.
Blocks are independent groups in the two heavy passes. The chaining pass sees the steps only: windows that start
apart soon fall together, so a block of k windows has about 2 / k times as many steps as a window has points.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.operators.blocks import block_start

NEVER = -(2**62)


def whole_groups(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Re-cut a sorted stream of batches so that the rows of one group are never in two frames."""
    pending: list[pd.DataFrame] = []
    for pdf in batches:
        if pdf.empty:
            continue
        joined = pd.concat([pending[-1].tail(1), pdf]) if pending else pdf
        ids = joined.groupby(list(keys), sort=False, dropna=False).ngroup().to_numpy()
        ids = ids[1:] if pending else ids
        continues = bool(pending) and ids[-1] == 0
        if continues:
            pending.append(pdf)
            continue
        tail = int(np.searchsorted(ids, ids[-1]))
        head = [*pending, pdf.iloc[:tail]]
        if sum(map(len, head)):
            yield pd.concat(head, ignore_index=True)
        pending = [pdf.iloc[tail:]]
    if pending:
        yield pd.concat(pending, ignore_index=True)


def _per_group(df: DataFrame, keys: Sequence[str], group: Sequence[str], order: Sequence[str | Column], fn: Callable, schema: T.StructType) -> DataFrame:
    """Hash-distribute by `keys`, sort, and hand whole groups (many at a time) to `fn`, one call per task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return fn(whole_groups(batches, group))

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInPandas(run, schema)


def _jumps(pdf: pd.DataFrame, group: Sequence[str], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group ids, times, position on one common axis, and per row the next row at least `length` later in its group."""
    g = pdf.groupby(list(group), sort=False, dropna=False).ngroup().to_numpy().astype(np.int64)
    t = pdf["_t"].to_numpy().astype(np.int64)
    offset = t - pdf["_block"].to_numpy().astype(np.int64)
    axis = g * (offset.max() + length + 1) + offset
    after = np.searchsorted(axis, axis + length)
    inside = after < len(t)
    inside[inside] = g[after[inside]] == g[inside]
    return g, t, offset, axis, np.where(inside, after, -1)


def _steps(keys: Sequence[str], length: int) -> Callable:
    group = [*keys, "_block"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            g, t, offset, _, nxt = _jumps(pdf, group, length)
            here = np.arange(len(t))
            last = np.where(nxt >= 0, nxt, here)
            while True:
                further = last[last]
                if np.array_equal(further, last):
                    break
                last = further
            leave = t[last] + length
            first = np.r_[True, g[1:] != g[:-1]]
            entry = first | (np.r_[0, offset[:-1]] < length) | (offset < length)
            kept = np.flatnonzero(entry)
            same = (g[kept[1:]] == g[kept[:-1]]) & (leave[kept[1:]] == leave[kept[:-1]])
            kept = kept[np.r_[~same, True]]
            out = pdf.iloc[kept][group].copy()
            out["_entry"], out["_exit"] = t[kept], leave[kept]
            yield out

    return run


def _chain(keys: Sequence[str]) -> Callable:
    group = [*keys, "_block"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, deadline = None, NEVER
        for pdf in frames:
            g = pdf.groupby(group, sort=False, dropna=False).ngroup().to_numpy()
            entry, leave = pdf["_entry"].to_numpy(), pdf["_exit"].to_numpy()
            starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            ends = np.r_[starts[1:], len(g)]
            out = pdf.iloc[starts][group].copy()
            ids = out.groupby(list(keys), sort=False, dropna=False).ngroup().to_numpy()
            follows = np.r_[tuple(out.iloc[0][list(keys)]) == key, ids[1:] == ids[:-1]]
            deadlines = np.full(len(starts), NEVER, dtype=np.int64)
            # a block that no block of its key follows or precedes has nothing to hand on; the last one's key may go on in the next frame
            for i in np.flatnonzero(follows | np.r_[follows[1:], True]):
                if not follows[i]:
                    deadline = NEVER
                deadlines[i] = deadline
                s, e = starts[i], ends[i]
                at = s + int(np.searchsorted(entry[s:e], deadline))
                if at < e:
                    deadline = int(leave[at])
            key = tuple(out.iloc[-1][list(keys)])
            out["_deadline"] = deadlines
            yield out

    return run


def _place(keys: Sequence[str], length: int) -> Callable:
    """Windows of whole blocks; the first row of each block is not a point but carries the block's deadline."""
    group = [*keys, "_block"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            marks = pdf["_mark"].to_numpy()
            deadlines = pdf["_t"].to_numpy()[marks]
            pdf = pdf[~marks]
            g, t, offset, axis, nxt = _jumps(pdf, group, length)
            n = len(t)
            starts = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            width = offset.max() + length + 1
            begin = np.clip(deadlines - (t[starts] - offset[starts]), 0, width - 1)
            current = np.searchsorted(axis, g[starts] * width + begin)
            ends = np.r_[starts[1:], n]
            current = current[current < ends]
            opened = np.zeros(n, dtype=bool)
            while len(current):
                opened[current] = True
                current = nxt[current]
                current = current[current >= 0]
            source = np.maximum.accumulate(np.where(opened, np.arange(n), -1))
            own = (source >= 0) & (g[source] == g)
            out = pdf[[*keys, "_x", "_n"]].copy()
            out["_anchor"] = np.where(own, t[source], deadlines[g] - length)
            yield out.groupby([*keys, "_anchor"], sort=False, dropna=False, as_index=False)[["_x", "_n"]].sum()

    return run


def block_width(length: int) -> int:
    """Blocks of up to 64 windows, as long as such a block has no more than eight million ticks."""
    return max(4, min(64, 8_000_000 // length)) * length


def anchored_windows(df: DataFrame, keys: Sequence[str], t: str, length: int, value: Column, width: int | None = None) -> DataFrame:
    """(keys, anchor, fire_at, total, n) for windows [anchor, anchor + length) on an integer time column.

    Rows of one tick of the time column are summed first, so whatever the number of rows, a key has at most one point per
    tick and a block at most `width` points. Choose the tick to suit the window: milliseconds for seconds, seconds
    for days. `value` must be an integer; keys must not be null.
    """
    keys = list(keys)
    wide = max(width or block_width(length), length)
    points = (
        df.groupBy(*keys, F.col(t).cast("long").alias("_t"))
        .agg(F.sum(value).cast("long").alias("_x"), F.count(F.lit(1)).alias("_n"))
        .withColumn("_block", block_start(F.col("_t"), wide))
    )
    key_fields = [df.schema[k] for k in keys]
    long = T.LongType()

    def schema(*names: str) -> T.StructType:
        return T.StructType([*key_fields, *[T.StructField(n, long) for n in names]])

    group = [*keys, "_block"]
    steps = _per_group(points.select(*group, "_t"), group, group, ["_t"], _steps(keys, length), schema("_block", "_entry", "_exit"))
    entries = _per_group(steps, keys, group, ["_block", "_entry"], _chain(keys), schema("_block", "_deadline"))
    marks = entries.select(
        *group, F.col("_deadline").alias("_t"), F.lit(0).cast("long").alias("_x"), F.lit(0).cast("long").alias("_n"), F.lit(True).alias("_mark")
    )
    marked = points.withColumn("_mark", F.lit(False)).unionByName(marks)
    placed = _per_group(marked, group, group, [F.desc("_mark"), "_t"], _place(keys, length), schema("_anchor", "_x", "_n"))
    return (
        placed.groupBy(*keys, F.col("_anchor").alias("anchor"))
        .agg(F.sum("_x").alias("total"), F.sum("_n").alias("n"))
        .withColumn("fire_at", F.col("anchor") + length)
    )
