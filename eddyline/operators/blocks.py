"""Ordered per-key logic that does not put a whole key into one task.

A window partitioned by the key alone sends every row of that key to one task, which fails as soon as one
key holds a large share of the table. Here the ordered rows of every hot key are cut into blocks of the ordering
column, and windows are partitioned by (key, block); all other keys are one block each.

* `cut_into_blocks` - assigns the blocks, or finds that no key needs them: then all operators below are plain windows, without a second pass. A key with enough rows in a hashed sample is cut at quantiles of the ordering column, so bursts,
  gaps and outliers don't matter: a block holds about `HOT_ROWS` rows. All edges together are at most (rows of the table /
  HOT_ROWS) numbers, so they are broadcast. With an explicit width, keys of more than `HOT_ROWS` rows are cut at its multiples.
* `running` - running aggregates. Of the hot keys, one small row per (key, block) is aggregated first, the block totals are
  accumulated over the blocks of each key, and the total before a block is put in front of its rows as one extra row.
* `with_neighbours` - the n rows before / after each block are copied into it, so that `lag`, `lead` and
  row frames up to n rows are exact.
* `with_time_context` - rows within a time distance of a block edge are copied into the neighbouring block,
  so that range frames up to that distance are exact.

All give exactly the result of the single-window form, for every block width.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.session import cut

BLOCK = "_block"
CONTEXT = "_context"
HOT = "_hot"
HOT_ROWS = 1_000_000  # more rows than one task should sort: a wide row takes about 250 bytes in the sort, the window and the aggregation that follows
EDGE_SAMPLES = 32  # sampled rows per block: block sizes stay within a factor of two
ROW_BYTES = 4  # a row of a table takes at least so many
Width = Column | int | None  # None: quantile edges


def is_small(df: DataFrame) -> bool:
    """Whether `df` is known to have fewer than `HOT_ROWS` rows, so that no key can be hot: by Spark's own estimate of its size, without a job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < HOT_ROWS * ROW_BYTES


def once(df: DataFrame, label: str) -> DataFrame:
    """`df` for another ordered pass: written first if that pass reads it several times."""
    return df if is_small(df) else cut(df, label)


def auto_width(base: DataFrame, position: str, target_rows: int | None = None) -> Column:
    """Block width under which all keys together have about `target_rows` rows per block.

    A lazy scalar subquery over one column of the base table. A block of one key never has more rows than
    the block of the whole table, however skewed the keys are.
    """
    p = F.col(position)
    blocks = F.greatest(F.lit(1), F.floor(F.count(F.lit(1)) / F.lit(target_rows or HOT_ROWS)))
    return base.agg(F.greatest(F.lit(1), F.ceil((F.max(p) - F.min(p) + 1) / blocks)).cast("long")).scalar()


def block_start(position: Column, width: Width) -> Column:
    w = width if isinstance(width, Column) else F.lit(width)
    return (position - F.pmod(position, w)).cast("long")


def quantile_edges(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """(keys, _edges) of the keys that need more than one block: ascending positions at which a new block starts.

    Rows are sampled by a hash of their values, one in HOT_ROWS / EDGE_SAMPLES, so every evaluation draws the same rows;
    each EDGE_SAMPLES-th sampled position is an edge.
    """
    every = max(1, HOT_ROWS // EDGE_SAMPLES)
    plain = [F.col(c) for c, kind in df.dtypes if c in keys or kind in ("bigint", "int", "smallint", "tinyint", "string", "boolean", "date")]
    sampled = df.where(F.pmod(F.xxhash64(*plain), F.lit(every)) == 0).groupBy(*keys).agg(F.sort_array(F.collect_list(F.col(position).cast("long"))).alias("_sample"))
    count = F.size("_sample")
    edges = F.transform(F.sequence(F.lit(EDGE_SAMPLES), F.greatest(count, F.lit(EDGE_SAMPLES)), F.lit(EDGE_SAMPLES)), lambda i: F.get("_sample", i - 1))
    return sampled.where(count >= EDGE_SAMPLES).select(*keys, F.array_distinct(edges).alias("_edges"))


def _edge_below(edges: Column, position: Column) -> Column:
    """The largest edge not above `position`, by bisection; the smallest number before the first edge."""
    zero = F.struct(F.lit(0).alias("low"), F.size(edges).alias("high"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        above = F.get(edges, middle) <= position
        return F.struct(F.when(above, middle + 1).otherwise(acc["low"]).alias("low"), F.when(above, acc["high"]).otherwise(middle).alias("high"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(edges) + F.lit(1))).cast("int"))
    return F.aggregate(steps, zero, halve, lambda acc: F.coalesce(F.get(edges, acc["low"] - 1), F.lit(-(2**63))))


def blocked(df: DataFrame, keys: Sequence[str], position: str, width: Width) -> DataFrame:
    """Add `_block` and `_hot`. Without keys the whole input counts as one hot key."""
    return cut_into_blocks(df, keys, position, width)[0]


def cut_into_blocks(df: DataFrame, keys: Sequence[str], position: str, width: Width) -> tuple[DataFrame, bool]:
    """`df` with `_block` and `_hot`, and whether any key has more than one block.

    The edges are found once and written (at most rows / `HOT_ROWS` numbers), so a pass over the result does not sample again.
    """
    if width is None:
        if is_small(df) or (found := cut(quantile_edges(df, keys, position), "edges")).isEmpty():
            return df.withColumns({BLOCK: F.lit(0).cast("long"), HOT: F.lit(False)}), False
        if not keys:
            marked = df.withColumn("_edges", found.scalar()).withColumn(HOT, F.lit(True))
        else:
            same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
            hot = found.select(*[F.col(k).alias(f"_hot_{k}") for k in keys], "_edges", F.lit(True).alias(HOT))
            marked = df.join(F.broadcast(hot), same, "left").drop(*[f"_hot_{k}" for k in keys])
        block = F.when(F.col(HOT), _edge_below(F.col("_edges"), F.col(position).cast("long"))).otherwise(F.lit(0).cast("long"))
        return marked.withColumn(BLOCK, block).drop("_edges"), True
    start = block_start(F.col(position), width)
    if not keys:
        return df.withColumns({BLOCK: start, HOT: F.lit(True)}), True
    hot = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > HOT_ROWS)
        .select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias(HOT))
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
    marked = df.join(F.broadcast(hot), same, "left").drop(*[f"_hot_{k}" for k in keys])
    return marked.withColumn(BLOCK, F.when(F.col(HOT), start).otherwise(F.lit(0).cast("long"))), True


def block_window(keys: Sequence[str], order: Sequence[str], reverse: bool = False) -> WindowSpec:
    """Window over the rows of one block of one key, in `order` (all descending when `reverse`)."""
    cols = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    return Window.partitionBy(*keys, BLOCK).orderBy(*cols)


def _latest(row: Column, fields: Sequence[str], known: Column, reverse: bool) -> Column:
    """The struct `row` at the largest (smallest when `reverse`) `known`, null if `known` always is.

    Taken field by field: with fixed-width fields and an integer place this stays a hash aggregation, whereas a
    struct in the aggregation buffer would make Spark sort the rows before aggregating them.
    """
    pick, edge = (F.min_by, F.min) if reverse else (F.max_by, F.max)
    return F.when(edge(known).isNotNull(), F.struct(*[pick(row[f], known).alias(f) for f in fields]))


def _fold(kind: str, value: Column, place: Column, reverse: bool, fields: Sequence[str]) -> Column:
    if kind == "sum":
        return F.sum(value)
    if kind == "min":
        return F.min(value)
    if kind == "max":
        return F.max(value)
    if kind == "last":
        known = F.when(value.isNotNull(), place)
        if fields:
            return _latest(value, fields, known, reverse)
        return F.min_by(value, known) if reverse else F.max_by(value, known)
    raise ValueError(f"unknown running aggregate: {kind}")


def _place(order: Sequence[str]) -> Column:
    return F.struct(*order) if len(order) > 1 else F.col(order[0])


def _fields(kind: T.DataType) -> list[str]:
    return kind.names if isinstance(kind, T.StructType) else []


def _over(kind: str, value: Column, window: WindowSpec) -> Column:
    folded = {"sum": F.sum, "min": F.min, "max": F.max}.get(kind)
    return (folded(value) if folded else F.last(value, ignorenulls=True)).over(window)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    outputs: Mapping[str, tuple[str, Column]],
    width: Width,
    exclusive: bool = False,
    reverse: bool = False,
    peers: bool = False,
) -> DataFrame:
    """Add running aggregates of each key's rows in `order`.

    `outputs` maps a new column to ("sum" | "min" | "max" | "last", expression); "last" keeps the latest
    non-null value. `exclusive` leaves the current row out, `reverse` runs from the end towards the start.
    `order[0]` must be an integer column; it also defines the blocks. `peers` includes all rows with the current value of
    `order[0]`, the only order column then.
    """
    kinds = {name: kind for name, (kind, _) in outputs.items()}
    values = {f"_v_{name}": expr for name, (_, expr) in outputs.items()}
    rows, split = cut_into_blocks(df, keys, order[0], width)
    rows = rows.withColumns(values)
    if not split:
        return _in_one_window(rows, keys, order, kinds, exclusive, reverse, peers).drop(BLOCK, HOT, *values)

    # every block of a key needs its entry, also one without a value of its own
    totals = rows.where(HOT).groupBy(*keys, BLOCK).agg(
        *[
            _fold(kind, F.col(f"_v_{n}"), _place(order), reverse, _fields(rows.schema[f"_v_{n}"].dataType)).alias(f"_v_{n}")
            for n, kind in kinds.items()
        ]
    )
    by_block = Window.partitionBy(*keys).orderBy(F.col(BLOCK).desc() if reverse else F.col(BLOCK))
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys, BLOCK, *[_over(kind, F.col(f"_v_{n}"), earlier).alias(f"_v_{n}") for n, kind in kinds.items()]
    ).where(reduce(or_, [F.col(v).isNotNull() for v in values]))

    both = rows.withColumn(CONTEXT, F.lit(False)).unionByName(
        carried.withColumn(CONTEXT, F.lit(True)), allowMissingColumns=True
    )
    inside = Window.partitionBy(*keys, BLOCK).orderBy(
        F.col(CONTEXT).desc(), *[F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    )
    if peers:
        # the extra row sorts as the start of its block, where it belongs to every frame
        both = both.withColumn(order[0], F.coalesce(order[0], BLOCK))
        inside = Window.partitionBy(*keys, BLOCK).orderBy(order[0]).rangeBetween(Window.unboundedPreceding, 0)
    else:
        inside = inside.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    return (
        both.select("*", *[_over(kind, F.col(f"_v_{n}"), inside).alias(n) for n, kind in kinds.items()])
        .where(~F.col(CONTEXT))
        .drop(BLOCK, CONTEXT, HOT, *values)
    )


def _in_one_window(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], kinds: Mapping[str, str], exclusive: bool, reverse: bool, peers: bool
) -> DataFrame:
    inside = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() if reverse else F.col(c).asc() for c in order])
    inside = inside.rangeBetween(Window.unboundedPreceding, 0) if peers else inside.rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    return rows.select("*", *[_over(kind, F.col(f"_v_{n}"), inside).alias(n) for n, kind in kinds.items()])


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    payload: Sequence[str],
    width: Width,
    before: int = 0,
    after: int = 0,
) -> DataFrame:
    """Copy the `before` preceding and `after` following rows of each key into every block.

    Copies carry only `payload` and have `_context` set; compute over `block_window(keys, order)`, then call
    `own_rows`.
    """
    rows, split = cut_into_blocks(df, keys, order[0], width)
    parts = [rows.withColumn(CONTEXT, F.lit(False))]
    if not split:
        return parts[0]
    if before:
        parts.append(_edge_rows(rows, keys, order, payload, before, reverse=False))
    if after:
        parts.append(_edge_rows(rows, keys, order, payload, after, reverse=True))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def _edge_rows(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], payload: Sequence[str], n: int, reverse: bool
) -> DataFrame:
    """For every block, the n rows of the key just outside it (before it, or after it when `reverse`)."""
    names = [c for c in dict.fromkeys([*order, *payload]) if c not in keys]
    slim = rows.where(HOT).select(*keys, BLOCK, *names)
    if n == 1:
        # the outermost row of each block by partial aggregation, without sorting the rows
        edge = slim.groupBy(*keys, BLOCK).agg(F.array(_latest(F.struct(*names), names, _place(order), reverse)).alias("_edge"))
    else:
        outermost = F.row_number().over(block_window(keys, order, reverse=not reverse))
        edge = (
            slim.withColumn("_n", outermost)
            .where(F.col("_n") <= n)
            .groupBy(*keys, BLOCK)
            .agg(F.sort_array(F.collect_list(F.struct("_n", *names))).alias("_edge"))
        )
    by_block = Window.partitionBy(*keys).orderBy(F.col(BLOCK).desc() if reverse else F.col(BLOCK))
    # the nearest block comes last in the frame; putting it first makes the n nearest rows a plain slice
    outside = F.flatten(F.reverse(F.collect_list("_edge").over(by_block.rowsBetween(-n, -1))))
    return (
        edge.select(*keys, BLOCK, outside.alias("_outside"))
        .select(*keys, BLOCK, F.explode(F.slice("_outside", 1, n)).alias("_row"))
        .select(*keys, BLOCK, *[F.col(f"_row.{c}").alias(c) for c in names])
        .withColumn(CONTEXT, F.lit(True))
    )


def with_time_context(
    df: DataFrame, keys: Sequence[str], position: str, width: Width, before: int = 0, after: int = 0
) -> DataFrame:
    """Copy rows into each block that needs them for frames of `before` back and `after` ahead.

    The width is raised to the larger distance, so a row has at most three copies.
    """
    if width is None and is_small(df):
        return df.withColumns({BLOCK: F.lit(0).cast("long"), HOT: F.lit(False), CONTEXT: F.lit(False)})
    if width is None:
        width = auto_width(df, position)
    w = F.greatest(width if isinstance(width, Column) else F.lit(width), F.lit(before), F.lit(after), F.lit(1))
    p = F.col(position)
    rows = blocked(df.withColumn("_w", w.cast("long")), keys, position, F.col("_w"))
    first, last = block_start(p - after, F.col("_w")), block_start(p + before, F.col("_w"))
    needed = F.when(F.col(HOT), F.sequence(first, last, F.col("_w"))).otherwise(F.array(F.col(BLOCK)))
    return (
        rows.withColumn("_own", F.col(BLOCK))
        .withColumn(BLOCK, F.explode(needed))
        .withColumn(CONTEXT, F.col(BLOCK) != F.col("_own"))
        .drop("_w", "_own")
    )


def own_rows(df: DataFrame) -> DataFrame:
    return df.where(~F.col(CONTEXT)).drop(BLOCK, CONTEXT, HOT)
