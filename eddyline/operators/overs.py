"""Over windows, top-n and paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eddyline.operators.blocks import Width, block_window, own_rows, running, with_neighbours, with_time_context


def over_time_range(
    df: DataFrame, keys: Sequence[str], t: str, distance: int, width: Width, **aggs: Column
) -> DataFrame:
    """Aggregates over the rows of the key at most `distance` before the current row, ties included.

    For any aggregate and few rows per frame; sums and counts have `sums_over_time_range`.
    """
    names = list(df.columns)
    w = block_window(keys, [t]).rangeBetween(-distance, 0)
    rows = with_time_context(df, keys, t, width, before=distance)
    return own_rows(rows.select("*", *[a.over(w).alias(n) for n, a in aggs.items()])).select(*names, *aggs)


def sums_over_time_range(df: DataFrame, keys: Sequence[str], t: str, distance: int, width: Width, **values: Column) -> DataFrame:
    """Sums over the rows of the key at most `distance` before the current row, ties included.

    A sliding frame adds its rows up again for every row, which is quadratic where rows are dense. Here each row
    adds its value at its time and takes it away after `distance`, so a running sum is the sliding sum. Values
    must be integers (or decimals) to come out exact.
    """
    rows = df.withColumns({f"_d_{n}": F.coalesce(v, F.lit(0)) for n, v in values.items()})
    gone = rows.select(*keys, (F.col(t) + distance + 1).alias(t), *[(-F.col(f"_d_{n}")).alias(f"_d_{n}") for n in values])
    events = rows.withColumn("_row", F.lit(True)).unionByName(gone.withColumn("_row", F.lit(False)), allowMissingColumns=True)
    sums = running(events, keys, [t], {n: ("sum", F.col(f"_d_{n}")) for n in values}, width, peers=True)
    return sums.where("_row").select(*df.columns, *values)


def over_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], before: int, payload: Sequence[str], width: Width, **aggs: Column
) -> DataFrame:
    """Aggregates over the current row and the `before` rows of the key in front of it."""
    names = list(df.columns)
    w = block_window(keys, order).rowsBetween(-before, 0)
    rows = with_neighbours(df, keys, order, payload, width, before=before)
    return own_rows(rows.select("*", *[a.over(w).alias(n) for n, a in aggs.items()])).select(*names, *aggs)


def top_n(df: DataFrame, keys: Sequence[str], n: int, *order: Column, rank: str = "rank") -> DataFrame:
    """First n rows per key. Spark cuts each map partition to n rows per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def page(df: DataFrame, offset: int, fetch: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(fetch)
