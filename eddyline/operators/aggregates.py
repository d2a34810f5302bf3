"""Keyed aggregates. Each is one partial + final aggregation unless noted."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.operators.blocks import Width, running
from eddyline.operators.scans import Columns, Monoid


def min_field(df: DataFrame, key: str, field: str, order: str, companions: Sequence[str]) -> DataFrame:
    """Smallest field per key; the companion columns come from the key's first row."""
    return df.groupBy(key).agg(F.min(field).alias(field), *[F.min_by(c, order).alias(c) for c in companions])


def max_field(df: DataFrame, key: str, field: str, order: str, companions: Sequence[str]) -> DataFrame:
    """Largest field per key; the companion columns come from the key's first row."""
    return df.groupBy(key).agg(F.max(field).alias(field), *[F.min_by(c, order).alias(c) for c in companions])


def min_row(df: DataFrame, key: str, field: str, order: str) -> DataFrame:
    """The whole row with the smallest field per key; the earliest row wins ties."""
    row = F.struct(*df.columns)
    return df.groupBy(key).agg(F.min_by(row, F.struct(field, order)).alias("_row")).select("_row.*")


def max_row(df: DataFrame, key: str, field: str, order: str) -> DataFrame:
    """The whole row with the largest field per key; the earliest row wins ties."""
    row = F.struct(*df.columns)
    best = F.max_by(row, F.struct(F.col(field), -F.col(order)))
    return df.groupBy(key).agg(best.alias("_row")).select("_row.*")


def running_sum(df: DataFrame, key: str, order: str, value: Column, width: Width, out: str = "total") -> DataFrame:
    """One updated sum per input row, the batch form of a keyed running aggregate."""
    return running(df, [key], [order], {out: ("sum", value)}, width)


def running_average(df: DataFrame, key: str, order: str, value: Column, width: Width, out: str = "average") -> DataFrame:
    sums = {"_sum": ("sum", value), "_n": ("sum", value.isNotNull().cast("long"))}
    return running(df, [key], [order], sums, width).withColumn(out, F.col("_sum") / F.col("_n")).drop("_sum", "_n")


def nested_totals(df: DataFrame, outer: str, inner: str, value: str, out: str = "total") -> DataFrame:
    """Outer key -> inner key -> total, one row per pair so that a hot outer key stays spread out."""
    return df.groupBy(outer, inner).agg(F.sum(value).alias(out))


def as_maps(pairs: DataFrame, outer: str, inner: str, value: str, out: str = "totals") -> DataFrame:
    """Render pair rows as one map per outer key; only for keys known to have few inner keys."""
    entries = F.sort_array(F.collect_list(F.struct(inner, value)))
    return pairs.groupBy(outer).agg(F.map_from_entries(entries).alias(out))


def call_summary() -> Monoid:
    """For `scans.reduce_by_key`, from rows (seq, sid, duration): the sum of durations, the longest call (the earliest of several) and the last two callers.

    A reduce that depends on the rows' order and keeps parts of whole rows, which no single built-in aggregate does.
    """

    def lift(rows: Columns) -> Columns:
        n = len(rows["seq"])
        return {"total": rows["duration"], "longest_seq": rows["seq"], "longest": rows["duration"], "last_but_one": np.full(n, None, object), "last": rows["sid"].astype(object)}

    def combine(first: Columns, then: Columns) -> Columns:
        later = then["longest"] > first["longest"]
        alone = then["last_but_one"] == None  # noqa: E711  (elementwise)
        return {
            "total": first["total"] + then["total"],
            "longest_seq": np.where(later, then["longest_seq"], first["longest_seq"]),
            "longest": np.where(later, then["longest"], first["longest"]),
            "last_but_one": np.where(alone, first["last"], then["last_but_one"]),
            "last": then["last"],
        }

    return Monoid("total bigint, longest_seq bigint, longest bigint, last_but_one string, last string", lift, combine)
