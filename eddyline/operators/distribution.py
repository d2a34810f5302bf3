"""Explicit data distribution. Needed rarely: Spark inserts the exchanges its operators require."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_key(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return df.repartition(n, *keys)


def shuffled(df: DataFrame, n: int, unique: str, seed: int = 0) -> DataFrame:
    """Pseudo-random placement by a seeded hash of a unique column, so a recomputed task places rows the same way."""
    return df.repartitionById(n, F.pmod(F.xxhash64(F.col(unique), F.lit(seed)), F.lit(n)).cast("int"))


def rebalanced(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def rescaled(df: DataFrame, n: int, grow: bool) -> DataFrame:
    """More partitions round robin (`grow`), or fewer partitions without a shuffle."""
    return df.repartition(n) if grow else df.coalesce(n)


def gathered(aggregated: DataFrame) -> DataFrame:
    """All rows in one task; only for the result of an aggregation with a known small number of groups."""
    return aggregated.coalesce(1)


def by_partitioner(df: DataFrame, n: int, number: Column) -> DataFrame:
    """A user partitioner: rows go to partition pmod(number, n)."""
    return df.repartitionById(n, F.pmod(number, F.lit(n)).cast("int"))


def placement(df: DataFrame) -> DataFrame:
    """Add the partition each row is in."""
    return df.withColumn("partition", F.spark_partition_id())
