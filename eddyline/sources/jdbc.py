"""JDBC source. The scan is split by ranges of a numeric column; without one it would be a single task."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTable:
    url: str
    table: str
    partition_column: str
    lower: int
    upper: int
    partitions: int
    fetch_size: int = 10_000

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": self.table,
            "partitionColumn": self.partition_column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
            "fetchsize": str(self.fetch_size),
        }

    def read(self, spark: SparkSession, **connection: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options(), **connection).load()
