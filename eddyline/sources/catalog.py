"""Catalog tables as sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eddyline.sources.files import Source


def define(spark: SparkSession, name: str, source: Source) -> None:
    """Store a source definition in the catalog, so that later programs read it by name."""
    options = ", ".join(f"'{k}' '{v}'" for k, v in source.options.items())
    spark.sql(
        f"CREATE TABLE {name} ({source.schema}) USING {source.format}"
        + (f" OPTIONS ({options})" if options else "")
        + (f" LOCATION '{source.path}'" if source.path else "")
    )


def read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_stream(spark: SparkSession, name: str) -> DataFrame:
    return spark.readStream.table(name)


def new_partitions(spark: SparkSession, path: str, schema: StructType, partition: str, start: str | int) -> DataFrame:
    """Follow a partitioned table: rows of partitions from `start` on, including ones added later."""
    return spark.readStream.schema(schema).parquet(path).where(F.col(partition) >= start)


def describe(df: DataFrame) -> DataFrame:
    """Column names and types of a table as rows."""
    df.createOrReplaceTempView("described")
    return df.sparkSession.sql("DESCRIBE described").select("col_name", "data_type")
