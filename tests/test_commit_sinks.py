"""Partitions committed while a stream runs, and files of exactly n rows, batch by batch, over replays and restarts."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest

from compare import rows
from eddyline.sinks.buffered import BufferedFiles
from eddyline.sinks.partitions import PartitionCommit

SCHEMA = "seq long, ts timestamp, duration long"
START = datetime(2024, 3, 1)


@pytest.fixture()
def sink(spark, tmp_path):
    name = "committed_by_time"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    schema = spark.createDataFrame([], SCHEMA).schema
    yield PartitionCommit(spark, name, str(tmp_path), schema, "ts", "UTC", 900, 60, 1)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def batch(spark, *minutes):
    return spark.createDataFrame([(i, START + timedelta(minutes=m), m) for i, m in enumerate(minutes)], SCHEMA)


def part(hour, minute):
    return f"dt=20240301/hr={hour:02}/mm={minute:02}/ss=00"


def listed(spark):
    return sorted(r.partition for r in spark.sql("SHOW PARTITIONS committed_by_time").collect())


def test_partitions_are_committed_as_the_watermark_passes(spark, sink):
    """A quarter of an hour is complete when the latest row is 61 seconds behind its end; marker and catalog agree after every batch."""
    steps = [
        ((1, 14), []),
        ((16, 3), []),  # the latest row is 61 seconds behind 00:15 only at 00:16:01
        ((17,), [part(0, 0)]),
        ((29, 30), [part(0, 0)]),
        ((47, 33), [part(0, 0), part(0, 15), part(0, 30)]),
    ]
    for n, (minutes, want) in enumerate(steps):
        sink(batch(spark, *minutes), n)
        assert sink.marked() == want == listed(spark)
        # a batch that is replayed after a crash changes nothing
        before = rows(sink.read())
        sink(batch(spark, *minutes), n)
        assert sink.marked() == want == listed(spark) and rows(sink.read()) == before
    assert sorted(r.duration for r in sink.read().collect()) == [1, 3, 14, 16, 17, 29, 30, 33]


def test_a_late_row_commits_its_partition_again(spark, sink):
    sink(batch(spark, 1, 40), 0)
    assert sink.marked() == [part(0, 0)]
    sink(batch(spark, 2, 41), 1)
    assert sorted(r.duration for r in sink.read().collect()) == [1, 2] and listed(spark) == [part(0, 0)]


def test_a_partition_without_marker_is_not_read(spark, sink):
    sink(batch(spark, 1, 20, 40), 0)
    assert sink.marked() == [part(0, 0), part(0, 15)]
    os.remove(f"{sink.path}/table/{part(0, 0)}/_SUCCESS")
    assert [r.duration for r in sink.read().collect()] == [20]


def test_files_of_three_from_batches_of_four(spark, tmp_path):
    """Two batches of four, a restart, and two more rows: three full files, one row waits."""
    schema = spark.createDataFrame([], "k long, v string").schema
    source = tmp_path / "in"
    source.mkdir()

    def arrive(i, values):
        spark.createDataFrame([(0, v) for v in values], schema).coalesce(1).write.parquet(f"{tmp_path}/made-{i}")
        file = next(f for f in os.listdir(f"{tmp_path}/made-{i}") if f.endswith(".parquet"))
        os.rename(f"{tmp_path}/made-{i}/{file}", source / f"{i}.parquet")
        os.utime(source / f"{i}.parquet", (1_700_000_000 + 10 * i,) * 2)

    def sink():
        return BufferedFiles(spark, f"{tmp_path}/run", schema, "k", 2, 3)

    def files():
        found: dict = {}
        for r in sink().read().collect():
            found.setdefault(r.file, []).append(r.v)
        return {k: "".join(sorted(v)) for k, v in found.items()}

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(source))

    arrive(0, "abcd"), arrive(1, "efgh")
    sink().start(stream()).awaitTermination()
    assert files() == {0: "abc", 1: "def"} and sorted(r.v for r in sink().waiting().collect()) == ["g", "h"]
    arrive(2, "ij")
    sink().start(stream()).awaitTermination()
    assert files() == {0: "abc", 1: "def", 2: "ghi"} and [r.v for r in sink().waiting().collect()] == ["j"]
