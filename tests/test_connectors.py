"""The user-defined source and sink on URIs, in byte ranges, with filters taken over, and as streams."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from compare import rows
from eddyline.sinks import custom as sink
from eddyline.sources import custom as source
from eddyline.streaming import run

KINDS = ["fail", "success", "busy", "überlast"]


def call(i):
    rnd = random.Random(i)
    return f"sid_{i},{rnd.randrange(10**rnd.randrange(1, 9))},x,{rnd.choice(KINDS)},{1000 + i},{rnd.randrange(50)}\n"


@pytest.fixture()
def folder(spark, tmp_path):
    source.register(spark)
    sink.register(spark)
    (tmp_path / "a.txt").write_text("".join(map(call, range(300))))
    (tmp_path / "b.txt").write_text("".join(map(call, range(300, 310))).rstrip("\n"))
    (tmp_path / "empty.txt").write_text("")
    (tmp_path / "other.csv").write_text("no,call\n")
    return tmp_path


@pytest.mark.parametrize("prefix", ["", "file:", "file://"])
@pytest.mark.parametrize("split", [1 << 20, 997, 64, 1])
def test_ranges_cover_every_line_once(folder, prefix, split):
    uri = f"{prefix}{folder}"
    reader = source.CallLogReader(uri, split)
    parts = reader.partitions()
    got = b"".join(source.lines_of(uri, p) for p in parts)
    assert got.decode() == "".join(map(call, range(309))) + call(309).rstrip("\n")
    assert len(parts) >= 2 and (split > 997 or len(parts) > 5)


def test_one_file_is_read_by_several_tasks(spark, folder):
    df = spark.read.format("call_log").option("splitBytes", 1000).load(f"file://{folder}")
    assert df.rdd.getNumPartitions() > 5 and df.count() == 310 and df.select("sid").distinct().count() == 310


@pytest.mark.parametrize("test", ["call_type = 'fail'", "duration > 20 AND duration <= 40", "call_type IN ('busy', 'überlast') AND call_time < 1100", "startswith(sid, 'sid_1')", "call_type <> 'fail'"])
def test_filters_are_taken_over(spark, folder, test):
    df = spark.read.format("call_log").load(str(folder))
    want = spark.createDataFrame([tuple(call(i).rstrip("\n").split(",")) for i in range(310)], "sid string, call_out string, call_in string, call_type string, call_time string, duration string")
    want = want.withColumns({c: F.col(c).cast("long") for c in ("call_time", "duration")})
    got = df.where(test)
    assert rows(got, "sid", "duration") == rows(want.where(test), "sid", "duration")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert (") Filter " in plan) == ("<>" in test), plan  # what the source takes over is no step of the plan any more


def test_a_stream_goes_on_where_it_stood(spark, folder):
    """A line without an end waits; a file that grows and a new one are read from where the last run ended."""
    out, checkpoint = folder / "rows", str(folder / "checkpoint")

    def go():
        stream = spark.readStream.format("call_log").option("splitBytes", 500).load(f"file:{folder}")
        run.start(stream, run.batch_folders(str(out)), checkpoint).awaitTermination()
        return sorted(r.sid for r in spark.read.parquet(str(out)).collect())

    assert go() == sorted(f"sid_{i}" for i in range(309))
    with open(folder / "b.txt", "a") as f:
        f.write("\n" + call(310))
    (folder / "c.txt").write_text(call(311))
    assert go() == sorted(f"sid_{i}" for i in range(312))


def test_a_stream_into_the_sink(spark, folder):
    target = f"file://{folder}/store"
    stream = spark.readStream.format("call_log").load(str(folder)).select("sid", "call_type")
    for _ in range(2):
        writer = stream.writeStream.format("hash_store").option("path", target).option("checkpointLocation", str(folder / "c")).trigger(availableNow=True)
        writer.start().awaitTermination()
    assert sink.read_committed(spark, target, "sid string, call_type string").count() == 309
    again = sink.HashStreamWriter(target)  # a repeated batch replaces its entry
    stored = [sink.Written(None, 0)]
    again.commit(stored, 0)
    assert sink.read_committed(spark, target, "sid string, call_type string").count() == 0
