"""Part files rolled by size, age and inactivity over micro-batches, with repeated batches and restarts."""

from __future__ import annotations

import os

import pyarrow as pa
import pytest

from eddyline.sinks import rolling


def texts(*lines):
    return iter([pa.record_batch({"value": list(lines)})])


@pytest.fixture()
def clock(monkeypatch):
    now = [1000.0]
    monkeypatch.setattr(rolling.time, "time", lambda: now[0])
    return now


def content(spark, path):
    found: dict = {}
    for r in rolling.read(spark, path).collect():
        found.setdefault(r.file, []).append(r.value)
    return sorted("".join(v) for v in found.values())


def states(spark, path):
    return sorted((r.bytes, r.finished) for r in rolling.parts(spark, path).collect())


def test_size_age_and_inactivity(spark, tmp_path, clock):
    path = f"file:{tmp_path}"
    writer = rolling.RollingWriter(path, max_bytes=10, max_age=100, inactive=30)
    writer.commit([writer.written(texts("aaa", "bbb", "ccc"), 0, 0), writer.written(texts("x"), 1, 0)], 0)
    assert content(spark, path) == ["aaabbb", "ccc", "x"] and states(spark, path) == [(2, False), (4, False), (8, True)]
    clock[0] += 20  # task 0 goes on with its part, task 1 has no lines
    message = writer.written(texts("dd"), 0, 1)
    writer.commit([message, writer.written(iter([]), 1, 1)], 1)
    assert content(spark, path) == ["aaabbb", "cccdd", "x"]
    # the batch is repeated: other files, the same lines
    writer.commit([writer.written(texts("dd"), 0, 1), writer.written(iter([]), 1, 1)], 1)
    assert content(spark, path) == ["aaabbb", "cccdd", "x"] and states(spark, path) == [(2, False), (7, False), (8, True)]
    clock[0] += 15  # 35 seconds without a line for the small part, 15 for the other
    writer.commit([writer.written(iter([]), 0, 2)], 2)
    assert states(spark, path) == [(2, True), (7, False), (8, True)]
    clock[0] += 70  # it goes on once more, and is more than 100 seconds old
    writer.commit([writer.written(texts("e"), 0, 3)], 3)
    assert states(spark, path) == [(2, True), (8, True), (9, True)] and content(spark, path) == ["aaabbb", "cccdde", "x"]
    writer.commit([writer.written(texts("f"), 0, 4)], 4)
    assert states(spark, path) == [(2, False), (2, True), (8, True), (9, True)]


def test_a_line_longer_than_a_part(spark, tmp_path, clock):
    writer = rolling.RollingWriter(str(tmp_path), 5, 100, 100)
    writer.commit([writer.written(texts("a", "long line", "b", None), 0, 0)], 0)
    assert states(spark, str(tmp_path)) == [(2, True), (3, False), (10, True)]


def test_stream_over_a_restart(spark, tmp_path):
    rolling.register(spark)
    source = tmp_path / "in"
    source.mkdir()
    want = []
    for run in range(3):
        lines = [f"line {run}-{i}" for i in range(50)]
        want += lines
        (source / f"{run}.txt").write_text("\n".join(lines))
        os.utime(source / f"{run}.txt", (1_700_000_000 + run,) * 2)
        stream = spark.readStream.schema("value string").text(str(source))
        writer = stream.writeStream.format("rolling_text").option("path", f"file://{tmp_path}/out").option("maxBytes", 200)
        writer.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    got = rolling.read(spark, f"file://{tmp_path}/out").collect()
    assert sorted(r.value for r in got) == sorted(want)
    found = rolling.parts(spark, f"file://{tmp_path}/out").collect()
    assert all(r.bytes <= 200 for r in found) and sum(not r.finished for r in found) == 1
