"""Tables of a few million rows are cut at the size the operators have by themselves: no task gets all rows of a query without keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401  (registers the queries)
from eddyline.operators import blocks, windows
from eddyline.plans import catalog

ROWS = 3_000_000
LARGEST = 2_000_000  # rows of a block: sampled edges keep it within twice the aim


@pytest.fixture(scope="module")
def many_events(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("events"))
    noise = F.pmod(F.xxhash64("id"), F.lit(100_000))
    spark.range(ROWS).select(
        F.col("id").alias("event_id"),
        F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 2_000_000 + noise).cast("timestamp_ntz").alias("ts"),
        F.pmod(noise, F.lit(1500)).alias("user_id"),
        F.lit("view").alias("event_type"),
        (noise / 1000).alias("value"),
        F.lit('{"k": 1}').alias("props"),
    ).write.parquet(f"{path}/events.parquet")
    return path


@pytest.mark.parametrize("name", ["win_evict_late", "late_allowed", "late_drop", "win_global_count_all", "win_session_all", "win_count_all", "late_side_output", "wm_punctuated_custom"])
def test_no_block_holds_the_whole_table(spark, many_events, monkeypatch, name):
    sizes = []
    plain = blocks.cut_into_blocks

    def cut(*args):
        out, split = plain(*args)
        sizes.append([r["count"] for r in out.groupBy(blocks.BLOCK).count().collect()])
        return out, split

    monkeypatch.setattr(blocks, "cut_into_blocks", cut)
    monkeypatch.setattr(windows, "cut_into_blocks", cut)
    catalog.QUERIES[name](spark, many_events)
    assert sizes and sum(sizes[0]) == ROWS and max(sizes[0]) <= LARGEST
