"""Shape of the physical plans: what is read, how it is joined, and how large a block of a hot key can get."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from eddyline.operators import blocks, joins, overs
from eddyline.plans import inputs

QUERIES = entry.queries()
LAZY = [
    "agg_sum_keyed", "agg_running_sum", "agg_min_by", "over_range_time", "over_rows", "topn_row_number", "topn_window",
    "win_tumble_keyed", "win_slide_keyed", "win_session_keyed", "win_count_keyed", "win_count_all", "win_cumulate_sql", "win_evict_delta",
    "late_drop", "wm_periodic_custom", "join_full_outer", "join_interval_closed", "join_window_inner", "join_window_full",
    "join_window_semi", "join_window_anti", "join_window_cogroup", "join_lookup", "join_lookup_two_roles", "join_temporal_function",
    "join_order_pay_timeout", "state_value_gap", "state_map_running", "cl_materialize", "cl_emit_all", "cdc_apply",
    "cep_three_fails", "cep_followed_by", "cep_followed_by_any", "cep_timeout_side", "mr_within", "set_intersect_all", "set_minus",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_join(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["join_interval_closed", "join_window_inner", "join_temporal_function", "filter_and_agg", "in_list"])
def test_filters_reach_the_scan(spark, sf, name):
    text = plan(QUERIES[name](spark, sf))
    assert "PushedFilters: [In(" in text or "EqualTo(" in text


@pytest.mark.parametrize(
    ("name", "unused"), [("agg_sum_keyed", "props"), ("topn_row_number", "event_type"), ("agg_running_sum", "props"), ("cep_next", "value")]
)
def test_unused_columns_are_not_read(spark, sf, name, unused):
    schemas = [line.split("ReadSchema:")[1] for line in plan(QUERIES[name](spark, sf)).splitlines() if "ReadSchema:" in line]
    assert schemas and not any(unused in s for s in schemas)


def test_top_n_is_cut_before_the_shuffle(spark, sf):
    text = plan(QUERIES["topn_row_number"](spark, sf))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_joins_without_size_check_are_shuffled(spark, sf):
    """No join asks for a broadcast itself: with the size limit at zero every join is a shuffle join."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("join_lookup_two_roles", "join_broadcast_state", "join_broadcast_map", "join_interval_closed"):
            assert "Broadcast" not in plan(QUERIES[name](spark, sf))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has one key."""
    rows = spark.range(30_000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997))
    return rows.select(F.col("id").alias("seq"), "k", (F.col("id") * 10).alias("t"), (F.col("id") % 7).alias("x")).cache()


def test_blocks_of_a_hot_key_are_bounded(spark, skewed):
    for position in ("seq", "t"):
        width = blocks.auto_width(skewed, position, target_rows=1000)
        sizes = skewed.groupBy("k", blocks.block_start(F.col(position), width).alias("b")).count()
        assert sizes.agg(F.max("count")).first()[0] <= 1000
        assert skewed.where("k = 0").count() > 10_000


@pytest.mark.parametrize("shape", ["even", "outlier", "burst", "gaps"])
def test_quantile_blocks_hold_for_uneven_positions(spark, skewed, monkeypatch, shape):
    monkeypatch.setattr(blocks, "HOT_ROWS", 1000)
    place = {
        "even": F.col("seq"),
        "outlier": F.when(F.col("seq") == 0, 0).otherwise(F.col("seq") + 10**12),
        "burst": F.when(F.col("seq") % 10 == 0, F.col("seq") * 10**6).otherwise(15_000 * 10**6 + F.col("seq")),
        "gaps": F.col("seq") + F.floor(F.col("seq") / 100) * 10**7,
    }[shape]
    rows = skewed.select("k", place.cast("long").alias("p"))
    sizes = blocks.blocked(rows, ["k"], "p", None).where("k = 0").groupBy("_block").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert sizes[0] <= 2000 and sizes[1] >= 7
    whole = blocks.blocked(rows.select("p"), [], "p", None).groupBy("_block").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert whole[0] <= 2000 and whole[1] >= 15


def test_only_hot_keys_are_cut(skewed, monkeypatch):
    monkeypatch.setattr(blocks, "HOT_ROWS", 5000)
    cut = blocks.blocked(skewed, ["k"], "seq", 1000).groupBy("k").agg(F.count_distinct("_block").alias("n")).where("n > 1")
    assert [r.k for r in cut.collect()] == [0]


def test_hot_key_results_do_not_depend_on_blocks(spark, skewed, monkeypatch):
    def digest(df):
        return df.agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()[0]

    def results(width):
        sums = {"s": ("sum", F.col("x")), "m": ("max", F.col("x")), "l": ("last", F.when(F.col("x") == 3, F.col("seq")))}
        yield digest(blocks.running(skewed, ["k"], ["seq"], sums, width))
        yield digest(blocks.running(skewed, ["k"], ["seq"], sums, width, exclusive=True, reverse=True))
        yield digest(overs.over_rows(skewed, ["k"], ["seq"], 3, ["x"], width, s=F.sum("x")))
        frame = digest(overs.over_time_range(skewed, ["k"], "t", 500, width, s=F.sum("x")))
        assert frame == digest(overs.sums_over_time_range(skewed, ["k"], "t", 500, width, s=F.col("x")))
        yield frame
        facts = skewed.where("x = 1").select("k", "t", "seq")
        versions = skewed.where("x = 2").select("k", "t", F.col("seq").alias("v"))
        yield digest(joins.as_of(facts, versions, ["k"], "t", ["v"], width, tie="v"))

    whole = list(results(1_000_000))
    for hot in (0, 5000):
        monkeypatch.setattr(blocks, "HOT_ROWS", hot)
        assert list(results(blocks.auto_width(skewed, "seq", target_rows=500))) == whole
        assert list(results(37)) == whole
    monkeypatch.setattr(blocks, "HOT_ROWS", 500)
    assert list(results(None)) == whole


def test_empty_input(spark, sf):
    nothing = inputs.calls(spark, sf).where("seq < 0")
    out = blocks.running(nothing, ["sid"], ["seq"], {"s": ("sum", F.col("duration"))}, blocks.auto_width(nothing, "seq"))
    assert out.count() == 0
