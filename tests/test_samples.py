"""Small inputs with answers worked out by hand."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from compare import rows
from eddyline.functions import udfs
from eddyline.operators import blocks
from eddyline.operators import aggregates, changelog, joins, patterns, state, transforms, watermark
from eddyline.sources import catalog, files

@pytest.fixture(autouse=True)
def every_key_is_hot(monkeypatch):
    monkeypatch.setattr(blocks, "HOT_ROWS", 0)


CALLS = "sid string, call_out string, call_in string, call_type string, call_time bigint, duration bigint"


def test_word_count(spark):
    lines = spark.createDataFrame([("tide ebb",), ("tide flow flow",), ("tide ebb",)], "value string")
    assert rows(transforms.word_count(lines, "value")) == [("ebb", 2), ("flow", 2), ("tide", 3)]
    assert rows(transforms.word_count_with_prefix(lines, "value", "f")) == [("flow", 2)]


def test_min_keeps_first_companions_and_min_row_its_own(spark):
    data = [(1, "s1", "a", 50), (2, "s1", "b", 30), (3, "s1", "c", 110), (4, "s1", "d", 30), (5, "s1", "e", 300)]
    df = spark.createDataFrame(data, "seq long, sid string, call_out string, duration long")
    assert rows(aggregates.min_field(df, "sid", "duration", "seq", ["call_out"])) == [("s1", 30, "a")]
    assert rows(aggregates.max_field(df, "sid", "duration", "seq", ["call_out"])) == [("s1", 300, "a")]
    assert rows(aggregates.min_row(df, "sid", "duration", "seq")) == [(2, "s1", "b", 30)]
    assert rows(aggregates.max_row(df, "sid", "duration", "seq")) == [(5, "s1", "e", 300)]


def test_running_sum_gives_one_result_per_row(spark):
    df = spark.createDataFrame([(0, "a", 1), (1, "b", 2), (2, "c", 3), (3, "a", 4), (4, "b", 5)], "seq long, k string, x long")
    for width in (1, 2, 100):
        out = aggregates.running_sum(df, "k", "seq", F.col("x"), width).orderBy("seq")
        assert [(r.k, r.total) for r in out.collect()] == [("a", 1), ("b", 2), ("c", 3), ("a", 5), ("b", 7)]


def test_nested_totals_as_maps(spark):
    data = [("186", "187", 10), ("186", "188", 20), ("187", "186", 60), ("186", "188", 10), ("189", "187", 50)]
    df = spark.createDataFrame(data, "caller string, callee string, x long")
    maps = aggregates.as_maps(aggregates.nested_totals(df, "caller", "callee", "x"), "caller", "callee", "total")
    assert {r.caller: r.totals for r in maps.collect()} == {
        "186": {"187": 10, "188": 30}, "187": {"186": 60}, "189": {"187": 50}
    }


def test_gap_to_previous(spark):
    df = spark.createDataFrame([(0, "186", 1000), (1, "187", 1000), (2, "186", 3000), (3, "187", 3000)], "seq long, k string, t long")
    for width in (1, 10):
        out = state.gap_to_previous(df, "k", "seq", "t", width).where("gap is not null")
        assert rows(out, "k", "gap") == [("186", 2000), ("187", 2000)]


def test_countdown(spark):
    df = spark.createDataFrame([(3,), (0,), (-2,)], "n long")
    assert rows(transforms.countdown(df, "n"), "n", "x") == [(-2, -2), (0, 0), (3, 1), (3, 2), (3, 3)]
    assert rows(transforms.countdown_exit(df, "n"), "n", "x") == [(-2, -2), (0, 0), (3, 0)]


def test_irregular_change_log(spark):
    log = [(0, "+I", "reef", 4), (1, "+I", "shoal", 9), (2, "+I", "cove", 6), (3, "+U", "cove", 7), (4, "-D", "shoal", 9), (5, "+I", "reef", 4)]
    df = spark.createDataFrame(log, "seq long, row_kind string, name string, age int")
    assert rows(changelog.materialize(df, ["name"], "seq"), "name", "age") == [("cove", 7), ("reef", 4)]


def test_apply_envelopes(spark):
    messages = [
        (0, '{"before":null,"after":{"id":1,"name":"reef","age":4},"op":"c","ts_ms":1}'),
        (1, '{"before":null,"after":{"id":2,"name":"shoal","age":9},"op":"r","ts_ms":2}'),
        (2, '{"before":{"id":2,"name":"shoal","age":9},"after":{"id":2,"name":"sandbar","age":10},"op":"u","ts_ms":3}'),
        (3, '{"before":{"id":1,"name":"reef","age":4},"after":null,"op":"d","ts_ms":4}'),
    ]
    row = spark.createDataFrame([], "id int, name string, age int").schema
    df = spark.createDataFrame(messages, "seq long, value string")
    out = changelog.apply_envelopes(changelog.read_envelopes(df, "value", row), "id", "seq")
    assert rows(out, "id", "name", "age") == [(2, "sandbar", 10)]


def test_watermark_trace(spark):
    """Bounded disorder of 2000: 5999 after the row at 8000, 11999 after the row at 14000."""
    df = spark.createDataFrame([(0, 1000), (1, 8000), (2, 5000), (3, 14000)], "seq long, t long")
    for width in (1, 3, 100):
        after = watermark.with_watermark(df, ["seq"], "t", 2000, width, before=False).orderBy("seq")
        assert [r.wm for r in after.collect()] == [-1001, 5999, 5999, 11999]
        before = watermark.with_watermark(df, ["seq"], "t", 2000, width).orderBy("seq")
        assert [r.wm for r in before.collect()] == [None, -1001, 5999, 5999]


def test_late_classes(spark):
    """Window [0, 5000) closes at watermark 4999 and is gone at 6999; before rows 2, 4, 6 it is 4499, 6499, 17999."""
    df = spark.createDataFrame([(0, 1000), (1, 6500), (2, 4000), (3, 8500), (4, 4500), (5, 20000), (6, 4600)], "seq long, t long")
    wm = watermark.with_watermark(df, ["seq"], "t", 2000, 2)
    kinds = {r.seq: r.arrival for r in watermark.classify_late(wm, "t", 5000, 2000).collect()}
    assert kinds == {0: "on_time", 1: "on_time", 2: "on_time", 3: "on_time", 4: "late_ok", 5: "on_time", 6: "dropped"}


def test_enrichment_of_both_roles(spark):
    people = spark.createDataFrame([("51", "reef"), ("52", "shoal")], "phone string, name string")
    df = spark.createDataFrame([("51", "52"), ("52", "60")], "call_out string, call_in string")
    out = joins.lookup_roles(df, people, "phone", {"caller": ("call_out", "name"), "callee": ("call_in", "name")})
    assert rows(out, "caller", "callee") == [("reef", "shoal"), ("shoal", "")]


def test_interval_ends(spark):
    left = spark.createDataFrame([("a", 0, 10)], "k string, ls long, lt long")
    right = spark.createDataFrame([("a", i, t) for i, t in enumerate([7, 8, 9, 12, 13])], "k string, rs long, rt long")
    closed = joins.interval(left, right, ["k"], "lt", "rt", -2, 2)
    assert rows(closed, "rt") == [(12,), (8,), (9,)]
    half = joins.interval(left, right, ["k"], "lt", "rt", -2, 2, upper_inclusive=False)
    assert rows(half, "rt") == [(12,), (9,)]


def test_version_at_the_same_instant_is_valid(spark):
    facts = spark.createDataFrame([("p1", 5, 0), ("p1", 10, 1), ("p1", 1, 2)], "k string, t long, f long")
    versions = spark.createDataFrame([("p1", 5, 0, 1.0), ("p1", 8, 1, 2.0)], "k string, t long, v long, price double")
    for width in (1, 4, 100):
        out = joins.as_of(facts, versions, ["k"], "t", ["price"], width, tie="v")
        assert rows(out, "f", "price") == [(0, 1.0), (1, 2.0)]


def test_sequence_matches_overlap(spark):
    kinds = ["f", "f", "f", "f", "s", "f"]
    df = spark.createDataFrame([("u", i, i * 10, k) for i, k in enumerate(kinds)], "k string, seq long, t long, c string")
    for width in (1, 2, 100):
        out = patterns.strict_sequence(df, "k", "seq", [F.col("c") == "f"] * 3, {"a": (0, "t"), "b": (2, "t")}, width)
        assert rows(out, "a", "b") == [(0, 20), (10, 30)]


def test_user_functions(spark):
    df = spark.createDataFrame([("a|bb", 1, 4), ("c", 2, None)], "s string, i int, x long")
    assert rows(udfs.split_bar(df, "s"), "word", "length") == [("a", 1), ("bb", 2), ("c", 1)]
    assert rows(df.select(udfs.concat_bar(F.col("i"), F.col("x")).alias("c"))) == [("1|4",), (None,)]
    assert rows(df.agg(udfs.average("x"), udfs.integer_average("x"))) == [(4.0, 4)]
    udfs.register_sql_functions(spark)
    df.createOrReplaceTempView("udf_input")
    assert rows(spark.sql("SELECT concat_bar3(s, i, 'z') FROM udf_input WHERE i = 2")) == [("c|2|z",)]
    assert rows(spark.sql("SELECT w.word, w.length FROM udf_input, LATERAL split_bar(s) w")) == [("a", 1), ("bb", 2), ("c", 1)]


def test_parse_collection_and_describe(spark):
    lines = files.from_rows(spark, [(" s1 , 186,187,busy,1000, 10",)], "value string")
    calls = files.parse_calls(lines)
    assert rows(calls) == [("s1", "186", "187", "busy", 1000, 10)]
    assert rows(catalog.describe(calls))[0] == ("call_in", "string")


def test_side_outputs(spark):
    df = spark.createDataFrame([("success",), ("fail",)], "c string")
    _, out = transforms.split_outputs(df, {"main": F.col("c") == "success", "other": F.lit(True)})
    assert rows(out["main"]) == [("success",)] and rows(out["other"]) == [("fail",)]


def test_integer_average_cuts_towards_zero(spark):
    df = spark.createDataFrame([("a", -3), ("a", -4), ("b", 2**60 + 1), ("c", None)], "k string, x long")
    assert rows(df.groupBy("k").agg(udfs.integer_average("x").alias("v"))) == [("a", -3), ("b", 2**60 + 1), ("c", None)]


def test_lines_keep_nulls_and_bad_numbers_in_place(spark):
    schema = "sid string, call_out string, call_in string, call_type string, call_time bigint, duration bigint"
    df = spark.createDataFrame([("s1", None, "52", "fail", 7, None), (None, "51", None, None, None, 3)], schema)
    assert rows(files.parse_calls(files.call_lines(df))) == rows(df)
    lines = spark.createDataFrame([("a,b,c,d,1,2",), ("a,b",), ("a,b,c,d,x,2",), ("a,b,c,d,,2",), (None,)], "value string")
    assert rows(files.bad_lines(lines)) == [("a,b",), ("a,b,c,d,x,2",), (None,)] and files.parse_calls(lines).count() == 5


def test_interval_joins_that_would_repeat_rows_are_refused(spark):
    one = spark.createDataFrame([("a", 1)], "k string, t long")
    for how in ("full", "right"):
        with pytest.raises(ValueError):
            joins.interval(one, one.withColumnRenamed("t", "u"), ["k"], "t", "u", -2, 2, how)
