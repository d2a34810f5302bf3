"""User aggregates, table aggregates and table functions against built-in ones."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from compare import rows
from eddyline.functions import user


@pytest.fixture(params=[10_000, 7], ids=["large batches", "small batches"])
def values(spark, request, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    rnd = random.Random(1)
    data = [(rnd.choice(["hot", "hot", "a", None, "b", "only null"]), rnd.choice([1, 2]), rnd.choice([None, -7, 3, 3, 10, 2**40])) for _ in range(500)]
    data = [(k, g, None if k == "only null" else x) for k, g, x in data]
    yield spark.createDataFrame(data, "k string, g int, x long").repartition(6)
    spark.conf.set(name, before)


@pytest.mark.parametrize("keys", [["k"], ["k", "g"], []])
def test_average(values, keys):
    got = user.aggregate(values, keys, user.Average("x"), ["x"])
    want = values.groupBy(*keys).agg(F.avg("x").alias("average"), F.expr("sum(x) div nullif(count(x), 0)").alias("int_average"))
    assert rows(got) == rows(want)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_largest(values, n):
    got = user.aggregate(values, ["k", "g"], user.Largest("x", n), ["x"])
    numbered = values.where("x IS NOT NULL").selectExpr("k", "g", "x", "row_number() OVER (PARTITION BY k, g ORDER BY x DESC) AS rank").where(F.col("rank") <= n)
    assert rows(got, "k", "g", "x", "rank") == rows(numbered, "k", "g", "x", "rank")


def test_a_hot_key_sends_one_state_per_task(spark):
    df = spark.range(0, 200_000, 1, 6).select(F.lit("hot").alias("k"), F.col("id").alias("x"))
    got = user.aggregate(df, ["k"], user.Average("x"), ["x"])
    got.write.format("noop").mode("overwrite").save()
    assert rows(got) == [("hot", 99999.5, 99999)]
    states = user.to_arrow_schema(user.StructType.fromDDL("k string, total bigint, n bigint"))
    sent = df.mapInArrow(user._partial(user.Average("x"), ["k"], ["x"], states), "k string, total bigint, n bigint")
    assert sent.count() == 6


def test_many_keys_leave_the_task(spark, monkeypatch):
    monkeypatch.setattr(user, "HELD_ROWS", 100)
    df = spark.range(5000).select((F.col("id") % 1700).alias("k"), F.col("id").alias("x")).repartition(3)
    assert rows(user.aggregate(df, ["k"], user.Average("x"), ["x"]), "k", "average") == rows(df.groupBy("k").agg(F.avg("x").alias("average")), "k", "average")
    assert user.aggregate(df.where("k < 0"), ["k"], user.Average("x"), ["x"]).count() == 0


TEXTS = [(1, "a|bb"), (2, ""), (3, None), (4, "x"), (5, "||"), (6, "é|"), (7, None)]


@pytest.mark.parametrize("outer", [False, True])
def test_table_function(spark, outer):
    df = spark.createDataFrame(TEXTS, "id int, s string").repartition(2)
    got = user.lateral(df, user.split_words, ["s"], user.SPLIT_SCHEMA, outer)
    want = [(i, w, len(w)) for i, s in TEXTS for w in ((s or "").split("|") if s is not None else [])] + [(i, None, None) for i, s in TEXTS if s is None and outer]
    assert rows(got, "id", "word", "length") == sorted(want, key=repr)
    user.register_table_functions(spark)
    df.createOrReplaceTempView("texts_of_users")
    join = "LEFT JOIN LATERAL split_words(s) w ON TRUE" if outer else "JOIN LATERAL split_words(s) w"
    assert rows(spark.sql(f"SELECT id, w.word, w.length FROM texts_of_users {join}"), "id", "word", "length") == sorted(want, key=repr)
