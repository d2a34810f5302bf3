"""Queries: projections, filters, row transforms, scalar functions, distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.operators import distribution, transforms
from eddyline.plans.catalog import query
from eddyline.plans.inputs import calls, calls_sql, table, us_to_ts

WORDS_SQL = "SELECT unnest(string_split(text, ' ')) AS word FROM documents"


@query("wordcount", f"SELECT word, count(*) AS n FROM ({WORDS_SQL}) GROUP BY word")
def wordcount(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.word_count(table(spark, sf, "documents"), "text")


@query("flat_map_split", "SELECT unnest(string_split(c_name, '#')) AS word FROM customer")
def flat_map_split(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.split_words(table(spark, sf, "customer"), "c_name", "#")


@query("filter_prefix_count", f"SELECT word, count(*) AS n FROM ({WORDS_SQL}) WHERE starts_with(word, 'a') GROUP BY word")
def filter_prefix_count(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.word_count_with_prefix(table(spark, sf, "documents"), "text", "a")


@query("map_plus_one", "SELECT event_id, event_id + 1 AS x FROM events")
def map_plus_one(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", (F.col("event_id") + 1).alias("x"))


@query("filter_even", "SELECT event_id FROM events WHERE event_id % 2 = 0")
def filter_even(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id").where(F.col("event_id") % 2 == 0)


@query(
    "map_format_call",
    calls_sql("""SELECT seq, 'caller:' || sid || ',callee:' || call_in
      || ',start:' || strftime(make_timestamp(t), '%Y-%m-%d %H:%M:%S')
      || ',end:' || strftime(make_timestamp(t + duration * 1000), '%Y-%m-%d %H:%M:%S') AS call FROM calls"""),
)
def map_format_call(spark: SparkSession, sf: str) -> DataFrame:
    text = transforms.describe_call(F.col("t"), F.col("duration"), F.col("sid"), F.col("call_in"))
    return calls(spark, sf).select("seq", text.alias("call"))


@query("map_typed_filter", "SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name, c_nationkey AS age FROM customer WHERE c_custkey > 1")
def map_typed_filter(spark: SparkSession, sf: str) -> DataFrame:
    typed = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("int").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("age")
    )
    return typed.where("id > 1")


@query("side_output_split", calls_sql("SELECT CASE WHEN call_type = 'success' THEN 'main' ELSE 'other' END AS output, seq, sid, call_type FROM calls"))
def side_output_split(spark: SparkSession, sf: str) -> DataFrame:
    outputs = {"main": F.col("call_type") == "success", "other": F.lit(True)}
    tagged, _ = transforms.split_outputs(calls(spark, sf).select("seq", "sid", "call_type"), outputs)
    return tagged


@query(
    "iterate_decrement",
    calls_sql("""SELECT seq, CASE WHEN call_in >= 1 THEN call_in - i ELSE call_in END AS x FROM
      (SELECT seq, CAST(call_in AS BIGINT) AS call_in, unnest(range(0, greatest(call_in, 1))) AS i FROM calls)"""),
)
def iterate_decrement(spark: SparkSession, sf: str) -> DataFrame:
    return transforms.countdown(calls(spark, sf).select("seq", "call_in"), "call_in").select("seq", "x")


FILTER_AGG_SQL = calls_sql("SELECT sid, CAST(sum(duration) AS BIGINT) AS total FROM calls WHERE call_type = 'success' AND duration > 10 GROUP BY sid")


@query("filter_and_agg", FILTER_AGG_SQL)
def filter_and_agg(spark: SparkSession, sf: str) -> DataFrame:
    """SQL over a DataFrame whose filter was written with the DataFrame API."""
    wanted = calls(spark, sf, "success").where(F.col("duration") > 10)
    return spark.sql("SELECT sid, sum(duration) AS total FROM {wanted} GROUP BY sid", wanted=wanted)


@query("in_list", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def in_list(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return orders.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderstatus")


@query("computed_columns", calls_sql("SELECT seq AS id, make_timestamp(t) AS row_time, duration * 60 AS minutes FROM calls"))
def computed_columns(spark: SparkSession, sf: str) -> DataFrame:
    with_time = calls(spark, sf).select("seq", us_to_ts(F.col("t")), F.col("duration") * 60)
    return with_time.toDF("id", "row_time", "minutes")


@query("nested_construct_access", "SELECT c_custkey AS rk, c_name AS name, c_acctbal + 1 AS next_balance FROM customer")
def nested_construct_access(spark: SparkSession, sf: str) -> DataFrame:
    nested = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("rk"), F.struct("c_name", "c_nationkey").alias("cf1"), F.struct("c_acctbal").alias("cf2")
    )
    return nested.select("rk", F.col("cf1.c_name").alias("name"), (F.col("cf2.c_acctbal") + 1).alias("next_balance"))


@query("view_round_trip", "SELECT CAST(event_id AS BIGINT) AS event_id, CAST(value AS DOUBLE) AS value FROM events")
def view_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    table(spark, sf, "events").createOrReplaceTempView("round_trip")
    typed = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType())])
    return spark.table("round_trip").to(typed)


@query(
    "scalar_functions",
    calls_sql("""SELECT seq, make_timestamp(t) AS row_time, strftime(make_timestamp(t), '%Y%m%d') AS dt,
      CAST(duration AS INTEGER) AS d, coalesce(nullif(call_type, 'fail'), 'none') AS state,
      substr(call_type, 1, 2) AS head, trim(' ' || call_type || ' ') AS trimmed, duration - 1 AS minus_one,
      (duration >= 5 AND duration < 50) AS mid FROM calls"""),
)
def scalar_functions(spark: SparkSession, sf: str) -> DataFrame:
    row_time = us_to_ts(F.col("t"))
    return calls(spark, sf).select(
        "seq",
        row_time.alias("row_time"),
        F.date_format(row_time, "yyyyMMdd").alias("dt"),
        F.col("duration").cast("int").alias("d"),
        F.coalesce(F.nullif(F.col("call_type"), F.lit("fail")), F.lit("none")).alias("state"),
        F.substring("call_type", 1, 2).alias("head"),
        F.trim(F.concat(F.lit(" "), "call_type", F.lit(" "))).alias("trimmed"),
        (F.col("duration") - 1).alias("minus_one"),
        ((F.col("duration") >= 5) & (F.col("duration") < 50)).alias("mid"),
    )


@query(
    "time_zone_casts",
    calls_sql("""SELECT seq, make_timestamp(t) AS ntz6, make_timestamp(t - t % 1000) AS ntz3,
      make_timestamp(t) + INTERVAL 8 HOUR AS shanghai, t // 1000 AS ms FROM calls"""),
)
def time_zone_casts(spark: SparkSession, sf: str) -> DataFrame:
    instant = F.timestamp_micros("t")
    return calls(spark, sf).select(
        "seq",
        instant.cast("timestamp_ntz").alias("ntz6"),
        F.date_trunc("millisecond", instant).cast("timestamp_ntz").alias("ntz3"),
        F.convert_timezone(F.lit("UTC"), F.lit("Asia/Shanghai"), instant.cast("timestamp_ntz")).alias("shanghai"),
        F.unix_millis(instant).alias("ms"),
    )


KEY_PLACES_SQL = "SELECT user_id, count(*) AS n, CAST(1 AS BIGINT) AS places FROM events GROUP BY user_id"


def _places(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and the number of partitions they are in."""
    per_place = distribution.placement(df).groupBy(key, "partition").agg(F.count(F.lit(1)).alias("_n"))
    return per_place.groupBy(key).agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("places"))


def _parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("part_key_hash", KEY_PLACES_SQL)
def part_key_hash(spark: SparkSession, sf: str) -> DataFrame:
    return _places(distribution.by_key(table(spark, sf, "events").select("user_id"), _parts(spark), "user_id"), "user_id")


@query("part_custom", "SELECT user_id, count(*) AS n, CAST(1 AS BIGINT) AS places, CAST(user_id % 64 AS INTEGER) AS partition FROM events GROUP BY user_id")
def part_custom(spark: SparkSession, sf: str) -> DataFrame:
    placed = distribution.placement(distribution.by_partitioner(table(spark, sf, "events").select("user_id"), 64, F.col("user_id")))
    per_place = placed.groupBy("user_id", "partition").agg(F.count(F.lit(1)).alias("n"))
    return per_place.groupBy("user_id").agg(F.sum("n").alias("n"), F.count("n").alias("places"), F.max("partition").alias("partition"))


def _balance(df: DataFrame, parts: int) -> DataFrame:
    """Total rows, and whether the fullest partition has at most half more than its fair share (and 50 rows for small tables)."""
    sizes = distribution.placement(df).groupBy("partition").agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(
        F.sum("_n").alias("n"),
        (F.max("_n") <= F.sum("_n") / parts * 1.5 + 50).alias("even"),
        (F.count("_n") <= parts).alias("fits"),
    )


BALANCE_SQL = "SELECT count(*) AS n, true AS even, true AS fits FROM events"


@query("part_shuffle_random", BALANCE_SQL)
def part_shuffle_random(spark: SparkSession, sf: str) -> DataFrame:
    n = _parts(spark)
    return _balance(distribution.shuffled(table(spark, sf, "events").select("event_id"), n, "event_id"), n)


@query("part_rebalance", BALANCE_SQL)
def part_rebalance(spark: SparkSession, sf: str) -> DataFrame:
    n = _parts(spark)
    return _balance(distribution.rebalanced(table(spark, sf, "events").select("event_id"), n), n)


@query("part_rescale", BALANCE_SQL)
def part_rescale(spark: SparkSession, sf: str) -> DataFrame:
    """Up to twice n partitions, then down to n without another shuffle."""
    n = _parts(spark)
    more = distribution.rescaled(table(spark, sf, "events").select("event_id"), 2 * n, grow=True)
    return _balance(distribution.rescaled(more, n, grow=False), n)


@query("part_global", "SELECT event_type, count(*) AS n, CAST(0 AS INTEGER) AS partition FROM events GROUP BY event_type")
def part_global(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return distribution.placement(distribution.gathered(counts))
