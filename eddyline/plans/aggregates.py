"""Queries: keyed aggregates, over windows, top-n, set operations, user-defined functions."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.functions import udfs, user
from eddyline.operators import aggregates, overs, scans
from eddyline.plans.catalog import query
from eddyline.plans.inputs import DAY, calls, calls_sql, seq_width, table, time_width


@query("agg_sum_keyed", calls_sql("SELECT sid, CAST(sum(duration) AS BIGINT) AS total FROM calls GROUP BY sid"))
def agg_sum_keyed(spark: SparkSession, sf: str) -> DataFrame:
    return calls(spark, sf).groupBy("sid").agg(F.sum("duration").alias("total"))


@query("agg_sql_group", calls_sql("SELECT sid, CAST(sum(duration) AS BIGINT) AS total, count(*) AS n FROM calls GROUP BY sid"))
def agg_sql_group(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql("SELECT sid, sum(duration) AS total, count(*) AS n FROM {c} GROUP BY sid", c=calls(spark, sf))


@query("agg_running_sum", calls_sql("SELECT seq, sid, CAST(sum(duration) OVER (PARTITION BY sid ORDER BY seq) AS BIGINT) AS total FROM calls"))
def agg_running_sum(spark: SparkSession, sf: str) -> DataFrame:
    rows = calls(spark, sf).select("seq", "sid", "duration")
    return aggregates.running_sum(rows, "sid", "seq", F.col("duration"), seq_width(spark, sf)).drop("duration")


def _field_sql(fn: str) -> str:
    return calls_sql(f"SELECT sid, {fn}(duration) AS duration, arg_min(call_in, seq) AS call_in, arg_min(call_type, seq) AS call_type FROM calls GROUP BY sid")


@query("agg_min_field", _field_sql("min"))
def agg_min_field(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.min_field(calls(spark, sf), "sid", "duration", "seq", ["call_in", "call_type"])


@query("agg_max_field", _field_sql("max"))
def agg_max_field(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.max_field(calls(spark, sf), "sid", "duration", "seq", ["call_in", "call_type"])


def _row_sql(direction: str) -> str:
    return calls_sql(f"""SELECT seq, sid, call_in, call_type, duration FROM (SELECT *,
      row_number() OVER (PARTITION BY sid ORDER BY duration {direction}, seq) AS rn FROM calls) WHERE rn = 1""")


@query("agg_min_by", _row_sql("ASC"))
def agg_min_by(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.min_row(calls(spark, sf).select("seq", "sid", "call_in", "call_type", "duration"), "sid", "duration", "seq")


@query("agg_max_by", _row_sql("DESC"))
def agg_max_by(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.max_row(calls(spark, sf).select("seq", "sid", "call_in", "call_type", "duration"), "sid", "duration", "seq")


@query(
    "agg_reduce",
    calls_sql(""", r AS (SELECT *, row_number() OVER (PARTITION BY call_type ORDER BY seq DESC) AS back FROM calls)
      SELECT call_type, CAST(sum(duration) AS BIGINT) AS total, arg_max(seq, (duration, -seq)) AS longest_seq, max(duration) AS longest,
             concat_ws('>', max(sid) FILTER (WHERE back = 2), max(sid) FILTER (WHERE back = 1)) AS last_two FROM r GROUP BY call_type"""),
)
def agg_reduce(spark: SparkSession, sf: str) -> DataFrame:
    """The whole log of each call state as one row: the sum, the longest call, and the callers of the last two calls in their order."""
    log = calls(spark, sf).select("call_type", "seq", F.col("sid").cast("string").alias("sid"), "duration")
    found = scans.reduce_by_key(log, ["call_type"], aggregates.call_summary(), ["seq", "sid", "duration"], order=["seq"])
    return found.select("call_type", "total", "longest_seq", "longest", F.concat_ws(">", "last_but_one", "last").alias("last_two"))


@query("agg_avg_keyed", calls_sql("SELECT sid, CAST(sum(duration) AS DOUBLE) / count(duration) AS average FROM calls GROUP BY sid"))
def agg_avg_keyed(spark: SparkSession, sf: str) -> DataFrame:
    return calls(spark, sf).groupBy("sid").agg(F.avg("duration").alias("average"))


@query("agg_nested_total", calls_sql("SELECT sid, call_in, CAST(sum(duration) AS BIGINT) AS total FROM calls GROUP BY sid, call_in"))
def agg_nested_total(spark: SparkSession, sf: str) -> DataFrame:
    return aggregates.nested_totals(calls(spark, sf), "sid", "call_in", "duration")


@query(
    "over_range_time",
    calls_sql(f"""SELECT seq, sid, CAST(sum(duration) OVER (PARTITION BY sid ORDER BY t
      RANGE BETWEEN {DAY} PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM calls"""),
)
def over_range_time(spark: SparkSession, sf: str) -> DataFrame:
    rows = calls(spark, sf).select("seq", "sid", "t", "duration")
    out = overs.sums_over_time_range(rows, ["sid"], "t", DAY, time_width(spark, sf), total=F.col("duration"))
    return out.select("seq", "sid", "total")


@query(
    "over_named_window",
    calls_sql(f"""SELECT seq, sid, CAST(sum(duration) OVER w AS BIGINT) AS total, count(duration) OVER w AS n
      FROM calls WINDOW w AS (PARTITION BY sid ORDER BY t RANGE BETWEEN {DAY} PRECEDING AND CURRENT ROW)"""),
)
def over_named_window(spark: SparkSession, sf: str) -> DataFrame:
    """Two aggregates over one window, sharing its sort and shuffle."""
    rows = calls(spark, sf).select("seq", "sid", "t", "duration")
    counted = F.col("duration").isNotNull().cast("long")
    out = overs.sums_over_time_range(
        rows, ["sid"], "t", DAY, time_width(spark, sf), total=F.col("duration"), n=counted
    )
    return out.select("seq", "sid", "total", "n")


@query(
    "over_rows",
    calls_sql("""SELECT seq, sid, CAST(sum(duration) OVER (PARTITION BY sid ORDER BY t, seq
      ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM calls"""),
)
def over_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = calls(spark, sf).select("seq", "sid", "t", "duration")
    out = overs.over_rows(rows, ["sid"], ["t", "seq"], 2, ["duration"], time_width(spark, sf), total=F.sum("duration"))
    return out.select("seq", "sid", "total")


@query(
    "topn_row_number",
    calls_sql("""SELECT sid, seq, duration, CAST(rn AS INTEGER) AS rank FROM (SELECT *, row_number() OVER
      (PARTITION BY sid ORDER BY duration, seq) AS rn FROM calls) WHERE rn <= 2"""),
)
def topn_row_number(spark: SparkSession, sf: str) -> DataFrame:
    return overs.top_n(calls(spark, sf).select("sid", "seq", "duration"), ["sid"], 2, F.col("duration"), F.col("seq"))


@query(
    "topn_window",
    calls_sql("""SELECT win_start, sid, seq, duration, CAST(rn AS INTEGER) AS rank FROM (SELECT *, date_trunc('day', ts) AS win_start,
      row_number() OVER (PARTITION BY date_trunc('day', ts), sid ORDER BY duration DESC, seq) AS rn FROM calls) WHERE rn <= 2"""),
)
def topn_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = calls(spark, sf).select(F.window("ts", "1 day").start.alias("win_start"), "sid", "seq", "duration")
    return overs.top_n(rows, ["win_start", "sid"], 2, F.col("duration").desc(), F.col("seq"))


@query("order_offset_fetch", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 3 OFFSET 2")
def order_offset_fetch(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return overs.page(orders, 2, 3, F.col("o_totalprice"), F.col("o_orderkey"))


def _set_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    left = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"))
    right = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation"))
    return left, right


def _set_sql(op: str) -> str:
    return f"SELECT c_nationkey AS nation FROM customer {op} SELECT s_nationkey AS nation FROM supplier"


@query("set_union", _set_sql("UNION"))
def set_union(spark: SparkSession, sf: str) -> DataFrame:
    left, right = _set_sides(spark, sf)
    return left.union(right).distinct()


@query("set_union_all", _set_sql("UNION ALL"))
def set_union_all(spark: SparkSession, sf: str) -> DataFrame:
    left, right = _set_sides(spark, sf)
    return left.unionByName(right)


@query("set_intersect", _set_sql("INTERSECT"))
def set_intersect(spark: SparkSession, sf: str) -> DataFrame:
    left, right = _set_sides(spark, sf)
    return left.intersect(right)


@query("set_intersect_all", _set_sql("INTERSECT ALL"))
def set_intersect_all(spark: SparkSession, sf: str) -> DataFrame:
    left, right = _set_sides(spark, sf)
    return left.intersectAll(right)


@query("set_minus", "SELECT o_custkey AS k FROM orders EXCEPT SELECT user_id AS k FROM events")
def set_minus(spark: SparkSession, sf: str) -> DataFrame:
    left = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"))
    return left.subtract(table(spark, sf, "events").select(F.col("user_id").alias("k")))


@query("set_minus_all", _set_sql("EXCEPT ALL"))
def set_minus_all(spark: SparkSession, sf: str) -> DataFrame:
    left, right = _set_sides(spark, sf)
    return left.exceptAll(right)


@query(
    "connect_two_types",
    """SELECT 'customer' AS kind, c_custkey AS id, upper(c_name) AS label FROM customer
       UNION ALL SELECT 'order' AS kind, o_orderkey AS id, 'order-' || o_orderstatus AS label FROM orders""",
)
def connect_two_types(spark: SparkSession, sf: str) -> DataFrame:
    left = table(spark, sf, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.upper("c_name").alias("label")
    )
    right = table(spark, sf, "orders").select(
        F.lit("order").alias("kind"), F.col("o_orderkey").alias("id"), F.concat(F.lit("order-"), "o_orderstatus").alias("label")
    )
    return left.unionByName(right)


@query("udf_concat", calls_sql("SELECT seq, sid || '|' || call_type || '|' || duration AS text FROM calls"))
def udf_concat(spark: SparkSession, sf: str) -> DataFrame:
    return calls(spark, sf).select("seq", udfs.concat_bar(F.col("sid"), F.col("call_type"), F.col("duration")).alias("text"))


@query(
    "udaf_avg",
    calls_sql("SELECT sid, CAST(sum(duration) AS DOUBLE) / count(duration) AS average, CAST(sum(duration) // count(duration) AS BIGINT) AS int_average FROM calls GROUP BY sid"),
)
def udaf_avg(spark: SparkSession, sf: str) -> DataFrame:
    """An average written by a user: accumulators of (sum, count) are merged by key."""
    return user.aggregate(calls(spark, sf).select("sid", "duration"), ["sid"], user.Average("duration"), ["duration"])


@query(
    "udtf_split",
    calls_sql(""", c AS (SELECT seq, CASE WHEN call_type <> 'busy' THEN call_type || '|' || sid END AS strs FROM calls),
      s AS (SELECT seq, unnest(string_split(strs, '|')) AS word FROM c WHERE strs IS NOT NULL)
      SELECT 'inner' AS form, seq, word, CAST(length(word) AS INTEGER) AS length FROM s
      UNION ALL SELECT 'left' AS form, seq, word, CAST(length(word) AS INTEGER) AS length FROM c LEFT JOIN s USING (seq)"""),
)
def udtf_split(spark: SparkSession, sf: str) -> DataFrame:
    """A table function joined to its own row, inner and left; busy calls have no text, so only the left join has them."""
    text = F.when(F.col("call_type") != "busy", F.concat("call_type", F.lit("|"), F.col("sid").cast("string")))
    rows = calls(spark, sf).select("seq", text.alias("strs"))
    forms = [user.lateral(rows, user.split_words, ["strs"], user.SPLIT_SCHEMA, outer).select(F.lit(name).alias("form"), "seq", "word", "length") for name, outer in (("inner", False), ("left", True))]
    return forms[0].unionByName(forms[1])


@query(
    "udtaf_top2",
    calls_sql("""SELECT sid, duration, CAST(rn AS INTEGER) AS rank FROM (SELECT sid, duration, row_number() OVER
      (PARTITION BY sid ORDER BY duration DESC) AS rn FROM calls WHERE duration IS NOT NULL) WHERE rn <= 2"""),
)
def udtaf_top2(spark: SparkSession, sf: str) -> DataFrame:
    """A table aggregate: an accumulator of the two largest values, a row for each."""
    return user.aggregate(calls(spark, sf).select("sid", "duration"), ["sid"], user.Largest("duration", 2), ["duration"])


@query("fn_rich_lifecycle", "SELECT event_id, upper(event_type) AS label FROM events")
def fn_rich_lifecycle(spark: SparkSession, sf: str) -> DataFrame:
    def process(upper: object, batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), upper(batch.column(1))], names=["event_id", "label"])

    rows = table(spark, sf, "events").select("event_id", "event_type")
    return udfs.with_lifecycle(rows, lambda: pc.utf8_upper, process, lambda _: None, "event_id long, label string")
