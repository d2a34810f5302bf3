"""Queries: watermarks and late data, replayed from the arrival order.

`events` arrives in order; `arrivals` shuffles it by a fixed rule so that rows are up to two days late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.operators import watermark
from eddyline.plans.catalog import query
from eddyline.plans.inputs import DAY, HOUR, SECOND, calls, calls_sql, time_width

DELAY = 12 * HOUR
LATENESS = 12 * HOUR
ARRIVAL = ["arrival_key", "seq"]


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    delay = (F.col("seq") * 7919 % 172800) * SECOND
    return calls(spark, sf).withColumn("arrival_key", F.col("t") + delay)


ARRIVALS_SQL = f""", arr AS (SELECT *, t + (seq * 7919 % 172800) * {SECOND} AS arrival_key FROM calls)"""
LATE_SQL = f"""{ARRIVALS_SQL}, late AS (SELECT *, max(t) OVER (ORDER BY arrival_key, seq
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {DELAY} - 1 AS wm FROM arr)"""
CLASS_SQL = f"""{LATE_SQL}, cls AS (SELECT *, t - t % {DAY} AS t_start, t - t % {DAY} + {DAY} AS t_end,
  CASE WHEN coalesce(t - t % {DAY} + {DAY} - 1 + {LATENESS} <= wm, false) THEN 'dropped'
       WHEN coalesce(t - t % {DAY} + {DAY} - 1 <= wm, false) THEN 'late_ok' ELSE 'on_time' END AS arrival FROM late)"""


def replayed(spark: SparkSession, sf: str) -> DataFrame:
    return watermark.with_watermark(arrivals(spark, sf), ARRIVAL, "t", DELAY, time_width(spark, sf))


def classified(spark: SparkSession, sf: str) -> DataFrame:
    return watermark.classify_late(replayed(spark, sf), "t", DAY, LATENESS)


@query(
    "wm_periodic_custom",
    calls_sql(f"""{ARRIVALS_SQL} SELECT seq, call_type, max(t) OVER (PARTITION BY call_type ORDER BY arrival_key, seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - {DELAY} - 1 AS wm FROM arr"""),
)
def wm_periodic_custom(spark: SparkSession, sf: str) -> DataFrame:
    """A watermark per source; here the call type stands for the source."""
    rows = arrivals(spark, sf).select("seq", "call_type", "t", "arrival_key")
    out = watermark.with_watermark(rows, ARRIVAL, "t", DELAY, time_width(spark, sf), source=["call_type"], before=False)
    return out.select("seq", "call_type", "wm")


@query(
    "wm_punctuated_custom",
    calls_sql(f"""{ARRIVALS_SQL} SELECT seq, sid, max(CASE WHEN sid = 1 THEN t END) OVER (ORDER BY arrival_key, seq
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - 1 AS wm FROM arr"""),
)
def wm_punctuated_custom(spark: SparkSession, sf: str) -> DataFrame:
    """Only rows of one key advance the watermark."""
    rows = arrivals(spark, sf).select("seq", "sid", "t", "arrival_key")
    out = watermark.with_watermark(
        rows, ARRIVAL, "t", 0, time_width(spark, sf), advances=F.col("sid") == 1, before=False
    )
    return out.select("seq", "sid", "wm")


def _windowed_sql(kept: str) -> str:
    return calls_sql(f"""{CLASS_SQL} SELECT sid, t_start, t_end, CAST(sum(duration) AS BIGINT) AS total, count(*) AS n
      FROM cls WHERE arrival IN ({kept}) GROUP BY ALL""")


@query("late_drop", _windowed_sql("'on_time'"))
def late_drop(spark: SparkSession, sf: str) -> DataFrame:
    kept = classified(spark, sf).where(F.col("arrival") == "on_time")
    return kept.groupBy("sid", "t_start", "t_end").agg(F.sum("duration").alias("total"), F.count(F.lit(1)).alias("n"))


@query(
    "late_allowed",
    calls_sql(f"""{CLASS_SQL} SELECT sid, t_start, t_end, CAST(sum(duration) FILTER (arrival = 'on_time') AS BIGINT) AS first_total,
      CAST(sum(duration) AS BIGINT) AS total, count(*) FILTER (arrival = 'late_ok') AS late_firings
      FROM cls WHERE arrival <> 'dropped' GROUP BY ALL"""),
)
def late_allowed(spark: SparkSession, sf: str) -> DataFrame:
    """Result at the first firing, final result, and how often late rows fired the window again."""
    kept = classified(spark, sf).where(F.col("arrival") != "dropped")
    on_time = F.col("arrival") == "on_time"
    return kept.groupBy("sid", "t_start", "t_end").agg(
        F.sum(F.when(on_time, F.col("duration"))).alias("first_total"),
        F.sum("duration").alias("total"),
        F.count_if(~on_time).alias("late_firings"),
    )


@query("late_side_output", calls_sql(f"{CLASS_SQL} SELECT seq, sid, t, duration, t_end FROM cls WHERE arrival = 'dropped'"))
def late_side_output(spark: SparkSession, sf: str) -> DataFrame:
    return classified(spark, sf).where(F.col("arrival") == "dropped").select("seq", "sid", "t", "duration", "t_end")


@query(
    "wm_multi_input",
    calls_sql(f""", w AS (SELECT t - t % {DAY} AS t_start, call_type FROM calls WHERE call_type IN ('busy', 'success'))
      SELECT t_start, count(*) FILTER (call_type = 'busy') AS n_busy, count(*) FILTER (call_type = 'success') AS n_success FROM w
      WHERE t_start + {DAY} - 1 <= least((SELECT max(t) FROM calls WHERE call_type = 'busy'),
        (SELECT max(t) FROM calls WHERE call_type = 'success')) - {DELAY} - 1 GROUP BY t_start"""),
)
def wm_multi_input(spark: SparkSession, sf: str) -> DataFrame:
    """Two inputs merged; a window has fired once the slower input's watermark has passed its end."""
    busy, success = [calls(spark, sf, state).select("t", "call_type") for state in ("busy", "success")]
    slower = F.least(busy.agg(F.max("t")).scalar(), success.agg(F.max("t")).scalar()) - DELAY - 1
    start = F.col("t") - F.pmod(F.col("t"), F.lit(DAY))
    counts = busy.unionByName(success).groupBy(start.alias("t_start")).agg(
        F.count_if(F.col("call_type") == "busy").alias("n_busy"), F.count_if(F.col("call_type") == "success").alias("n_success")
    )
    return counts.where(F.col("t_start") + DAY - 1 <= slower)



