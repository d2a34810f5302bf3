"""Queries: group windows, window functions, triggers and evictors.

Seconds of the original examples are scaled to the density of `events`: 5 s -> 1 day, 10 s -> 2 days,
3 s / 4 s -> 12 / 16 hours, 2 s delay -> 12 hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.functions.udfs import integer_average
from eddyline.operators import anchored, windows
from eddyline.plans.catalog import query
from eddyline.plans.inputs import DAY, HOUR, SECOND, calls, calls_sql, in_seconds, seq_width, time_width, us_to_ts
from eddyline.plans.times import LATE_SQL, replayed



def _total() -> Column:
    return F.sum("duration").alias("total")


SID = ["sid"]


def _tumble_sql(select: str, keyed: bool = True, where: str = "") -> str:
    key = "sid, " if keyed else ""
    return calls_sql(f"""SELECT {key}make_timestamp(t - t % {DAY}) AS win_start, make_timestamp(t - t % {DAY} + {DAY}) AS win_end,
      {select} FROM calls {where} GROUP BY ALL""")


SUM_SQL = "CAST(sum(duration) AS BIGINT) AS total"


@query("win_tumble_keyed", _tumble_sql(SUM_SQL))
def win_tumble_keyed(spark: SparkSession, sf: str) -> DataFrame:
    return windows.tumble(calls(spark, sf), SID, "ts", "1 day", _total())


@query("win_tumble_all", _tumble_sql(SUM_SQL, keyed=False))
def win_tumble_all(spark: SparkSession, sf: str) -> DataFrame:
    return windows.tumble(calls(spark, sf), [], "ts", "1 day", _total())


@query("win_tumble_sql", _tumble_sql(SUM_SQL + ", count(*) AS n"))
def win_tumble_sql(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """SELECT sid, window.start AS win_start, window.end AS win_end, sum(duration) AS total, count(*) AS n
           FROM {c} GROUP BY sid, window(ts, '1 day')""",
        c=calls(spark, sf),
    )


def _slide_sql(size: int, step: int, keyed: bool) -> str:
    """Every window [s, s + size) with s a multiple of step that contains the row."""
    key = "sid, " if keyed else ""
    copies = -(-size // step)
    return calls_sql(f""", w AS (SELECT sid, duration, t, t - t % {step} - k * {step} AS s
        FROM calls, unnest(range(0, {copies})) AS r(k))
      SELECT {key}make_timestamp(s) AS win_start, make_timestamp(s + {size}) AS win_end, {SUM_SQL}
      FROM w WHERE s + {size} > t GROUP BY ALL""")


@query("win_slide_keyed", _slide_sql(2 * DAY, DAY, True))
def win_slide_keyed(spark: SparkSession, sf: str) -> DataFrame:
    return windows.slide(calls(spark, sf), SID, "ts", "2 days", "1 day", _total())


@query("win_slide_all", _slide_sql(48 * HOUR, 15 * HOUR, False))
def win_slide_all(spark: SparkSession, sf: str) -> DataFrame:
    """A step that does not divide the size."""
    return windows.slide(calls(spark, sf), [], "ts", "48 hours", "15 hours", _total())


@query("win_hop_sql", _slide_sql(2 * DAY, DAY, True))
def win_hop_sql(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(
        """SELECT sid, window.start AS win_start, window.end AS win_end, sum(duration) AS total
           FROM {c} GROUP BY sid, window(ts, '2 days', '1 day')""",
        c=calls(spark, sf),
    )


@query(
    "win_cumulate_sql",
    calls_sql(f""", e AS (SELECT sid, duration, t, t - t % {4 * DAY} AS s, t - t % {4 * DAY} + k * {DAY} AS e
        FROM calls, unnest(range(1, 5)) AS r(k))
      SELECT sid, make_timestamp(s) AS win_start, make_timestamp(e) AS win_end, {SUM_SQL} FROM e WHERE e > t GROUP BY ALL"""),
)
def win_cumulate_sql(spark: SparkSession, sf: str) -> DataFrame:
    out = windows.cumulate(calls(spark, sf), SID, "t", DAY, 4 * DAY, F.col("duration"))
    return _bounds(out, SID, "total")


def _bounds(df: DataFrame, keys: list[str], *rest: str) -> DataFrame:
    return df.select(*keys, us_to_ts(F.col("t_start")).alias("win_start"), us_to_ts(F.col("t_end")).alias("win_end"), *rest)


def _session_sql(gap: str, keyed: bool) -> str:
    part = "PARTITION BY sid " if keyed else ""
    key = "sid, " if keyed else ""
    return calls_sql(f""", g AS (SELECT *, t + {gap} AS upto FROM calls),
      o AS (SELECT *, CASE WHEN t <= max(upto) OVER ({part}ORDER BY t, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        THEN 0 ELSE 1 END AS opens FROM g),
      i AS (SELECT *, sum(opens) OVER ({part}ORDER BY t, seq) AS id FROM o)
      SELECT {key}make_timestamp(min(t)) AS win_start, make_timestamp(max(upto)) AS win_end, {SUM_SQL}, count(*) AS n
      FROM i GROUP BY {key}id""")


@query("win_session_keyed", _session_sql(str(12 * HOUR), True))
def win_session_keyed(spark: SparkSession, sf: str) -> DataFrame:
    out = windows.sessions(calls(spark, sf), SID, "t", F.lit(12 * HOUR), F.col("duration"), time_width(spark, sf))
    return _bounds(out, SID, "total", "n")


@query("win_session_dynamic", _session_sql(f"(CASE WHEN call_type = 'fail' THEN {12 * HOUR} ELSE {16 * HOUR} END)", True))
def win_session_dynamic(spark: SparkSession, sf: str) -> DataFrame:
    """The gap depends on the row."""
    gap = F.when(F.col("call_type") == "fail", 12 * HOUR).otherwise(16 * HOUR)
    return _bounds(windows.sessions(calls(spark, sf), SID, "t", gap, F.col("duration"), time_width(spark, sf)), SID, "total", "n")


@query("win_session_all", _session_sql(str(HOUR // 6), False))
def win_session_all(spark: SparkSession, sf: str) -> DataFrame:
    out = windows.sessions(calls(spark, sf), [], "t", F.lit(HOUR // 6), F.col("duration"), time_width(spark, sf))
    return _bounds(out, [], "total", "n")


def _count_sql(size: int, keyed: bool) -> str:
    part = "PARTITION BY sid " if keyed else ""
    key = "sid, " if keyed else ""
    return calls_sql(f""", r AS (SELECT *, (row_number() OVER ({part}ORDER BY seq) - 1) // {size} AS win_no FROM calls)
      SELECT {key}CAST(win_no AS BIGINT) AS win_no, min(seq) AS first_seq, max(seq) AS last_seq, {SUM_SQL}
      FROM r GROUP BY {key}win_no HAVING count(*) = {size}""")


def _count(spark: SparkSession, sf: str, keys: list[str], size: int) -> DataFrame:
    return windows.count_windows(calls(spark, sf), keys, "seq", size, F.col("duration"), seq_width(spark, sf))


@query("win_count_keyed", _count_sql(5, True))
def win_count_keyed(spark: SparkSession, sf: str) -> DataFrame:
    return _count(spark, sf, SID, 5)


@query("win_count_all", _count_sql(5, False))
def win_count_all(spark: SparkSession, sf: str) -> DataFrame:
    return _count(spark, sf, [], 5)


@query("win_global_count_trigger", _count_sql(3, True))
def win_global_count_trigger(spark: SparkSession, sf: str) -> DataFrame:
    return _count(spark, sf, SID, 3)


@query("win_global_count_all", _count_sql(3, False))
def win_global_count_all(spark: SparkSession, sf: str) -> DataFrame:
    return _count(spark, sf, [], 3)


@query(
    "win_count_slide",
    calls_sql(""", r AS (SELECT *, row_number() OVER w AS rn, sum(duration) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS total,
        count(*) OVER (w ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS n FROM calls WINDOW w AS (PARTITION BY sid ORDER BY seq))
      SELECT sid, CAST(rn // 2 AS BIGINT) AS firing, seq AS last_seq, CAST(total AS BIGINT) AS total, n FROM r WHERE rn % 2 = 0"""),
)
def win_count_slide(spark: SparkSession, sf: str) -> DataFrame:
    return windows.count_windows_sliding(calls(spark, sf), SID, "seq", 5, 2, F.col("duration"), seq_width(spark, sf))


def anchored_sql(length: int, value: str = "duration", source: str = "calls", extra: str = "") -> str:
    """Anchors by recursion, in whole seconds: each next anchor is the first row at or after the end of the window before."""
    return calls_sql(
        f"""{extra}, p AS (SELECT sid, t // {SECOND} AS t, {value} AS x FROM {source}), a AS (
        SELECT sid, min(t) AS anchor FROM p GROUP BY sid
        UNION ALL
        SELECT a.sid, (SELECT min(p.t) FROM p WHERE p.sid = a.sid AND p.t >= a.anchor + {length}) AS anchor
        FROM a WHERE a.anchor IS NOT NULL)
      SELECT a.sid, a.anchor, a.anchor + {length} AS fire_at, CAST(sum(x) AS BIGINT) AS total, count(*) AS n
      FROM a JOIN p ON p.sid = a.sid AND p.t >= a.anchor AND p.t < a.anchor + {length} GROUP BY ALL""",
        recursive=True,
    )


DAY_SECONDS = DAY // SECOND


@query("win_trigger_anchored", anchored_sql(DAY_SECONDS))
def win_trigger_anchored(spark: SparkSession, sf: str) -> DataFrame:
    return anchored.anchored_windows(in_seconds(calls(spark, sf)), SID, "t", DAY_SECONDS, F.col("duration"))


@query("win_evict_late", anchored_sql(DAY_SECONDS, "CASE WHEN t < wm THEN 0 ELSE duration END", "late", LATE_SQL))
def win_evict_late(spark: SparkSession, sf: str) -> DataFrame:
    """Late rows arm timers but are evicted before the sum."""
    kept = F.when(F.col("t") < F.col("wm"), 0).otherwise(F.col("duration"))
    rows = in_seconds(replayed(spark, sf).withColumn("kept", kept))
    return anchored.anchored_windows(rows, SID, "t", DAY_SECONDS, F.col("kept"))


@query("win_trigger_each", calls_sql(f"""SELECT sid, seq, make_timestamp(t - t % {DAY}) AS win_start,
      make_timestamp(t - t % {DAY} + {DAY}) AS win_end, duration AS total FROM calls"""))
def win_trigger_each(spark: SparkSession, sf: str) -> DataFrame:
    """Every row fires and purges its window, so a window's sum is the row's own value."""
    w = F.window("ts", "1 day")
    return calls(spark, sf).select("sid", "seq", w.start.alias("win_start"), w.end.alias("win_end"), F.col("duration").alias("total"))


@query(
    "win_evict_delta",
    calls_sql(f""", l AS (SELECT *, t - t % {DAY} AS s, last_value(duration) OVER (PARTITION BY sid, t - t % {DAY} ORDER BY seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lst FROM calls)
      SELECT sid, make_timestamp(s) AS win_start, make_timestamp(s + {DAY}) AS win_end, {SUM_SQL}, count(*) AS n
      FROM l WHERE abs(duration - lst) < 5 GROUP BY ALL"""),
)
def win_evict_delta(spark: SparkSession, sf: str) -> DataFrame:
    return windows.delta_evicted(calls(spark, sf), SID, "ts", "1 day", "seq", "duration", 5)


@query("winfn_reduce", _tumble_sql(SUM_SQL))
def winfn_reduce(spark: SparkSession, sf: str) -> DataFrame:
    return windows.tumble(calls(spark, sf), SID, "ts", "1 day", F.sum("duration").alias("total"))


@query("winfn_reduce_process", _tumble_sql("max(duration) AS longest"))
def winfn_reduce_process(spark: SparkSession, sf: str) -> DataFrame:
    return windows.tumble(calls(spark, sf), SID, "ts", "1 day", F.max("duration").alias("longest"))


@query("winfn_aggregate", _tumble_sql(SUM_SQL + ", count(*) AS n"))
def winfn_aggregate(spark: SparkSession, sf: str) -> DataFrame:
    return windows.tumble(calls(spark, sf), SID, "ts", "1 day", _total(), F.count(F.lit(1)).alias("n"))


@query("winfn_aggregate_process", _tumble_sql("CAST(CAST(sum(duration) AS BIGINT) // count(*) AS DOUBLE) AS average"))
def winfn_aggregate_process(spark: SparkSession, sf: str) -> DataFrame:
    """Integer division, then a double."""
    return windows.tumble(calls(spark, sf), SID, "ts", "1 day", integer_average("duration").cast("double").alias("average"))


@query(
    "winfn_process",
    calls_sql(f"""SELECT sid, make_timestamp(t - t % {DAY}) AS win_start, make_timestamp(t - t % {DAY} + {DAY}) AS win_end,
      {SUM_SQL}, max(t) - {12 * HOUR} - 1 AS own_watermark FROM calls GROUP BY ALL"""),
)
def winfn_process(spark: SparkSession, sf: str) -> DataFrame:
    """Sum with the watermark the window's own rows imply."""
    mark = (F.max("t") - 12 * HOUR - 1).alias("own_watermark")
    return windows.tumble(calls(spark, sf), SID, "ts", "1 day", _total(), mark)


@query("winfn_apply", _tumble_sql("CAST(sum(duration) FILTER (call_type = 'success') AS BIGINT) AS success_total, count(*) AS n"))
def winfn_apply(spark: SparkSession, sf: str) -> DataFrame:
    success = F.sum(F.when(F.col("call_type") == "success", F.col("duration"))).alias("success_total")
    return windows.tumble(calls(spark, sf), SID, "ts", "1 day", success, F.count(F.lit(1)).alias("n"))



