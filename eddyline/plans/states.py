"""Queries: keyed state, timers, change logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.operators import aggregates, anchored, blocks, changelog, state
from eddyline.plans.catalog import query
from eddyline.plans.inputs import HOUR, SECOND, calls, calls_sql, in_seconds, seq_width, table
from eddyline.plans.windows import DAY_SECONDS, anchored_sql


@query("state_value_gap", calls_sql("""SELECT seq, sid, gap FROM (SELECT *, t - lag(t) OVER (PARTITION BY sid ORDER BY seq) AS gap FROM calls)
  WHERE gap IS NOT NULL"""))
def state_value_gap(spark: SparkSession, sf: str) -> DataFrame:
    rows = calls(spark, sf).select("seq", "sid", "t")
    gaps = state.gap_to_previous(rows, "sid", "seq", "t", seq_width(spark, sf))
    return gaps.where("gap IS NOT NULL").select("seq", "sid", "gap")


@query("state_list_timer", anchored_sql(4 * DAY_SECONDS))
def state_list_timer(spark: SparkSession, sf: str) -> DataFrame:
    return anchored.anchored_windows(in_seconds(calls(spark, sf)), ["sid"], "t", 4 * DAY_SECONDS, F.col("duration"))


@query("state_reducing_timer", anchored_sql(2 * DAY_SECONDS))
def state_reducing_timer(spark: SparkSession, sf: str) -> DataFrame:
    return anchored.anchored_windows(in_seconds(calls(spark, sf)), ["sid"], "t", 2 * DAY_SECONDS, F.col("duration"))


@query(
    "state_map_running",
    calls_sql("SELECT seq, sid, call_in, CAST(sum(duration) OVER (PARTITION BY sid, call_in ORDER BY seq) AS BIGINT) AS total FROM calls"),
)
def state_map_running(spark: SparkSession, sf: str) -> DataFrame:
    """The map entry each row changes, with its new value."""
    rows = calls(spark, sf).select("seq", "sid", "call_in", "duration")
    out = blocks.running(rows, ["sid", "call_in"], ["seq"], {"total": ("sum", F.col("duration"))}, seq_width(spark, sf))
    return out.drop("duration")


@query(
    "state_aggregating_running",
    calls_sql("""SELECT seq, sid, CAST(sum(duration) OVER w AS DOUBLE) / count(*) OVER w AS average
      FROM calls WINDOW w AS (PARTITION BY sid ORDER BY seq)"""),
)
def state_aggregating_running(spark: SparkSession, sf: str) -> DataFrame:
    rows = calls(spark, sf).select("seq", "sid", "duration")
    return aggregates.running_average(rows, "sid", "seq", F.col("duration"), seq_width(spark, sf)).drop("duration")


def _ttl_sql(ttl: int) -> str:
    return calls_sql(f""", g AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY sid ORDER BY seq) < {ttl} THEN 0 ELSE 1 END AS fresh FROM calls),
      i AS (SELECT *, sum(fresh) OVER (PARTITION BY sid ORDER BY seq) AS island FROM g)
      SELECT seq, sid, CAST(sum(duration) OVER (PARTITION BY sid, island ORDER BY seq) AS BIGINT) AS total FROM i""")


def _ttl(spark: SparkSession, sf: str, ttl: int) -> DataFrame:
    out = state.expiring_total(calls(spark, sf), "sid", "seq", "t", "duration", ttl, seq_width(spark, sf))
    return out.select("seq", "sid", "total")


@query("state_ttl", _ttl_sql(12 * HOUR))
def state_ttl(spark: SparkSession, sf: str) -> DataFrame:
    return _ttl(spark, sf, 12 * HOUR)


@query("state_ttl_sql", _ttl_sql(6 * HOUR))
def state_ttl_sql(spark: SparkSession, sf: str) -> DataFrame:
    """State lifetime of a SQL GROUP BY."""
    return _ttl(spark, sf, 6 * HOUR)


FAR = 2**62
HALF_DAY = 12 * HOUR // SECOND


@query(
    "timer_fail_alert",
    calls_sql(
        f""", s AS (SELECT sid, seq, t // {SECOND} AS t, call_type FROM calls),
      f AS (SELECT sid, t, call_type, coalesce(min(CASE WHEN call_type <> 'fail' THEN seq END) OVER w, {FAR}) AS stop,
        coalesce(min(CASE WHEN call_type <> 'fail' THEN t END) OVER w, {FAR}) AS stop_t
        FROM s WINDOW w AS (PARTITION BY sid ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
      k AS (SELECT sid, t, stop, stop_t FROM f WHERE call_type = 'fail'),
      a AS (SELECT sid, stop, stop_t, min(t) AS anchor FROM k GROUP BY sid, stop, stop_t
        UNION ALL
        SELECT a.sid, a.stop, a.stop_t, (SELECT min(k.t) FROM k WHERE k.sid = a.sid AND k.stop = a.stop AND k.t >= a.anchor + {HALF_DAY})
        FROM a WHERE a.anchor IS NOT NULL)
      SELECT sid, anchor AS fail_t, anchor + {HALF_DAY} AS alert_t FROM a WHERE anchor + {HALF_DAY} < stop_t""",
        recursive=True,
    ),
)
def timer_fail_alert(spark: SparkSession, sf: str) -> DataFrame:
    rows = in_seconds(calls(spark, sf))
    return state.silent_failures(rows, "sid", "seq", "t", F.col("call_type") == "fail", HALF_DAY, seq_width(spark, sf))


# change log bound to the events: signup creates, error deletes, everything else updates
KINDS_SQL = """, log AS (SELECT seq, sid, duration, CASE call_type WHEN 'signup' THEN '+I' WHEN 'fail' THEN '-D' ELSE '+U' END AS row_kind FROM calls)"""


def change_log(spark: SparkSession, sf: str) -> DataFrame:
    """With a retraction in front of every update, as an aggregation would write it."""
    rows = calls(spark, sf).select("seq", "sid", "duration", "call_type")
    kind = F.when(F.col("call_type") == "signup", "+I").when(F.col("call_type") == "fail", "-D").otherwise("+U")
    kinds = F.when(kind == "+U", F.array(F.lit("-U"), F.lit("+U"))).otherwise(F.array(kind))
    return rows.withColumn("row_kind", F.explode(kinds)).drop("call_type")


@query(
    "cl_materialize",
    calls_sql(f"""{KINDS_SQL} SELECT seq, sid, duration FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY seq DESC) AS rn FROM log)
      WHERE rn = 1 AND row_kind <> '-D'"""),
)
def cl_materialize(spark: SparkSession, sf: str) -> DataFrame:
    return changelog.materialize(change_log(spark, sf), ["sid"], "seq")


SUMS_SQL = """, s AS (SELECT seq, sid, duration, row_number() OVER w AS rn, CAST(sum(duration) OVER w AS BIGINT) AS total
  FROM calls WINDOW w AS (PARTITION BY sid ORDER BY seq))"""


@query(
    "cl_emit_all",
    calls_sql(f"""{SUMS_SQL} SELECT sid, seq, CASE WHEN rn = 1 THEN '+I' ELSE '+U' END AS row_kind, total FROM s
      UNION ALL SELECT sid, seq, '-U' AS row_kind, total - duration AS total FROM s WHERE rn > 1"""),
)
def cl_emit_all(spark: SparkSession, sf: str) -> DataFrame:
    return changelog.emit_all(calls(spark, sf), "sid", "seq", F.col("duration"), seq_width(spark, sf))


@query("cl_emit_upsert", calls_sql(f"{SUMS_SQL} SELECT sid, seq, CASE WHEN rn = 1 THEN '+I' ELSE '+U' END AS row_kind, total FROM s"))
def cl_emit_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return changelog.emit_upserts(calls(spark, sf), "sid", "seq", F.col("duration"), seq_width(spark, sf))


ROW = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("age", T.LongType())])


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """JSON change messages made of the events."""
    row = F.struct(F.col("sid").alias("id"), F.concat(F.lit("user-"), "sid").alias("name"), F.col("duration").alias("age"))
    op = F.when(F.col("call_type") == "signup", "c").when(F.col("call_type") == "fail", "d").otherwise("u")
    return calls(spark, sf).select("seq", "t", row.alias("row"), op.alias("op")).select(
        "seq",
        F.to_json(
            F.struct(
                F.when(F.col("op") != "c", F.col("row")).alias("before"),
                F.when(F.col("op") != "d", F.col("row")).alias("after"),
                "op",
                (F.col("t") - F.pmod("t", F.lit(1000))).alias("ts_ms"),
            )
        ).alias("value"),
    )


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return changelog.read_envelopes(envelopes(spark, sf), "value", ROW)


@query(
    "src_debezium_json",
    calls_sql("""SELECT seq, CASE call_type WHEN 'signup' THEN '+I' WHEN 'fail' THEN '-D' ELSE '+U' END AS row_kind,
      CASE WHEN call_type <> 'signup' THEN sid END AS before_id, CASE WHEN call_type <> 'fail' THEN sid END AS after_id,
      CASE WHEN call_type <> 'fail' THEN 'user-' || sid END AS after_name, CASE WHEN call_type <> 'fail' THEN duration END AS after_age FROM calls"""),
)
def src_debezium_json(spark: SparkSession, sf: str) -> DataFrame:
    return parsed(spark, sf).select(
        "seq", "row_kind", F.col("before.id").alias("before_id"), F.col("after.id").alias("after_id"),
        F.col("after.name").alias("after_name"), F.col("after.age").alias("after_age"),
    )


CURRENT_SQL = """, cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY seq DESC) AS rn FROM calls)
  WHERE rn = 1 AND call_type <> 'fail')"""


@query("cdc_apply", calls_sql(f"{CURRENT_SQL} SELECT sid AS id, 'user-' || sid AS name, duration AS age, seq FROM cur"))
def cdc_apply(spark: SparkSession, sf: str) -> DataFrame:
    return changelog.apply_envelopes(parsed(spark, sf), "id", "seq")


@query("cdc_sql_to_nested", calls_sql(f"{CURRENT_SQL} SELECT CAST(sid AS VARCHAR) AS rk, 'user-' || sid AS name, CAST(duration AS VARCHAR) AS age FROM cur"))
def cdc_sql_to_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Row key and a family of string columns, read back by path for the comparison."""
    current = changelog.apply_envelopes(parsed(spark, sf), "id", "seq")
    nested = current.select(F.col("id").cast("string").alias("rk"), F.struct("name", F.col("age").cast("string").alias("age")).alias("cf1"))
    return nested.select("rk", "cf1.name", "cf1.age")


def _snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """Customers stand for the table as it was before the changes."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("sid"), F.floor("c_acctbal").cast("long").alias("duration")
    )


SNAPSHOT_SQL = calls_sql("""{log}, both_ AS (SELECT -1 AS seq, c_custkey AS sid, CAST(floor(c_acctbal) AS BIGINT) AS duration, '+I' AS row_kind FROM customer
    UNION ALL SELECT seq, sid, duration, row_kind FROM log)
  SELECT sid, duration, seq FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY seq DESC) AS rn FROM both_) WHERE rn = 1 AND row_kind <> '-D'
  """.replace("{log}", KINDS_SQL))


@query("src_cdc_initial", SNAPSHOT_SQL)
def src_cdc_initial(spark: SparkSession, sf: str) -> DataFrame:
    log = changelog.snapshot_then_changes(_snapshot(spark, sf), change_log(spark, sf), "seq")
    return changelog.materialize(log, ["sid"], "seq")


@query(
    "src_cdc_no_pk",
    calls_sql("""SELECT sid, call_in, duration, seq FROM (SELECT *, row_number() OVER (PARTITION BY sid, call_in ORDER BY seq DESC) AS rn FROM calls)
      WHERE rn = 1 AND call_type <> 'fail'"""),
)
def src_cdc_no_pk(spark: SparkSession, sf: str) -> DataFrame:
    """No primary key: the caller names the columns that identify a row."""
    kind = F.when(F.col("call_type") == "fail", "-D").otherwise("+U")
    log = calls(spark, sf).select("sid", "call_in", "duration", "seq", kind.alias("row_kind"))
    return changelog.materialize(log, ["sid", "call_in"], "seq")
