"""How the driver tables stand for the event data the operators work on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.operators.blocks import Width

SECOND = 1_000_000
HOUR = 3600 * SECOND
DAY = 24 * HOUR

# event type -> call state; other types keep their name
CALL_STATES = {"error": "fail", "purchase": "success", "click": "busy", "view": "barring"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_us(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def us_to_ts(us: Column) -> Column:
    """Epoch microseconds to a timestamp without zone."""
    return F.timestamp_micros(us).cast("timestamp_ntz")


def as_calls(events: DataFrame) -> DataFrame:
    """`events` as a call log. Works on batch and streaming input."""
    state = F.col("event_type")
    mapped = state
    for source, target in CALL_STATES.items():
        mapped = F.when(state == source, target).otherwise(mapped)
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("ts"),
        epoch_us(F.col("ts")).alias("t"),
        F.col("user_id").alias("sid"),
        F.regexp_extract("props", "[0-9]+", 0).try_cast("int").alias("call_in"),
        mapped.alias("call_type"),
        F.floor("value").cast("long").alias("duration"),
    )


def calls(spark: SparkSession, sf_dir: str, *states: str) -> DataFrame:
    """The call log; with `states` only calls in one of them, filtered on the stored column so that it reaches the scan."""
    events = table(spark, sf_dir, "events")
    if states:
        stored = {target: source for source, target in CALL_STATES.items()}
        events = events.where(F.col("event_type").isin(*[stored.get(s, s) for s in states]))
    return as_calls(events)


def in_seconds(calls: DataFrame) -> DataFrame:
    """Time in whole seconds, the tick for anchored windows of hours or days."""
    return calls.withColumn("t", F.floor(F.col("t") / SECOND).cast("long"))


# fixed block widths by position column, for trials; without one, hot keys are cut at quantiles
WIDTHS: dict[str, int] = {}


def seq_width(spark: SparkSession, sf_dir: str) -> Width:
    return WIDTHS.get("event_id")


def time_width(spark: SparkSession, sf_dir: str) -> Width:
    return WIDTHS.get("t")


# the same call log for the oracle
CALLS_SQL = """calls AS (
  SELECT event_id AS seq, ts, epoch_us(ts) AS t, user_id AS sid,
         CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS call_in,
         CASE event_type WHEN 'error' THEN 'fail' WHEN 'purchase' THEN 'success'
              WHEN 'click' THEN 'busy' WHEN 'view' THEN 'barring' ELSE event_type END AS call_type,
         CAST(floor(value) AS BIGINT) AS duration
  FROM events)"""


def calls_sql(body: str, recursive: bool = False) -> str:
    """`body` may continue the WITH list (start it with a comma) or be the final SELECT."""
    return f"WITH {'RECURSIVE ' if recursive else ''}{CALLS_SQL} {body}"
