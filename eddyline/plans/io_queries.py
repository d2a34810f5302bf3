"""Queries: sources and sinks on stored data. Files are derived from the driver tables in the shared work folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.operators import changelog, windows
from eddyline.plans.catalog import query
from eddyline.plans.inputs import DAY, calls, calls_sql, seq_width, table
from eddyline.session import work_path
from eddyline.sinks import custom as custom_sink
from eddyline.sinks import messages
from eddyline.sinks.files import save_table
from eddyline.sinks.keyed import KeyedTable, hash_fields, wide_rows
from eddyline.sources import catalog, custom, files, kafka

TYPED_SQL = """SELECT CAST(sid AS VARCHAR) AS sid, CAST(sid AS VARCHAR) AS call_out, CAST(call_in AS VARCHAR) AS call_in, call_type,
  t // 1000 AS call_time, duration FROM calls"""


def call_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Events in the layout of a call-log file."""
    return calls(spark, sf).select(
        F.col("sid").cast("string").alias("sid"),
        F.col("sid").cast("string").alias("call_out"),
        F.col("call_in").cast("string").alias("call_in"),
        "call_type",
        F.unix_millis(F.timestamp_micros("t")).alias("call_time"),
        "duration",
    )


_WRITTEN: dict[tuple[str, str], str] = {}


def call_files(spark: SparkSession, sf: str) -> str:
    """The folder of the call log as text files, written once per application."""
    key = (spark.conf.get("spark.app.id"), sf)
    if key not in _WRITTEN:
        path = work_path(spark, "call-log")
        files.call_lines(call_rows(spark, sf)).write.text(path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


@query("src_text_batch", calls_sql(f"""SELECT sid || ',' || call_out || ',' || call_in || ',' || call_type || ',' || call_time || ',' || duration AS value
  FROM ({TYPED_SQL})"""))
def src_text_batch(spark: SparkSession, sf: str) -> DataFrame:
    return files.text_lines(spark, call_files(spark, sf))


@query("src_csv_parse_line", calls_sql(TYPED_SQL))
def src_csv_parse_line(spark: SparkSession, sf: str) -> DataFrame:
    return files.parse_calls(files.text_lines(spark, call_files(spark, sf)))


@query("src_filesystem_csv", calls_sql(f"SELECT *, make_timestamp(call_time * 1000) AS row_time FROM ({TYPED_SQL})"))
def src_filesystem_csv(spark: SparkSession, sf: str) -> DataFrame:
    rows = files.csv_calls(spark, call_files(spark, sf))
    return rows.withColumn("row_time", F.col("row_time").cast("timestamp_ntz"))


@query("src_custom", calls_sql(TYPED_SQL))
def src_custom(spark: SparkSession, sf: str) -> DataFrame:
    custom.register(spark)
    return spark.read.format("call_log").load(call_files(spark, sf))


@query("src_options_hint", calls_sql(TYPED_SQL))
def src_options_hint(spark: SparkSession, sf: str) -> DataFrame:
    """The definition's separator is replaced for this read only."""
    source = files.Source("csv", files.CALL_SCHEMA, call_files(spark, sf), {"sep": ";"})
    return source.read(spark, sep=",")


@query("src_catalog_generic", calls_sql(TYPED_SQL))
def src_catalog_generic(spark: SparkSession, sf: str) -> DataFrame:
    path = call_files(spark, sf)
    name = "calls_" + path.rsplit("-", 1)[1]
    catalog.define(spark, name, files.Source("csv", files.CALL_SCHEMA, path, {"sep": ","}))
    return catalog.read(spark, name)


@query("src_catalog_table", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def src_catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "orders-table")
    name = "orders_" + path.rsplit("-", 1)[1]
    save_table(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus"), name, path, ["o_orderstatus"])
    return catalog.read(spark, name)


@query("sink_catalog_table", "SELECT CAST(s_suppkey AS INTEGER) AS id, s_name AS name, s_nationkey AS age FROM supplier")
def sink_catalog_table(spark: SparkSession, sf: str) -> DataFrame:
    """A delimited table made by DDL and filled by INSERT."""
    path = work_path(spark, "supplier-table")
    name = "supplier_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE TABLE {name} (id INT, name STRING, age INT) USING csv OPTIONS ('sep' '\t') LOCATION '{path}'")
    rows = table(spark, sf, "supplier").selectExpr("CAST(s_suppkey AS INT) AS id", "s_name AS name", "s_nationkey AS age")
    spark.sql(f"INSERT INTO {name} SELECT * FROM {{rows}}", rows=rows)
    return spark.table(name)


NESTED_SQL = "SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name, c_nationkey AS age, c_acctbal AS score FROM customer"


def _nested(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("rk"),
        F.struct(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("age")).alias("cf1"),
        F.struct(F.col("c_acctbal").cast("string").alias("score")).alias("cf2"),
    )


def _flat(nested: DataFrame) -> DataFrame:
    return nested.select(
        F.col("cf1.id").cast("int").alias("id"), F.col("cf1.name").alias("name"), F.col("cf1.age").cast("int").alias("age"),
        F.col("cf2.score").cast("double").alias("score"),
    )


@query("src_nested_kv_table", NESTED_SQL)
def src_nested_kv_table(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(_nested(spark, sf))


@query("sink_nested_row", NESTED_SQL)
def sink_nested_row(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "nested")
    nested = _nested(spark, sf)
    nested.write.parquet(path)
    return _flat(spark.read.schema(nested.schema).parquet(path))


def _topic(spark: SparkSession, sf: str) -> DataFrame:
    """Binary (key, value, offset) rows as a topic would deliver them; sign-ups have no key."""
    key = F.when(F.col("call_type") != "signup", F.col("sid").cast("string")).cast("binary")
    value = F.concat_ws(",", "call_type", "duration").cast("binary")
    return calls(spark, sf).select(key.alias("key"), value.alias("value"), F.col("seq").alias("offset"))


@query("src_kafka_value", calls_sql("SELECT call_type || ',' || duration AS value FROM calls"))
def src_kafka_value(spark: SparkSession, sf: str) -> DataFrame:
    return kafka.values(_topic(spark, sf))


@query(
    "src_kafka_key_value",
    calls_sql("SELECT CASE WHEN call_type <> 'signup' THEN CAST(sid AS VARCHAR) END AS key, call_type || ',' || duration AS value FROM calls"),
)
def src_kafka_key_value(spark: SparkSession, sf: str) -> DataFrame:
    return kafka.keys_and_values(_topic(spark, sf))


@query("src_kafka_sql_key_fields", calls_sql("SELECT CASE WHEN call_type <> 'signup' THEN sid END AS sid, call_type, duration FROM calls"))
def src_kafka_sql_key_fields(spark: SparkSession, sf: str) -> DataFrame:
    return kafka.table_with_key(_topic(spark, sf), "sid", "bigint", "call_type string, duration bigint")


@query("sink_kafka_value", "SELECT event_type || '-' || count(*) AS value FROM events GROUP BY event_type")
def sink_kafka_value(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return messages.value_message(counts, "event_type", "n")


@query("sink_kafka_key_value", "SELECT event_type AS key, CAST(count(*) AS VARCHAR) AS value FROM events GROUP BY event_type")
def sink_kafka_key_value(spark: SparkSession, sf: str) -> DataFrame:
    counts = table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return messages.key_value_message(counts, F.col("event_type"), F.col("n"))


@query("sink_kafka_sql_key_all", calls_sql("SELECT CAST(sid AS VARCHAR) AS key, sid || ',' || call_type || ',' || duration AS value FROM calls"))
def sink_kafka_sql_key_all(spark: SparkSession, sf: str) -> DataFrame:
    return messages.row_message(calls(spark, sf).select("sid", "call_type", "duration"), "sid")


@query("sink_upsert_log", calls_sql("SELECT CAST(sid AS VARCHAR) AS key, '{\"total\":' || CAST(sum(duration) AS BIGINT) || '}' AS value FROM calls GROUP BY sid"))
def sink_upsert_log(spark: SparkSession, sf: str) -> DataFrame:
    """A keyed sum as upsert log, then what compaction leaves of it."""
    log = changelog.emit_upserts(calls(spark, sf), "sid", "seq", F.col("duration"), seq_width(spark, sf))
    return messages.compacted(messages.upsert_message(log, "sid", "seq"), "seq")


HASH_SQL = calls_sql(f"""SELECT (t - t % {DAY}) || '~' || (t - t % {DAY} + {DAY}) AS hash_key, CAST(sid AS VARCHAR) AS field,
  CAST(CAST(sum(duration) AS BIGINT) AS VARCHAR) AS value FROM calls GROUP BY t - t % {DAY}, sid""")


def _window_hash(spark: SparkSession, sf: str) -> DataFrame:
    start = windows.block_start(F.col("t"), DAY)
    totals = calls(spark, sf).groupBy(start.alias("s"), "sid").agg(F.sum("duration").alias("total"), F.max("seq").alias("seq"))
    bounds = F.concat("s", F.lit("~"), F.col("s") + DAY)
    return hash_fields(totals, bounds, F.col("sid"), F.col("total"), F.col("seq"))


@query("sink_hash_kv", HASH_SQL)
def sink_hash_kv(spark: SparkSession, sf: str) -> DataFrame:
    rows = _window_hash(spark, sf)
    store = KeyedTable(spark, work_path(spark, "hash"), rows.schema, ["hash_key", "field"], "seq")
    store(rows, 0)
    return store.read().select("hash_key", "field", "value")


@query("sink_custom", HASH_SQL)
def sink_custom(spark: SparkSession, sf: str) -> DataFrame:
    custom_sink.register(spark)
    path = work_path(spark, "hash-files")
    rows = _window_hash(spark, sf).select("hash_key", "field", "value")
    rows.write.format("hash_store").option("path", path).mode("append").save()
    return custom_sink.read_committed(spark, path, "hash_key string, field string, value string")


@query(
    "sink_wide_row",
    calls_sql("""SELECT CAST(sid AS VARCHAR) AS rowkey, call_type, duration FROM (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY seq DESC) AS rn
      FROM calls) WHERE rn = 1"""),
)
def sink_wide_row(spark: SparkSession, sf: str) -> DataFrame:
    rows = wide_rows(calls(spark, sf), F.col("sid"), F.col("seq"), cf=F.struct("call_type", "duration"))
    store = KeyedTable(spark, work_path(spark, "wide"), rows.schema, ["rowkey"], "seq")
    store(rows, 0)
    return store.read().select("rowkey", "cf.call_type", "cf.duration")


