"""Streams fed file by file against the batch form of the same operator, and restarts."""

from __future__ import annotations

import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from compare import rows
from eddyline.operators import anchored, changelog, joins, overs, pairing, patterns, state, transforms, windows
from eddyline.plans import inputs, stream_queries
from eddyline.plans.states import ROW, envelopes
from eddyline.session import work_path
from eddyline.sinks import files as file_sinks
from eddyline.sinks import jdbc, messages
from eddyline.sinks.keyed import KeyedTable
from eddyline.sources import catalog, custom, files, kafka
from eddyline.sources.jdbc import JdbcTable
from eddyline.streaming import events, run, stateful

HOUR, DAY = inputs.HOUR, inputs.DAY
SLICES = 5


@pytest.fixture(scope="module")
def feed(spark, sf, tmp_path_factory):
    """`events` as a folder of files in event order, as `<folder>/events.parquet/`."""
    folder = str(tmp_path_factory.mktemp("feed"))
    table = inputs.table(spark, sf, "events").orderBy("event_id").toPandas()
    target = os.path.join(folder, "events.parquet")
    os.makedirs(target)
    size = -(-len(table) // SLICES)
    for i in range(SLICES):
        path = os.path.join(target, f"part-{i}.parquet")
        table.iloc[i * size : (i + 1) * size].astype({"ts": "datetime64[us]"}).to_parquet(path, index=False)
        os.utime(path, (1_700_000_000 + 10 * i,) * 2)
    return folder


@pytest.fixture()
def live(spark, feed):
    return stream_queries.stream_calls(spark, feed, files_per_batch=1)


@pytest.fixture()
def stored(spark, feed):
    return inputs.calls(spark, feed)


def stateful_rows(live, processor, schema, label, delay="0 seconds"):
    return run.drain(stateful.with_state(live.withWatermark("ts", delay), "sid", processor, schema), label)


def test_gap(live, stored):
    got = stateful_rows(live, stateful.PreviousGap(), "sid long, seq long, gap long", "gap")
    want = state.gap_to_previous(stored, "sid", "seq", "t", 100).where("gap is not null")
    assert rows(got, "sid", "seq", "gap") == rows(want, "sid", "seq", "gap")


def test_running_map(live, stored):
    got = stateful_rows(live, stateful.RunningMap(), "sid long, seq long, call_in int, total long", "map")
    finals = got.groupBy("sid", "call_in").agg(F.max_by("total", "seq").alias("total"))
    assert got.count() == stored.count()
    assert rows(finals) == rows(stored.groupBy("sid", "call_in").agg(F.sum("duration").alias("total")))


def test_running_average(live, stored):
    got = stateful_rows(live, stateful.RunningAverage(), "sid long, seq long, average double", "average")
    finals = got.groupBy("sid").agg(F.max_by("average", "seq").alias("average"))
    assert rows(finals) == rows(stored.groupBy("sid").agg(F.avg("duration").alias("average")))


def test_count_trigger(live, stored):
    got = stateful_rows(live, stateful.CountTrigger(3), "sid long, last_seq long, total long", "count")
    want = windows.count_windows(stored, ["sid"], "seq", 3, F.col("duration"), 100)
    assert rows(got, "sid", "last_seq", "total") == rows(want, "sid", "last_seq", "total")


def test_expiring_total(live, stored):
    got = stateful_rows(live, stateful.ExpiringTotal(12 * HOUR), "sid long, seq long, total long", "ttl")
    want = state.expiring_total(stored, "sid", "seq", "t", "duration", 12 * HOUR, 100)
    assert rows(got, "sid", "seq", "total") == rows(want, "sid", "seq", "total")


def test_strict_run(live, stored):
    got = stateful_rows(live, stateful.StrictRun("fail", 3), "sid long, t_first long, t_last long", "run")
    want = patterns.strict_sequence(stored, "sid", "seq", [F.col("call_type") == "fail"] * 3, {"a": (0, "t"), "b": (2, "t")}, 100)
    assert rows(got) == rows(want)


def test_times_within(live, stored):
    got = stateful_rows(
        live.where("call_type = 'fail'"), stateful.StrictRun("fail", 3, 4 * DAY), "sid long, t_first long, t_last long", "times"
    )
    want = patterns.times_within(stored, "sid", "seq", "t", F.col("call_type") == "fail", 3, 4 * DAY, 100)
    assert rows(got) == rows(want, "sid", "start_t", "end_t")


def test_greedy_before(live, stored):
    got = stateful_rows(
        live, stateful.GreedyBefore("fail", "success"), "sid long, start_seq long, n long, end_seq long", "greedy"
    )
    want = patterns.greedy_before(stored, "sid", "seq", "t", F.col("call_type") == "fail", F.col("call_type") == "success", 100)
    assert rows(got) == rows(want)


def test_lookup_on_a_stream(spark, sf, live, stored):
    people = inputs.table(spark, sf, "customer").where("c_custkey % 2 = 0").select("c_custkey", "c_name")

    def enriched(calls):
        return joins.lookup(calls.select("seq", "sid"), people, "sid", "c_custkey", {"c_name": F.lit("not found")})

    assert rows(run.drain(enriched(live), "lookup")) == rows(enriched(stored))


def test_persons_as_known_on_a_stream(spark, sf, tmp_path):
    """Versions and calls arrive mixed, over several files; a later version doesn't change earlier calls."""
    versions = inputs.table(spark, sf, "orders").selectExpr("o_custkey AS person", "o_orderkey AS seq", "o_orderpriority AS name")
    log = inputs.calls(spark, sf).select("seq", F.col("sid").cast("long").alias("sid"), F.col("call_in").cast("long").alias("call_in"))
    tagged = versions.withColumn("role", F.lit(None).cast("string"))
    for role, column in (("caller", "sid"), ("callee", "call_in")):
        tagged = tagged.unionByName(log.select(F.col(column).alias("person"), "seq", F.lit(role).alias("role"), F.lit(None).cast("string").alias("name")))
    table = tagged.where("person IS NOT NULL").orderBy("seq").toPandas()
    for i in range(4):
        part = table[(table.seq * 4 // (table.seq.max() + 1)) == i]
        path = f"{tmp_path}/part-{i}.parquet"
        part.to_parquet(path, index=False, schema=to_arrow_schema(tagged.schema))
        os.utime(path, (1_700_000_000 + 10 * i,) * 2)
    live = spark.readStream.schema(tagged.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    got = run.drain(stateful.with_state(live, "person", stateful.PersonAsKnown(), "seq long, role string, name string", time_mode="None"), "persons")
    found = joins.regrouped(got.selectExpr("seq AS _fact", "seq AS _at", "role AS _role", "name AS _value"), ["caller", "callee"], "call", "seq", "")
    want = joins.roles_as_of(log.withColumn("call", F.col("seq")), versions, "call", "seq", "person", "name", {"caller": "sid", "callee": "call_in"}, None)
    assert rows(found, "seq", "caller", "callee") == rows(want, "seq", "caller", "callee")
    assert want.where("caller <> ''").count() > 0


def test_slower_input_closes_windows(spark, feed, stored):
    def side(kind):
        return stream_queries.stream_calls(spark, feed).where(f"call_type = '{kind}'").select("ts")

    early = side("busy").where("ts < timestamp'2024-01-10'")
    got = run.drain(events.merged_counts(early, side("success"), "ts", "1 day", "0 seconds"), "merged")
    top = stored.where("call_type = 'busy' AND ts < timestamp_ntz'2024-01-10'").agg(F.max("t")).first()[0]
    last = got.agg(F.max(inputs.epoch_us(F.col("win_end")))).first()[0]
    assert top - DAY < last <= top


def test_late_rows_are_kept_apart(spark, tmp_path):
    """Windows of 5 s, 2 s disorder, 2 s lateness; after the row at 20 windows up to 16 are gone."""
    schema = spark.createDataFrame([], "t string, ts timestamp").schema
    sink = events.LateSplitter(spark, str(tmp_path), schema, "ts", "5 seconds", "2 SECONDS", "2 SECONDS")
    batches = [["01", "06"], ["20", "02"], ["16", "14", "11"], ["40"]]
    for i in (0, 1, 2, 2, 3):
        df = spark.createDataFrame([(s, f"2024-01-01 00:00:{s}") for s in batches[i]], "t string, ts string")
        sink(df.withColumn("ts", F.to_timestamp("ts")), i)
    assert rows(sink.read(late=True), "t") == [("11",), ("14",)]
    assert rows(sink.read(late=False), "t") == [("01",), ("02",), ("06",), ("16",), ("20",), ("40",)]


def test_allowed_lateness_updates_the_window(spark, tmp_path):
    """In update mode a window reports again for rows that are late by less than delay plus lateness."""
    for i, part in enumerate([("01",), ("07",), ("07",), ("03",)]):
        df = spark.createDataFrame([("a", f"2024-01-01 00:00:{s}", 1) for s in part], "sid string, ts string, duration long")
        df.withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        for root, _, names in os.walk(f"{tmp_path}/in/{i}"):
            for n in names:
                os.utime(os.path.join(root, n), (1_700_000_000 + 10 * i,) * 2)
    stream = spark.readStream.schema("sid string, ts timestamp, duration long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    totals = events.windowed_total(stream, "sid", "ts", "5 seconds", "4 seconds", "duration")
    got = run.drain(totals, "lateness", "update", ("sid", "win_start"))
    assert rows(got.select(F.date_format("win_start", "ss").alias("s"), "total")) == [("00", 2), ("05", 2)]


def last_watermark(stored, delay=0):
    return stored.agg(F.max("t")).first()[0] // 1000 * 1000 - delay


def test_anchored_timer(live, stored):
    got = stateful_rows(live, stateful.AnchoredTotal(DAY), "sid long, anchor long, total long, n long", "anchored")
    done = anchored.anchored_windows(stored, ["sid"], "t", DAY, F.col("duration"), DAY).where(
        F.col("fire_at") <= last_watermark(stored)
    )
    assert rows(got, "sid", "anchor", "total", "n") == rows(done, "sid", "anchor", "total", "n")


def test_silent_failure_timer(live, stored):
    got = stateful_rows(live, stateful.SilentFailure(12 * HOUR), "sid long, fail_t long, alert_t long", "silent")
    want = state.silent_failures(stored, "sid", "seq", "t", F.col("call_type") == "fail", 12 * HOUR, 100, DAY)
    assert rows(got) == rows(want.where(F.col("alert_t") <= last_watermark(stored)))


def test_timeout_timer(live, stored):
    got = stateful_rows(live, stateful.Timeouts("busy", "success", 4 * DAY), "sid long, start_seq long, end_seq long", "timeouts")
    want = patterns.followed_by_within(
        stored, "sid", "seq", "t", F.col("call_type") == "busy", F.col("call_type") == "success", 4 * DAY, 100
    )
    settled = F.col("end_seq").isNotNull() | (F.col("start_t") + 4 * DAY <= last_watermark(stored))
    later = got.join(want.where(~settled).select("start_seq"), "start_seq", "left_anti")
    assert rows(later, "sid", "start_seq", "end_seq") == rows(want.where(settled), "sid", "start_seq", "end_seq")


def test_slot_alert_timer(live, stored):
    """What the stream reports is what the batch form reports, and it has reported all that the watermark has passed."""
    got = stateful_rows(live, stateful.SlotAlert("busy", "success", DAY), "sid long, seq long, alert_t long", "slot")
    kinds = stored.where("call_type IN ('busy', 'success')")
    want = pairing.unpaired(kinds, ["sid"], "t", "seq", F.col("call_type") == "busy", DAY)
    found = rows(got, "sid", "seq", "alert_t")
    assert len(found) == len(set(found)) and set(found) <= set(rows(want.withColumn("alert_t", F.col("t") + DAY), "sid", "seq", "alert_t"))
    passed = want.where(F.col("t") + DAY < last_watermark(stored))
    assert set(rows(passed, "sid", "seq")) <= set(rows(got, "sid", "seq")) and passed.count() > 0


def test_changes_of_ranks(live, stored):
    """Every change takes away what the rank held; applied in order they end with the two largest values."""
    got = stateful_rows(live, stateful.RankChanges(2), "sid long, kind string, rank int, duration long", "ranks")
    ends = got.groupBy("sid", "rank").agg(F.sum(F.when(F.col("kind") == "+", F.col("duration")).otherwise(-F.col("duration"))).alias("duration"), F.sum(F.when(F.col("kind") == "+", 1).otherwise(-1)).alias("n"))
    want = overs.top_n(stored.select("sid", "duration"), ["sid"], 2, F.col("duration").desc())
    assert rows(ends.where("n = 1"), "sid", "rank", "duration") == rows(want, "sid", "rank", "duration") and ends.where("n <> 1").isEmpty()
    assert not got.where("kind = '-'").isEmpty()


def test_tumbling_windows_close_with_the_watermark(live, stored):
    got = run.drain(events.windowed_total(live, "sid", "ts", "1 day", "12 hours", "duration"), "tumble")
    want = events.windowed_total(stored.withColumn("ts", F.col("ts").cast("timestamp")), "sid", "ts", "1 day", "12 hours", "duration")
    closed = want.where(inputs.epoch_us(F.col("win_end")) <= last_watermark(stored, 12 * HOUR))
    assert rows(got) == rows(closed)


def test_update_mode_ends_with_the_batch_result(live, stored):
    totals = live.groupBy("sid").agg(F.sum("duration").alias("total"))
    got = run.drain(totals, "update", "update", ("sid",))
    assert rows(got) == rows(stored.groupBy("sid").agg(F.sum("duration").alias("total")))


def test_late_rows_are_dropped(spark, tmp_path):
    """A row of a closed window in a later file does not count. Spark moves the watermark between micro-batches and
    closes windows in the batch after that, so there is one file in between."""
    files_of = [("01", "04"), ("20",), ("21",), ("02",), ("40",)]
    times = [[f"2024-01-01 00:00:{s}" for s in part] for part in files_of]
    for i, part in enumerate(times):
        df = spark.createDataFrame([("a", t, 1) for t in part], "sid string, ts string, duration long")
        df.withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        for root, _, names in os.walk(f"{tmp_path}/in/{i}"):
            for n in names:
                os.utime(os.path.join(root, n), (1_700_000_000 + 10 * i,) * 2)
    stream = spark.readStream.schema("sid string, ts timestamp, duration long").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    got = run.drain(events.windowed_total(stream, "sid", "ts", "5 seconds", "2 seconds", "duration"), "late")
    assert rows(got.select(F.date_format("win_start", "ss").alias("s"), "total")) == [("00", 2), ("20", 2)]


def test_sessions(live, stored):
    got = run.drain(events.session_total(live, "sid", "ts", "12 hours", "0 seconds", "duration"), "sessions")
    want = windows.sessions(stored, ["sid"], "t", F.lit(12 * HOUR), F.col("duration"), DAY)
    closed = want.where(F.col("t_end") <= last_watermark(stored))
    times = [inputs.epoch_us(F.col(c)).alias(c) for c in ("win_start", "win_end")]
    assert rows(got.select("sid", *times, "total")) == rows(closed.select("sid", "t_start", "t_end", "total"))


def two_sides(calls):
    left = calls.where("call_type = 'signup'").select("sid", F.col("seq").alias("a"), F.col("ts").alias("at"))
    right = calls.where("call_type = 'busy'").select("sid", F.col("seq").alias("b"), F.col("ts").alias("bt"))
    return left, right


def test_interval_join(live, stored):
    left, right = two_sides(live)
    got = run.drain(events.interval_join(left, right, "sid", "at", "bt", "12 HOURS", "1 hour"), "interval")
    l, r = [d.withColumn("t", inputs.epoch_us(F.col(c))) for d, c in zip(two_sides(stored), ("at", "bt"))]
    want = joins.interval(l, r, ["sid"], "t", "t", -12 * HOUR, 12 * HOUR)
    assert rows(got, "a", "b") == rows(want, "a", "b")


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_outer", "full_outer"])
def test_window_join(live, stored, how):
    def sides(calls):
        left, right = two_sides(calls)
        right = right.select("sid", "bt").withColumnRenamed("bt", "ts")
        return left.withColumnRenamed("at", "ts"), right

    got = run.drain(events.window_join(*sides(live), "sid", "ts", "1 day", "0 seconds", how), "window-join")
    left, right = [joins.windowed(s, "ts", "1 day") for s in sides(stored)]
    want = left.join(right, ["sid", "win"], how)
    if how in ("left_outer", "full_outer"):  # unmatched rows appear when their window is closed
        closed = inputs.epoch_us(F.col("win.end")) <= last_watermark(stored)
        got, want = got.where(closed), want.where(closed)
    assert rows(got, "sid", "a") == rows(want, "sid", "a")


def test_counts_survive_a_restart(spark, tmp_path):
    """Stop, add a file, start again from the same checkpoint."""
    source, checkpoint, out = f"{tmp_path}/in", f"{tmp_path}/checkpoint", f"{tmp_path}/out"
    latest = {}
    for text in ("a b a", "b c"):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("append").text(source)
        counts = transforms.word_count(files.text_line_stream(spark, source), "value")
        run.start(counts, run.batch_folders(out), checkpoint, "update").awaitTermination()
        for r in run.read_batches(spark, out, counts.schema).orderBy("batch").collect():
            latest[r.word] = r.n
    assert latest == {"a": 2, "b": 2, "c": 1}


def test_state_survives_a_restart(spark, feed, stored, tmp_path):
    """The timer operator stopped after two files and continued gives the uninterrupted result."""
    source, out = f"{tmp_path}/events.parquet", f"{tmp_path}/out"
    os.makedirs(source)
    for batch in (range(0, 2), range(2, SLICES)):
        for i in batch:
            name = f"part-{i}.parquet"
            with open(f"{feed}/events.parquet/{name}", "rb") as a, open(f"{source}/{name}", "wb") as b:
                b.write(a.read())
            os.utime(f"{source}/{name}", (1_700_000_000 + 10 * i,) * 2)
        live = stream_queries.stream_calls(spark, str(tmp_path), files_per_batch=1).withWatermark("ts", "0 seconds")
        result = stateful.with_state(live, "sid", stateful.AnchoredTotal(DAY), "sid long, anchor long, total long, n long")
        run.start(result, run.batch_folders(out), f"{tmp_path}/checkpoint").awaitTermination()
    got = run.read_batches(spark, out, result.schema)
    done = anchored.anchored_windows(stored, ["sid"], "t", DAY, F.col("duration"), DAY).where(
        F.col("fire_at") <= last_watermark(stored)
    )
    assert rows(got, "sid", "anchor", "total", "n") == rows(done, "sid", "anchor", "total", "n")


def test_replayed_batches_change_nothing(spark, stored, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/t", stored.select("sid", "seq", "duration").schema, ["sid"], "seq")
    first, second = stored.where("seq < 500").select("sid", "seq", "duration"), stored.where("seq >= 500").select("sid", "seq", "duration")
    table(first, 0)
    table(second, 1)
    once = rows(table.read())
    table(second, 1)
    assert rows(table.read()) == once
    assert once == rows(changelog.latest_per_key(stored.select("sid", "seq", "duration"), ["sid"], F.col("seq")))
    assert rows(table.compact(f"{tmp_path}/c").read()) == once


def test_deleted_keys_stay_deleted_after_compaction(spark, tmp_path):
    schema = "id int, seq long, row_kind string"
    first = spark.createDataFrame([(1, 0, "+I"), (2, 1, "+I")], schema)
    table = KeyedTable(spark, f"{tmp_path}/t", first.schema, ["id"], "seq", kind="row_kind")
    table(first, 0)
    table(spark.createDataFrame([(1, 2, "-D")], schema), 1)
    assert rows(table.read(), "id") == [(2,)]
    assert rows(table.compact(f"{tmp_path}/c").read(), "id") == [(2,)]


def test_uncommitted_batches_are_invisible(spark, stored, tmp_path):
    part = stored.select("seq", "sid")
    table = file_sinks.TwoPhaseTable(spark, str(tmp_path), part.schema)
    table(part.where("seq < 10"), 0)
    table.prepare(part.where("seq >= 10"), 1)
    assert table.read().count() == 10
    table(part.where("seq >= 10"), 1)
    table(part.where("seq >= 10"), 1)
    assert table.read().count() == stored.count()


def test_partitions_appear_after_the_watermark(spark, tmp_path):
    schema = "seq long, ts timestamp"
    sink = None
    for batch, (seq, ts) in enumerate([(0, "2024-01-01 00:10:00"), (1, "2024-01-01 01:59:59"), (2, "2024-01-01 02:00:01")]):
        df = spark.createDataFrame([(seq, ts)], "seq long, ts string").withColumn("ts", F.to_timestamp("ts"))
        sink = sink or file_sinks.PartitionCommitter(spark, str(tmp_path), df.schema, "ts", "Asia/Shanghai")
        sink(df, batch)
        seen = rows(sink.read("0 SECONDS", "1 SECOND"), "dt", "hr", "seq")
        assert seen == [[], [("20240101", "08", 0)], [("20240101", "08", 0), ("20240101", "09", 1)]][batch]
    assert sink.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()


def test_small_files(spark, feed, tmp_path, live):
    lines = live.select("seq", "sid")
    file_sinks.csv_stream(lines, f"{tmp_path}/out", f"{tmp_path}/c", "|", rows_per_file=3).awaitTermination()
    back = spark.read.schema(lines.schema).option("sep", "|").csv(f"{tmp_path}/out")
    sizes = back.groupBy("_metadata.file_name").count()
    assert sizes.agg(F.max("count")).first()[0] == 3
    assert back.count() == inputs.calls(spark, feed).count()


def test_console_and_rolling_text(live, tmp_path):
    file_sinks.console(live.select("seq").where("seq < 3"), f"{tmp_path}/c").awaitTermination()
    file_sinks.rolling_text(live.select(F.col("seq").cast("string")), f"{tmp_path}/o", f"{tmp_path}/d", 100, every="1 second").stop()


def test_cdc_stream_restart(spark, sf, tmp_path):
    """Messages in two deliveries with a restart in between, the second file delivered with the first again in reach."""
    log = envelopes(spark, sf)
    source = f"{tmp_path}/in"
    for lower, upper in ((0, 400), (400, 10**9)):
        log.where(f"seq >= {lower} AND seq < {upper}").coalesce(1).write.mode("append").parquet(source)
        parsed = changelog.read_envelopes(spark.readStream.schema(log.schema).parquet(source), "value", ROW)
        keyed = parsed.select(F.coalesce("after.id", "before.id").alias("id"), "after.name", "after.age", "seq", "row_kind")
        target = KeyedTable(spark, f"{tmp_path}/t", keyed.schema, ["id"], "seq", kind="row_kind")
        run.start(keyed, target, f"{tmp_path}/c").awaitTermination()
    want = changelog.apply_envelopes(changelog.read_envelopes(log, "value", ROW), "id", "seq")
    assert rows(target.read(), "id", "name", "age") == rows(want, "id", "name", "age")


def test_catalog_stream_by_name(spark, stored):
    path = work_path(spark, "named")
    stored.select("seq", "sid").write.parquet(path)
    name = "named_" + path.rsplit("-", 1)[1]
    catalog.define(spark, name, files.Source("parquet", "seq bigint, sid bigint", path))
    assert run.drain(catalog.read_stream(spark, name), "by-name").count() == stored.count()


def test_custom_source_reads_every_file(spark, stored, tmp_path):
    custom.register(spark)
    lines = stored.select(F.concat_ws(",", "sid", "sid", "call_in", "call_type", "t", "duration").alias("value"))
    lines.repartition(3).write.text(f"{tmp_path}/logs")
    back = spark.read.format("call_log").load(f"{tmp_path}/logs")
    assert back.rdd.getNumPartitions() == 3 and back.count() == stored.count()


def test_kafka_decoding_keeps_nulls(spark):
    df = spark.createDataFrame([(None, bytearray(b"a,1")), (bytearray(b"7"), None)], "key binary, value binary")
    assert rows(kafka.keys_and_values(df)) == [("7", None), (None, "a,1")]
    assert rows(kafka.table_with_key(df, "id", "int", "w string, n int")) == [(7, None, None), (None, "a", 1)]


def test_upsert_log_with_tombstones(spark):
    log = spark.createDataFrame([(0, "a", "+I", 1), (1, "b", "+I", 2), (2, "a", "-D", None)], "seq long, k string, row_kind string, v int")
    encoded = messages.upsert_message(log, "k", "seq")
    assert rows(encoded, "key", "value") == [("a", '{"v":1}'), ("a", None), ("b", '{"v":2}')]
    assert rows(messages.compacted(encoded, "seq")) == [("b", '{"v":2}')]


class FakeTarget(jdbc.JdbcTarget):
    """Keeps what would be sent to the database; no database is started."""

    sent: list = []

    def append(self, batch):
        self.sent.append(rows(batch))


def test_jdbc_batches(spark):
    df = spark.createDataFrame([(1, 0, "x"), (1, 1, "y"), (2, 2, "z")], "id int, seq long, v string")
    target = FakeTarget("jdbc:some:url", "t", batch_size=1000)
    assert target.options()["batchsize"] == "1000"
    done: set[int] = set()
    write = jdbc.insert_once(target, done.__contains__, done.add)
    write(df, 0)
    write(df, 0)
    assert len(FakeTarget.sent) == 1 and FakeTarget.sent[0][0] == (1, 0, "x", 0)
    merged: list[int] = []
    jdbc.upsert_batches(target, ["id"], "seq", merged.append)(df, 5)
    assert FakeTarget.sent[1] == [(1, 1, "y", 5), (2, 2, "z", 5)] and merged == [5]
    scan = JdbcTable("jdbc:some:url", "t", "id", 0, 100, 4)
    assert scan.options()["partitionColumn"] == "id" and scan.options()["numPartitions"] == "4"


@pytest.mark.parametrize("unit, columns, published", [("minute", ["dt", "hr", "mm"], [0, 1]), ("second", ["dt", "hr", "mm", "ss"], [0, 1, 2])])
def test_fine_partitions_are_published_when_they_end(spark, tmp_path, unit, columns, published):
    start = datetime(2024, 1, 1, 0, 0, 10)
    data = [(i, start + timedelta(seconds=s)) for i, s in enumerate([0, 20, 60, 64])]
    df = spark.createDataFrame(data, "seq long, ts timestamp")
    sink = file_sinks.PartitionCommitter(spark, str(tmp_path), df.schema, "ts", "UTC", unit)
    sink(df, 0)
    assert sorted(r.seq for r in sink.read("1 SECOND", "1 SECOND").collect()) == published
    assert sink.publish("1 SECOND", "1 SECOND").columns == [*columns, "n"]
    with pytest.raises(ValueError):
        file_sinks.PartitionCommitter(spark, str(tmp_path), df.schema, "ts", "UTC", "week")


def test_rolling_files_hold_every_call(spark, sf):
    got = stream_queries.sink_rolling_file(spark, sf).cache()
    want = inputs.calls(spark, sf).select(files.delimited(["seq", "sid", "call_type", "duration"]).alias("value"))
    assert rows(got, "value") == rows(want)
    assert got.where("bounded AND enough").count() == got.count() == inputs.table(spark, sf, "events").count()
