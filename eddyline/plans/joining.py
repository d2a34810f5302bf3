"""Queries: window, interval, lookup, as-of and alert joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.operators import joins, pairing
from eddyline.plans.catalog import query
from eddyline.plans.inputs import DAY, HOUR, calls, calls_sql, seq_width, table, time_width

NEAR = 12 * HOUR


@query(
    "join_full_outer",
    "SELECT coalesce(c_custkey, o_custkey) AS custkey, c_nationkey, o_orderkey FROM customer FULL JOIN orders ON c_custkey = o_custkey",
)
def join_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    people = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"), "c_nationkey")
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey"), "o_orderkey")
    return joins.full_outer(people, orders, ["custkey"])


def _interval_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    signups = calls(spark, sf, "signup").select("sid", F.col("seq").alias("login_seq"), F.col("t").alias("login_t"))
    clicks = calls(spark, sf, "busy").select("sid", F.col("seq").alias("click_seq"), F.col("t").alias("click_t"), "call_in")
    return signups, clicks


def _interval_sql(upper: str) -> str:
    return calls_sql(f"""SELECT l.sid, l.seq AS login_seq, l.t AS login_t, r.seq AS click_seq, r.t AS click_t, r.call_in
      FROM calls l JOIN calls r ON l.sid = r.sid AND l.call_type = 'signup' AND r.call_type = 'busy'
      AND l.t >= r.t - {NEAR} AND l.t {upper} r.t + {NEAR}""")


@query("join_interval_closed", _interval_sql("<="))
def join_interval_closed(spark: SparkSession, sf: str) -> DataFrame:
    return joins.interval(*_interval_inputs(spark, sf), ["sid"], "login_t", "click_t", -NEAR, NEAR)


@query("join_interval_half_open", _interval_sql("<"))
def join_interval_half_open(spark: SparkSession, sf: str) -> DataFrame:
    return joins.interval(*_interval_inputs(spark, sf), ["sid"], "login_t", "click_t", -NEAR, NEAR, upper_inclusive=False)


def _window_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    clicks = calls(spark, sf, "busy").select("sid", "ts", F.col("seq").alias("click_seq"), F.col("duration").alias("click_x"))
    buys = calls(spark, sf, "success").select("sid", "ts", F.col("seq").alias("buy_seq"), F.col("duration").alias("buy_x"))
    return joins.windowed(clicks, "ts", "1 day"), joins.windowed(buys, "ts", "1 day")


WINDOW_SQL = """, l AS (SELECT sid, date_trunc('day', ts) AS win_start, seq AS click_seq, duration AS click_x FROM calls WHERE call_type = 'busy'),
  r AS (SELECT sid, date_trunc('day', ts) AS win_start, seq AS buy_seq, duration AS buy_x FROM calls WHERE call_type = 'success')"""


def _window_result(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("sid", F.col("win.start").alias("win_start"), *columns)


@query(
    "join_window_inner",
    calls_sql(f"{WINDOW_SQL} SELECT sid, win_start, click_seq, buy_seq FROM l JOIN r USING (sid, win_start)"),
)
def join_window_inner(spark: SparkSession, sf: str) -> DataFrame:
    return _window_result(joins.window_join(*_window_inputs(spark, sf), ["sid"]), "click_seq", "buy_seq")


@query(
    "join_window_full",
    calls_sql(f"""{WINDOW_SQL} SELECT coalesce(l.sid, r.sid) AS sid, coalesce(l.win_start, r.win_start) AS win_start, click_seq, buy_seq
      FROM l FULL JOIN r ON l.sid = r.sid AND l.win_start = r.win_start"""),
)
def join_window_full(spark: SparkSession, sf: str) -> DataFrame:
    return _window_result(joins.window_join(*_window_inputs(spark, sf), ["sid"], "full"), "click_seq", "buy_seq")


@query("join_window_semi", calls_sql(f"{WINDOW_SQL} SELECT sid, win_start, click_seq FROM l SEMI JOIN r USING (sid, win_start)"))
def join_window_semi(spark: SparkSession, sf: str) -> DataFrame:
    return _window_result(joins.window_join(*_window_inputs(spark, sf), ["sid"], "left_semi"), "click_seq")


@query("join_window_anti", calls_sql(f"{WINDOW_SQL} SELECT sid, win_start, click_seq FROM l ANTI JOIN r USING (sid, win_start)"))
def join_window_anti(spark: SparkSession, sf: str) -> DataFrame:
    return _window_result(joins.window_join(*_window_inputs(spark, sf), ["sid"], "left_anti"), "click_seq")


@query(
    "join_window_cogroup",
    calls_sql(f"""{WINDOW_SQL}, a AS (SELECT sid, win_start, count(*) AS n_click, CAST(sum(click_x) AS BIGINT) AS click_total FROM l GROUP BY ALL),
      b AS (SELECT sid, win_start, count(*) AS n_buy, CAST(sum(buy_x) AS BIGINT) AS buy_total FROM r GROUP BY ALL)
      SELECT coalesce(a.sid, b.sid) AS sid, coalesce(a.win_start, b.win_start) AS win_start, n_click, click_total, n_buy, buy_total
      FROM a FULL JOIN b ON a.sid = b.sid AND a.win_start = b.win_start"""),
)
def join_window_cogroup(spark: SparkSession, sf: str) -> DataFrame:
    left, right = _window_inputs(spark, sf)
    out = joins.window_cogroup(
        left, right, ["sid"],
        [F.count(F.lit(1)).alias("n_click"), F.sum("click_x").alias("click_total")],
        [F.count(F.lit(1)).alias("n_buy"), F.sum("buy_x").alias("buy_total")],
    )
    return _window_result(out, "n_click", "click_total", "n_buy", "buy_total")


def _people(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers by number: far fewer than users, so most lookups miss."""
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("person"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))


PEOPLE_SQL = ", people AS (SELECT s_suppkey AS person, s_name AS name, s_nationkey AS nation FROM supplier)"


@query("join_lookup", calls_sql(f"{PEOPLE_SQL} SELECT seq, sid, name, nation FROM calls LEFT JOIN people ON sid = person"))
def join_lookup(spark: SparkSession, sf: str) -> DataFrame:
    nothing = {"name": F.lit(None), "nation": F.lit(None)}
    return joins.lookup(calls(spark, sf).select("seq", "sid"), _people(spark, sf), "sid", "person", nothing)


ROLES = {"caller": ("sid", "name"), "callee": ("call_in", "name")}
ROLES_SQL = """SELECT seq, sid, call_in, coalesce(a.name, '') AS caller, coalesce(b.name, '') AS callee
  FROM calls LEFT JOIN people a ON sid = a.person LEFT JOIN people b ON call_in = b.person"""


@query("join_lookup_two_roles", calls_sql(f"{PEOPLE_SQL} {ROLES_SQL}"))
def join_lookup_two_roles(spark: SparkSession, sf: str) -> DataFrame:
    return joins.lookup_roles(calls(spark, sf).select("seq", "sid", "call_in"), _people(spark, sf), "person", ROLES)


@query(
    "join_broadcast_state",
    calls_sql(""", r AS (SELECT seq, 'caller' AS role, CAST(sid AS BIGINT) AS person FROM calls UNION ALL SELECT seq, 'callee', call_in FROM calls),
      k AS (SELECT r.seq, r.role, o.o_orderpriority AS name FROM r ASOF LEFT JOIN orders o ON r.person = o.o_custkey AND r.seq >= o.o_orderkey)
      SELECT seq, max(sid) AS sid, max(call_in) AS call_in, coalesce(max(name) FILTER (WHERE role = 'caller'), '') AS caller,
             coalesce(max(name) FILTER (WHERE role = 'callee'), '') AS callee FROM k JOIN calls USING (seq) GROUP BY seq"""),
)
def join_broadcast_state(spark: SparkSession, sf: str) -> DataFrame:
    """The other side is a stream of versions of each person (here: orders, which arrive among the calls by number); a call sees both persons as known
    when it arrives."""
    versions = table(spark, sf, "orders").select(F.col("o_custkey").alias("person"), F.col("o_orderkey").alias("seq"), F.col("o_orderpriority").alias("name"))
    log = calls(spark, sf).select("seq", F.struct("seq", "sid", "call_in").alias("call"), "sid", "call_in")
    found = joins.roles_as_of(log, versions, "call", "seq", "person", "name", {"caller": "sid", "callee": "call_in"}, seq_width(spark, sf))
    return found.select("call.seq", "call.sid", "call.call_in", "caller", "callee")


@query("join_lookup_async", calls_sql(f"{PEOPLE_SQL} SELECT seq, sid, coalesce(name, 'not found') AS name FROM calls LEFT JOIN people ON sid = person"))
def join_lookup_async(spark: SparkSession, sf: str) -> DataFrame:
    """One bulk join instead of a request per row; `seq` keeps the order for ordered output."""
    return joins.lookup(calls(spark, sf).select("seq", "sid"), _people(spark, sf), "sid", "person", {"name": F.lit("not found")})


@query(
    "join_broadcast_map",
    calls_sql("""SELECT seq, sid, n_name, coalesce(r_name, 'unknown') AS region FROM calls LEFT JOIN supplier ON sid = s_suppkey
       LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""),
)
def join_broadcast_map(spark: SparkSession, sf: str) -> DataFrame:
    """Every call looked up in a table of suppliers, nations and regions; callers that are no supplier have none."""
    nations, regions = table(spark, sf, "nation"), table(spark, sf, "region")
    log = calls(spark, sf).select("seq", "sid")
    placed = joins.lookup(log, table(spark, sf, "supplier"), "sid", "s_suppkey", {"s_nationkey": F.lit(None)})
    named = joins.lookup(placed, nations, "s_nationkey", "n_nationkey", {"n_name": F.lit(None), "n_regionkey": F.lit(None)})
    full = joins.lookup(named, regions, "n_regionkey", "r_regionkey", {"r_name": F.lit("unknown")})
    return full.select("seq", "sid", "n_name", F.col("r_name").alias("region"))


def _visits(spark: SparkSession, sf: str) -> DataFrame:
    return calls(spark, sf, "busy").select("sid", "t", "seq")


@query(
    "join_temporal_function",
    calls_sql("""SELECT f.seq, f.sid, f.t, v.duration AS price FROM (SELECT * FROM calls WHERE call_type = 'busy') f
      ASOF JOIN (SELECT * FROM calls WHERE call_type = 'barring') v ON f.sid = v.sid AND f.t >= v.t"""),
)
def join_temporal_function(spark: SparkSession, sf: str) -> DataFrame:
    prices = calls(spark, sf, "barring").select("sid", "t", "seq", F.col("duration").alias("price"))
    out = joins.as_of(_visits(spark, sf), prices, ["sid"], "t", ["price"], time_width(spark, sf), tie="seq")
    return out.select("seq", "sid", "t", "price")


@query(
    "join_temporal_for_system_time",
    calls_sql("""SELECT f.seq, f.sid, f.t, v.duration AS price FROM (SELECT * FROM calls WHERE call_type = 'busy') f
      ASOF JOIN (SELECT * FROM calls WHERE call_type IN ('barring', 'fail')) v ON f.sid = v.sid AND f.t >= v.t
      WHERE v.call_type <> 'fail'"""),
)
def join_temporal_for_system_time(spark: SparkSession, sf: str) -> DataFrame:
    """Versions from a change log; a delete ends the version."""
    prices = calls(spark, sf, "barring", "fail").select(
        "sid", "t", "seq", F.col("duration").alias("price"), (F.col("call_type") == "fail").alias("gone")
    )
    out = joins.as_of(_visits(spark, sf), prices, ["sid"], "t", ["price"], time_width(spark, sf), tie="seq", deleted="gone")
    return out.select("seq", "sid", "t", "price")


# the slot of each key, row by row: what waits after the row, and what waited in vain before it
SLOTS_SQL = f"""{{body}}, e AS (SELECT sid, seq, t, call_type AS kind, row_number() OVER (PARTITION BY sid ORDER BY t, seq) AS rn FROM calls WHERE call_type IN ('busy', 'success')),
  m AS (
    SELECT sid, rn, kind AS w_kind, seq AS w_seq, t AS w_t, NULL::VARCHAR AS lost_kind, NULL::BIGINT AS lost_seq, NULL::BIGINT AS lost_t FROM e WHERE rn = 1
    UNION ALL
    SELECT e.sid, e.rn, CASE WHEN pair THEN NULL ELSE e.kind END, CASE WHEN pair THEN NULL ELSE e.seq END, CASE WHEN pair THEN NULL ELSE e.t END,
           CASE WHEN late THEN w_kind END, CASE WHEN late THEN w_seq END, CASE WHEN late THEN w_t END
    FROM (SELECT m.*, e.t - m.w_t > {DAY} AS late, coalesce(m.w_kind <> e.kind AND e.t - m.w_t <= {DAY}, false) AS pair FROM m JOIN e ON e.sid = m.sid AND e.rn = m.rn + 1) m
    JOIN e ON e.sid = m.sid AND e.rn = m.rn + 1),
  lost AS (
    SELECT sid, lost_kind AS kind, lost_seq AS seq, lost_t AS t FROM m WHERE lost_kind IS NOT NULL
    UNION ALL SELECT sid, w_kind, w_seq, w_t FROM m WHERE w_kind IS NOT NULL AND NOT EXISTS (SELECT 1 FROM e WHERE e.sid = m.sid AND e.rn = m.rn + 1))
  SELECT CASE kind WHEN 'busy' THEN 'unpaid' ELSE 'no_order' END AS alert, sid, seq, t FROM lost"""


@query("join_order_pay_timeout", calls_sql(SLOTS_SQL.format(body=""), recursive=True))
def join_order_pay_timeout(spark: SparkSession, sf: str) -> DataFrame:
    """Orders (busy) and payments (success) meet one to one; who waits longer than a day is reported."""
    rows = calls(spark, sf, "busy", "success").select("sid", "seq", "t", "call_type")
    lost = pairing.unpaired(rows, ["sid"], "t", "seq", F.col("call_type") == "busy", DAY)
    return lost.select(F.when(F.col("is_left"), "unpaid").otherwise("no_order").alias("alert"), "sid", "seq", "t")
