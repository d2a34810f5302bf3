"""Queries: event patterns. `fail`, `success`, `busy` stand for the states of the original examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.operators import patterns
from eddyline.operators.skips import NEXT_ROW, PAST_LAST
from eddyline.plans.catalog import query
from eddyline.plans.inputs import DAY, calls, calls_sql, seq_width


def _is(state: str) -> Column:
    return F.col("call_type") == state


def _rows(spark: SparkSession, sf: str, *more: str) -> DataFrame:
    return calls(spark, sf).select("sid", "seq", "t", "call_type", *more)


@query(
    "cep_three_fails",
    calls_sql("""SELECT sid, t AS t1, t2, t3 FROM (SELECT *, lead(t) OVER w AS t2, lead(t, 2) OVER w AS t3, lead(call_type) OVER w AS c2,
      lead(call_type, 2) OVER w AS c3 FROM calls WINDOW w AS (PARTITION BY sid ORDER BY seq)) WHERE call_type = 'fail' AND c2 = 'fail' AND c3 = 'fail'"""),
)
def cep_three_fails(spark: SparkSession, sf: str) -> DataFrame:
    measures = {"t1": (0, "t"), "t2": (1, "t"), "t3": (2, "t")}
    return patterns.strict_sequence(_rows(spark, sf), "sid", "seq", [_is("fail")] * 3, measures, seq_width(spark, sf))


NEXT_SQL = """, n AS (SELECT *, lead(call_type) OVER (PARTITION BY sid ORDER BY seq) AS nxt, lead(seq) OVER (PARTITION BY sid ORDER BY seq) AS nxt_seq FROM calls)"""


@query("cep_next", calls_sql(f"{NEXT_SQL} SELECT sid, seq AS start_seq, nxt_seq AS end_seq FROM n WHERE call_type = 'busy' AND nxt = 'success'"))
def cep_next(spark: SparkSession, sf: str) -> DataFrame:
    measures = {"start_seq": (0, "seq"), "end_seq": (1, "seq")}
    return patterns.strict_sequence(_rows(spark, sf), "sid", "seq", [_is("busy"), _is("success")], measures, seq_width(spark, sf))


@query("cep_not_next", calls_sql(f"{NEXT_SQL} SELECT sid, seq AS start_seq FROM n WHERE call_type = 'busy' AND nxt <> 'success'"))
def cep_not_next(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.not_next(_rows(spark, sf), "sid", "seq", _is("busy"), _is("success"), seq_width(spark, sf))


@query(
    "cep_followed_by",
    calls_sql("""SELECT a.sid, a.seq AS start_seq, min(c.seq) AS end_seq FROM calls a JOIN calls c ON a.sid = c.sid AND c.seq > a.seq
      WHERE a.call_type = 'busy' AND c.call_type = 'success' GROUP BY ALL"""),
)
def cep_followed_by(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.followed_by(_rows(spark, sf), "sid", "seq", _is("busy"), _is("success"), seq_width(spark, sf))


@query(
    "cep_followed_by_any",
    calls_sql("""SELECT a.sid, a.seq AS start_seq, count(*) AS n, min(c.seq) AS first_end, max(c.seq) AS last_end FROM calls a JOIN calls c
      ON a.sid = c.sid AND c.seq > a.seq WHERE a.call_type = 'busy' AND c.call_type = 'success' GROUP BY ALL"""),
)
def cep_followed_by_any(spark: SparkSession, sf: str) -> DataFrame:
    rows = calls(spark, sf, "busy", "success").select("sid", "seq", "call_type")
    return patterns.later_ends(rows, "sid", "seq", _is("busy"), _is("success"), seq_width(spark, sf))


@query(
    "cep_not_followed_by",
    calls_sql(f"""SELECT sid, seq AS start_seq FROM calls a WHERE call_type = 'busy' AND NOT EXISTS (SELECT 1 FROM calls c
      WHERE c.sid = a.sid AND c.seq > a.seq AND c.call_type = 'success' AND c.t - a.t < {2 * DAY})"""),
)
def cep_not_followed_by(spark: SparkSession, sf: str) -> DataFrame:
    found = patterns.followed_by_within(
        _rows(spark, sf), "sid", "seq", "t", _is("busy"), _is("success"), 2 * DAY, seq_width(spark, sf)
    )
    return found.where("end_seq IS NULL").select("sid", "start_seq")


@query(
    "cep_timeout_side",
    calls_sql(f"""SELECT sid, seq AS start_seq, pay AS end_seq, CASE WHEN pay IS NULL THEN 'timeout' ELSE 'paid' END AS outcome FROM
      (SELECT sid, seq, (SELECT min(c.seq) FROM calls c WHERE c.sid = a.sid AND c.seq > a.seq AND c.call_type = 'success'
        AND c.t - a.t < {4 * DAY}) AS pay FROM calls a WHERE call_type = 'busy')"""),
)
def cep_timeout_side(spark: SparkSession, sf: str) -> DataFrame:
    found = patterns.followed_by_within(
        _rows(spark, sf), "sid", "seq", "t", _is("busy"), _is("success"), 4 * DAY, seq_width(spark, sf)
    )
    outcome = F.when(F.col("end_seq").isNull(), "timeout").otherwise("paid")
    return found.select("sid", "start_seq", "end_seq", outcome.alias("outcome"))


@query(
    "cep_times_within",
    calls_sql(f"""SELECT sid, seq AS start_seq, t AS start_t, s3 AS end_seq, t3 AS end_t FROM (SELECT *, lead(t, 2) OVER w AS t3, lead(seq, 2) OVER w AS s3
      FROM calls WHERE call_type = 'fail' WINDOW w AS (PARTITION BY sid ORDER BY seq)) WHERE t3 - t < {4 * DAY}"""),
)
def cep_times_within(spark: SparkSession, sf: str) -> DataFrame:
    fails = calls(spark, sf, "fail").select("sid", "seq", "t", "call_type")
    return patterns.times_within(fails, "sid", "seq", "t", _is("fail"), 3, 4 * DAY, seq_width(spark, sf))


@query(
    "cep_one_or_more_until",
    calls_sql(""", p AS (SELECT *, count(*) FILTER (call_type = 'success') OVER (PARTITION BY sid ORDER BY seq) AS part FROM calls)
      SELECT a.sid, a.seq AS start_seq, count(*) AS n, max(b.seq) AS last_seq FROM p a JOIN p b ON a.sid = b.sid AND a.part = b.part
        AND b.seq >= a.seq WHERE a.call_type = 'busy' AND b.call_type = 'busy' GROUP BY ALL"""),
)
def cep_one_or_more_until(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.prefixes_until(_rows(spark, sf), "sid", "seq", _is("busy"), _is("success"), seq_width(spark, sf))


@query(
    "cep_consecutive",
    calls_sql(""", r AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY seq) AS rn FROM calls),
      c AS (SELECT *, rn - row_number() OVER (PARTITION BY sid ORDER BY seq) AS island FROM r WHERE call_type = 'fail'),
      f AS (SELECT a.sid, a.seq AS start_seq, min(c.seq) AS item_seq FROM calls a JOIN c ON a.sid = c.sid AND c.seq > a.seq
        WHERE a.call_type = 'busy' GROUP BY ALL)
      SELECT f.sid, f.start_seq, f.item_seq, count(*) AS n FROM f JOIN c h ON h.seq = f.item_seq
        JOIN c l ON l.sid = h.sid AND l.island = h.island AND l.rn >= h.rn GROUP BY ALL"""),
)
def cep_consecutive(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.followed_by_consecutive(_rows(spark, sf), "sid", "seq", _is("busy"), _is("fail"), seq_width(spark, sf))


@query(
    "cep_allow_combinations",
    calls_sql(""", f AS (SELECT a.sid, a.seq AS start_seq, min(c.seq) AS mid_seq FROM calls a JOIN calls c ON a.sid = c.sid
        AND c.seq > a.seq WHERE a.call_type = 'busy' AND c.call_type = 'success' GROUP BY ALL)
      SELECT f.sid, f.start_seq, f.mid_seq, count(*) AS n, max(c.seq) AS last_end FROM f JOIN calls c ON c.sid = f.sid AND c.seq > f.mid_seq
        AND c.call_type = 'success' GROUP BY ALL"""),
)
def cep_allow_combinations(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.later_combinations(_rows(spark, sf), "sid", "seq", _is("busy"), _is("success"), seq_width(spark, sf))


RUNS_SQL = """, nx AS (SELECT sid, seq, t, call_type, min(CASE WHEN call_type = 'success' THEN seq END) OVER (PARTITION BY sid ORDER BY seq
    ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS end_seq, min(CASE WHEN call_type = 'success' THEN t END) OVER (PARTITION BY sid
    ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS end_t FROM calls),
  it AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY seq) AS no FROM nx WHERE call_type = 'fail'),
  k AS (SELECT * FROM it WHERE end_seq IS NOT NULL)"""


@query(
    "cep_greedy_prefix",
    calls_sql(f"{RUNS_SQL} SELECT sid, seq AS start_seq, count(*) OVER (PARTITION BY sid, end_seq ORDER BY seq DESC) AS n, end_seq FROM k"),
)
def cep_greedy_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.greedy_before(_rows(spark, sf), "sid", "seq", "t", _is("fail"), _is("success"), seq_width(spark, sf))


@query(
    "cep_skip_strategy",
    calls_sql(f"""{RUNS_SQL}, st AS (SELECT sid, end_seq, min(seq) AS f, max(seq) AS l, count(*) AS c FROM k GROUP BY ALL),
      pr AS (SELECT a.sid, a.seq AS start_seq, a.end_seq, count(*) AS c, count(*) FILTER (b.end_seq = a.end_seq) AS own
        FROM k a JOIN k b ON a.sid = b.sid AND b.seq >= a.seq GROUP BY ALL)
      SELECT 'none' AS strategy, sid, start_seq, c AS matches, c AS longest, end_seq FROM pr
      UNION ALL SELECT 'to_next', sid, start_seq, 1, own, end_seq FROM pr
      UNION ALL SELECT 'past_last', sid, f, 1, c, end_seq FROM st
      UNION ALL SELECT 'to_first', sid, start_seq, own, own, end_seq FROM pr
      UNION ALL SELECT 'to_last', sid, f, 1, c, end_seq FROM st
      UNION ALL SELECT 'to_last', sid, l, 1, 1, end_seq FROM st WHERE c > 1"""),
)
def cep_skip_strategy(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.skip_strategies(_rows(spark, sf), "sid", "seq", "t", _is("fail"), _is("success"), seq_width(spark, sf))


@query(
    "mr_fixed_count",
    calls_sql("""SELECT sid, t AS first_fail_t, t2 AS second_fail_t, t3 AS success_t FROM (SELECT *, lead(t) OVER w AS t2, lead(t, 2) OVER w AS t3,
      lead(call_type) OVER w AS c2, lead(call_type, 2) OVER w AS c3 FROM calls WINDOW w AS (PARTITION BY sid ORDER BY seq))
      WHERE call_type = 'fail' AND c2 = 'fail' AND c3 = 'success'"""),
)
def mr_fixed_count(spark: SparkSession, sf: str) -> DataFrame:
    """(A{2} B). Matches cannot overlap because B is no A, so the skip clause never removes one."""
    measures = {"first_fail_t": (0, "t"), "second_fail_t": (1, "t"), "success_t": (2, "t")}
    conditions = [_is("fail"), _is("fail"), _is("success")]
    return patterns.strict_sequence(_rows(spark, sf), "sid", "seq", conditions, measures, seq_width(spark, sf))


@query(
    "mr_within",
    calls_sql(f""", s AS (SELECT *, min(CASE WHEN call_type <> 'fail' THEN seq END) OVER (PARTITION BY sid ORDER BY seq
        ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS stop FROM calls),
      m AS (SELECT s.sid, b.seq AS end_seq, s.seq AS start_seq FROM s JOIN calls b ON b.seq = s.stop
        WHERE s.call_type = 'fail' AND b.call_type = 'success' AND b.t - s.t < {DAY}),
      c AS (SELECT *, count(*) OVER (PARTITION BY sid, end_seq ORDER BY start_seq DESC) AS n, min(start_seq) OVER (PARTITION BY sid, end_seq) AS head FROM m)
      SELECT 'past last row' AS skip, sid, end_seq, start_seq, n FROM c WHERE start_seq = head
      UNION ALL SELECT 'to next row' AS skip, sid, end_seq, start_seq, n FROM c"""),
)
def mr_within(spark: SparkSession, sf: str) -> DataFrame:
    """A+ B WITHIN a day under two skip clauses."""
    rows, width = _rows(spark, sf), seq_width(spark, sf)
    found = [patterns.run_then_within(rows, "sid", "seq", "t", _is("fail"), _is("success"), DAY, width, c).withColumn("skip", F.lit(c)) for c in (PAST_LAST, NEXT_ROW)]
    return found[0].unionByName(found[1])


@query(
    "mr_reluctant",
    calls_sql(
        """, r AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY seq) AS rn FROM calls),
      st AS (SELECT skip, sid, rn, seq, t, duration, CASE WHEN duration > 10 THEN seq END AS start_seq, NULL::BIGINT AS hit
          FROM r, (VALUES ('past last row'), ('to last C')) AS v(skip) WHERE rn = 1
        UNION ALL
        SELECT st.skip, r.sid, r.rn, r.seq, r.t, r.duration,
          CASE WHEN st.start_seq IS NOT NULL AND r.duration > 12 THEN CASE WHEN st.skip = 'to last C' THEN r.seq END
               WHEN st.start_seq IS NOT NULL AND r.duration < 15 THEN st.start_seq
               WHEN r.duration > 10 THEN r.seq END AS start_seq,
          CASE WHEN r.duration > 12 THEN st.start_seq END AS hit
        FROM st JOIN r ON r.sid = st.sid AND r.rn = st.rn + 1)
      SELECT skip, sid, hit AS start_seq, seq AS end_seq, t, duration FROM st WHERE hit IS NOT NULL""",
        recursive=True,
    ),
)
def mr_reluctant(spark: SparkSession, sf: str) -> DataFrame:
    """A B*? C under two skip clauses; every C row is an A row as well, so a search that goes on at C starts with it."""
    x, rows, width = F.col("duration"), _rows(spark, sf, "duration"), seq_width(spark, sf)
    found = [
        patterns.reluctant_from_any(rows, "sid", "seq", x > 10, x < 15, x > 12, ["t", "duration"], width, c).withColumn("skip", F.lit(c))
        for c in (PAST_LAST, "to last C")
    ]
    return found[0].unionByName(found[1])


@query(
    "mr_define_agg",
    calls_sql(
        """, r AS (SELECT *, row_number() OVER (PARTITION BY sid ORDER BY seq) AS rn FROM calls),
      st AS (SELECT sid, rn, seq, CASE WHEN duration < 10 THEN duration END AS s, CASE WHEN duration < 10 THEN 1 ELSE 0 END AS c,
          seq AS start_seq, NULL::BIGINT AS last_seq, NULL::BIGINT AS total, NULL::BIGINT AS n FROM r WHERE rn = 1
        UNION ALL
        SELECT r.sid, r.rn, r.seq,
          CASE WHEN coalesce(st.s, 0) + r.duration < 10 * (st.c + 1) THEN coalesce(st.s, 0) + r.duration END AS s,
          CASE WHEN coalesce(st.s, 0) + r.duration < 10 * (st.c + 1) THEN st.c + 1 ELSE 0 END AS c,
          CASE WHEN st.c = 0 THEN r.seq ELSE st.start_seq END AS start_seq,
          CASE WHEN st.c > 0 AND st.s + r.duration >= 10 * (st.c + 1) THEN st.seq END AS last_seq,
          CASE WHEN st.c > 0 AND st.s + r.duration >= 10 * (st.c + 1) THEN st.s END AS total,
          CASE WHEN st.c > 0 AND st.s + r.duration >= 10 * (st.c + 1) THEN st.c END AS n
        FROM st JOIN r ON r.sid = st.sid AND r.rn = st.rn + 1)
      SELECT sid, start_seq, last_seq, seq AS end_seq, total, n FROM st WHERE n IS NOT NULL""",
        recursive=True,
    ),
)
def mr_define_agg(spark: SparkSession, sf: str) -> DataFrame:
    return patterns.average_below(_rows(spark, sf, "duration"), "sid", "seq", "duration", 10, seq_width(spark, sf))
