"""Skip clauses against a search that goes through each key's rows."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eddyline.operators import patterns, skips


def search(rows, match, resume):
    """Per key from the first row on: the match that starts at a row, if any, and where to go on."""
    out, by_key = [], defaultdict(list)
    for r in sorted(rows, key=lambda r: r[1]):
        by_key[r[0]].append(r)
    for k, rs in by_key.items():
        i = 0
        while i < len(rs):
            end = match(rs, i)
            if end is None:
                i += 1
                continue
            out.append((k, rs[i][1], rs[end][1]))
            i = resume(i, end)
    return sorted(out)


@pytest.fixture(params=[10_000, 5], ids=["one batch", "small batches"])
def batches(spark, request):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, request.param)
    yield
    spark.conf.set(name, before)


def data(n, seed, values):
    rnd = random.Random(seed)
    return [(rnd.choice(["hot", "hot", "a", "b", "c"]), i, rnd.choice(values)) for i in rnd.sample(range(4 * n), n)]


@pytest.mark.parametrize("clause", [skips.PAST_LAST, skips.NEXT_ROW, "to last C", "to first C"])
def test_reluctant_under_any_clause(spark, batches, clause):
    rows = data(300, 1, [8, 11, 12, 13, 14, 16, 20])
    a, b, c = (lambda x: x > 10), (lambda x: x < 13 or x > 18), (lambda x: x > 12)

    def match(rs, i):
        if not a(rs[i][2]):
            return None
        for j in range(i + 1, len(rs)):
            if c(rs[j][2]):
                return j
            if not b(rs[j][2]):
                return None
        return None

    resume = {skips.PAST_LAST: lambda i, e: e + 1, skips.NEXT_ROW: lambda i, e: i + 1}.get(clause, lambda i, e: e)
    x = F.col("x")
    df = spark.createDataFrame(rows, "k string, seq long, x long").repartition(3)
    got = patterns.reluctant_from_any(df, "k", "seq", x > 10, (x < 13) | (x > 18), x > 12, ["x"], None, clause)
    assert sorted((r.k, r.start_seq, r.end_seq) for r in got.collect()) == search(rows, match, resume)


@pytest.mark.parametrize("clause", [skips.PAST_LAST, skips.NEXT_ROW, "to last end"])
def test_run_within_under_any_clause(spark, batches, clause):
    rows = data(300, 2, ["A", "A", "A", "E", "x"])

    def match(rs, i):
        j = i
        while j < len(rs) and rs[j][2] == "A":
            j += 1
        return j if i < j < len(rs) and rs[j][2] == "E" and rs[j][1] - rs[i][1] < 12 else None

    resume = {skips.PAST_LAST: lambda i, e: e + 1, skips.NEXT_ROW: lambda i, e: i + 1, "to last end": lambda i, e: e}[clause]
    df = spark.createDataFrame(rows, "k string, seq long, c string").withColumn("t", F.col("seq")).repartition(3)
    got = patterns.run_then_within(df, "k", "seq", "t", F.col("c") == "A", F.col("c") == "E", 12, None, clause).collect()
    assert sorted((r.k, r.start_seq, r.end_seq) for r in got) == search(rows, match, resume)
    order = {k: sorted(s for kk, s, _ in rows if kk == k) for k in {r[0] for r in rows}}
    assert all(r.n == order[r.k].index(r.end_seq) - order[r.k].index(r.start_seq) for r in got)


def test_chain_of_overlapping_matches(spark, batches):
    """One stretch for a whole key: every match overlaps the next, and every second one is taken."""
    df = spark.range(1000).select(F.lit("k").alias("k"), F.col("id").alias("s")).repartition(5)
    assert sorted(r.s for r in skips.taken(df, "k", "s", F.col("s") + 2, None).collect()) == list(range(0, 1000, 2))
    far = F.when(F.col("s") % 7 == 0, F.col("s") + 10).otherwise(F.col("s") + 1)
    want, at = [], 0
    while at < 1000:
        want.append(at)
        at += 10 if at % 7 == 0 else 1
    assert sorted(r.s for r in skips.taken(df, "k", "s", far, None).collect()) == want


def test_a_search_that_stays_is_an_error(spark):
    df = spark.createDataFrame([("k", 1, "A"), ("k", 2, "E")], "k string, seq long, c string").withColumn("t", F.col("seq"))
    item, end = F.col("c") == "A", F.col("c") == "E"
    with pytest.raises(Exception, match="does not go on"):
        patterns.run_then_within(df, "k", "seq", "t", item, end, 12, None, "to last item").collect()
    with pytest.raises(ValueError, match="unknown skip clause"):
        patterns.run_then_within(df, "k", "seq", "t", item, end, 12, None, "to last Z")
