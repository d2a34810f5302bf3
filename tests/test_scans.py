"""Ordered reductions and scans with non-commutative functions, against a plain loop over each key's rows."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eddyline.operators import blocks, pairing, scans
from eddyline.operators.scans import Monoid, reduce_by_key, scan_by_key

# affine maps x -> a x + b, composed in order: associative, not commutative
MODULUS = 10_007
AFFINE = Monoid(
    "a bigint, b bigint",
    lambda rows: {"a": rows["x"] % 5 + 1, "b": rows["x"]},
    lambda f, g: {"a": f["a"] * g["a"] % MODULUS, "b": (f["b"] * g["a"] + g["b"]) % MODULUS},
)
JOINED = Monoid("s string", lambda rows: {"s": rows["w"].astype(object)}, lambda f, g: {"s": f["s"] + g["s"]})


def composed(xs):
    a, b = 1, 0
    for x in xs:
        a, b = a * (x % 5 + 1) % MODULUS, (b * (x % 5 + 1) + x) % MODULUS
    return (a, b) if xs else None


def data(n, seed):
    """A key that holds half of all rows, many small ones, and the null key."""
    rnd = random.Random(seed)
    return [(rnd.choice(["hot", "hot", "hot", None, *map(str, range(40))]), i, rnd.randrange(1000), rnd.choice("abc")) for i in rnd.sample(range(10 * n), n)]


@pytest.fixture(params=[(4, 10_000, 0), (7, 13, 0), (200, 3, 0), (5, 13, 8_000_000)], ids=["few tasks", "small batches", "many tasks", "no hot keys"])
def layout(spark, request, monkeypatch):
    """Tasks that hold many keys, keys that go over many tasks, and whole keys dealt by hash."""
    monkeypatch.setattr(blocks, "HOT_ROWS", request.param[2])
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", request.param[0])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", request.param[1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for c, v in before.items():
        spark.conf.set(c, v)


def by_key(rows):
    out = defaultdict(list)
    for k, i, x, w in sorted(rows, key=lambda r: r[1]):
        out[k].append((i, x, w))
    return out


def test_reduce(spark, layout):
    rows = data(400, 1)
    df = spark.createDataFrame(rows, "k string, i long, x long, w string").repartition(5)
    want = {k: composed([x for _, x, _ in v]) for k, v in by_key(rows).items()}
    assert {r.k: (r.a, r.b) for r in reduce_by_key(df, ["k"], AFFINE, ["x"], order=["i"]).collect()} == want
    words = {r.k: r.s for r in reduce_by_key(df, ["k"], JOINED, ["w"], order=["i"]).collect()}
    assert words == {k: "".join(w for *_, w in v) for k, v in by_key(rows).items()}
    total = Monoid("n bigint", lambda r: {"n": r["x"]}, lambda f, g: {"n": f["n"] + g["n"]})
    assert {r.k: r.n for r in reduce_by_key(df, ["k"], total, ["x"]).collect()} == {k: sum(x for _, x, _ in v) for k, v in by_key(rows).items()}
    assert [r.s for r in reduce_by_key(df, [], JOINED, ["w"], order=["i"]).collect()] == ["".join(w for *_, w in sorted(((i, w) for _, i, _, w in rows)))]
    assert reduce_by_key(df.where("i < 0"), ["k"], AFFINE, ["x"], order=["i"]).count() == 0


def test_scan(spark, layout):
    rows = data(400, 2)
    df = spark.createDataFrame(rows, "k string, i long, x long, w string").repartition(5)
    got = {r.i: r for r in scan_by_key(df, ["k"], ["i"], AFFINE, ["x"]).collect()}
    assert len(got) == len(rows)
    for k, v in by_key(rows).items():
        for n, (i, x, w) in enumerate(v):
            r = got[i]
            assert (r.k, r.x, r.w, r["_before"], r["_last"]) == (k, x, w, n > 0, n == len(v) - 1)
            assert (r["_before_a"], r["_before_b"]) == (composed([y for _, y, _ in v[:n]]) or (None, None))
    assert scan_by_key(df.where("i < 0"), ["k"], ["i"], AFFINE, ["x"]).count() == 0


def waiting_in_vain(rows, within):
    out = []
    for k, v in by_key(rows).items():
        slot = None
        for i, t, kind in sorted(v, key=lambda r: (r[1], r[0])):
            if slot and t - slot[1] > within:
                out.append((k, slot[2] == "a", slot[1], slot[0]))
                slot = None
            slot = None if slot and slot[2] != kind else (i, t, kind)
        if slot:
            out.append((k, slot[2] == "a", slot[1], slot[0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("within", [0, 7, 40])
def test_pairing(spark, layout, within):
    rows = [(k, i, x, "a" if w == "c" else w) for k, i, x, w in data(400, 3)]
    df = spark.createDataFrame(rows, "k string, seq long, t long, kind string").repartition(3)
    got = pairing.unpaired(df, ["k"], "t", "seq", F.col("kind") == "a", within)
    assert sorted(map(tuple, got.collect()), key=repr) == waiting_in_vain(rows, within)


@pytest.mark.parametrize(
    "kinds, want",
    [("oop", []), ("opo", [3]), ("opop", []), ("ppo", []), ("o", [1]), ("oo", [2]), ("op.o", [4]), ("o.p", [1, 3]), ("o.o", [1, 3]), ("o.op", [1])],
    ids=lambda x: str(x),
)
def test_pairing_by_hand(spark, kinds, want):
    """A dot is a pause longer than the limit."""
    rows, t = [], 0
    for i, c in enumerate(kinds, 1):
        t += 100 if c == "." else 1
        rows += [(1, i, t, c)] if c != "." else []
    df = spark.createDataFrame(rows, "k long, seq long, t long, kind string")
    assert sorted(r.seq for r in pairing.unpaired(df, ["k"], "t", "seq", F.col("kind") == "o", 50).collect()) == want


def test_pairs_are_joined_in_few_calls():
    calls = []

    def combine(f, g):
        calls.append(len(f["n"]))
        return {"n": f["n"] + g["n"]}

    total = Monoid("n bigint", lambda r: r, combine)
    ones = {"n": np.ones(1 << 14, np.int64)}
    opens = np.zeros(1 << 14, bool)
    opens[0] = True
    assert scans.reduced(ones, opens, total)["n"].tolist() == [1 << 14] and len(calls) == 14
    assert (scans.scanned(ones, opens, total)["n"] == np.arange(1, (1 << 14) + 1)).all() and len(calls) <= 14 * 3
