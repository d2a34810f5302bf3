"""Ordered operators against plain Python on random rows, for several block widths."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from compare import rows
from eddyline.operators import blocks
from eddyline.operators import anchored, overs, patterns, state, windows


@pytest.fixture(autouse=True)
def every_key_is_hot(monkeypatch):
    monkeypatch.setattr(blocks, "HOT_ROWS", 0)


def events(seed: int, n: int = 220, keys: int = 4, dense: int = 6) -> list[tuple]:
    """One key holds half of the rows."""
    rnd, t, out = random.Random(seed), 0, []
    for seq in range(n):
        t += rnd.choice([0, 1, 1, 2, dense, 40]) if seed % 2 else rnd.randint(0, 3)
        key = 0 if rnd.random() < 0.5 else rnd.randrange(1, keys)
        out.append((seq, key, t, rnd.choice(["fail", "fail", "busy", "success"]), rnd.randint(0, 25)))
    return out


SCHEMA = "seq long, sid long, t long, call_type string, duration long"
WIDTHS = [1, 7, 50, 10_000]


def by_key(data):
    keys: dict[int, list] = {}
    for r in data:
        keys.setdefault(r[1], []).append(r)
    return keys


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("width", [1, 200])
def test_anchored(spark, seed, width):
    data, length, want = events(seed), 10, []
    for key, rs in by_key(data).items():
        anchor = None
        for r in rs:
            if anchor is None or r[2] >= anchor + length:
                anchor = r[2]
                want.append([key, anchor, 0, 0])
            want[-1][2] += r[4]
            want[-1][3] += 1
    df = spark.createDataFrame(data, SCHEMA)
    got = anchored.anchored_windows(df, ["sid"], "t", length, F.col("duration"), width)
    assert rows(got, "sid", "anchor", "total", "n") == sorted(map(tuple, want), key=repr)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("width", [3, 10_000])
def test_silent_failures(spark, seed, width):
    data, timeout, want = events(seed), 9, []
    for key, rs in by_key(data).items():
        armed = None
        for r in rs:
            failed = r[3] == "fail"
            if armed is not None and (r[2] >= armed + timeout if failed else r[2] > armed + timeout):
                want.append((key, armed, armed + timeout))
                armed = None
            armed = (r[2] if armed is None else armed) if failed else None
        if armed is not None:
            want.append((key, armed, armed + timeout))
    df = spark.createDataFrame(data, SCHEMA)
    got = state.silent_failures(df, "sid", "seq", "t", F.col("call_type") == "fail", timeout, width, width)
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("width", WIDTHS)
def test_average_below(spark, seed, width):
    data, want = events(seed), []
    for key, rs in by_key(data).items():
        run: list = []
        for r in rs:
            values = [x[4] for x in run] + [r[4]]
            if sum(values) < 10 * len(values):
                run.append(r)
            else:
                if run:
                    want.append((key, run[0][0], run[-1][0], r[0], sum(x[4] for x in run), len(run)))
                run = []
    df = spark.createDataFrame(data, SCHEMA)
    got = patterns.average_below(df, "sid", "seq", "duration", 10, width)
    assert rows(got) == sorted(want, key=repr)


def reluctant_matches(rs, a, b, c):
    """Leftmost start, first possible C, continue after the match."""
    out, i = [], 0
    while i < len(rs):
        end = None
        if a(rs[i]):
            for j in range(i + 1, len(rs)):
                if c(rs[j]):
                    end = j
                    break
                if not b(rs[j]):
                    break
        if end is None:
            i += 1
        else:
            out.append(rs[end])
            i = end + 1
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("width", [2, 10_000])
@pytest.mark.parametrize("bounds", [(10, 15, 12), (3, 8, 20), (18, 30, 5)])
def test_reluctant(spark, seed, width, bounds):
    low, mid, high = bounds
    data, want = events(seed), []
    for key, rs in by_key(data).items():
        found = reluctant_matches(rs, lambda r: r[4] > low, lambda r: r[4] < mid, lambda r: r[4] > high)
        want += [(key, r[0]) for r in found]
    x = F.col("duration")
    got = patterns.reluctant(spark.createDataFrame(data, SCHEMA), "sid", "seq", x > low, x < mid, x > high, [], width)
    assert rows(got) == sorted(want, key=repr)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("width", [2, 10_000])
def test_consecutive_and_run_within(spark, seed, width):
    data, consecutive, within = events(seed), [], []
    for key, rs in by_key(data).items():
        for i, r in enumerate(rs):
            if r[3] == "busy":
                j = next((j for j in range(i + 1, len(rs)) if rs[j][3] == "fail"), None)
                n, k = 0, j
                while k is not None and k < len(rs) and rs[k][3] == "fail":
                    n, k = n + 1, k + 1
                    consecutive.append((key, r[0], rs[j][0], n))
            if r[3] == "success":
                k, run = i - 1, []
                while k >= 0 and rs[k][3] == "fail" and r[2] - rs[k][2] < 6:
                    run.append(rs[k][0])
                    k -= 1
                if run:
                    within.append((key, r[0], min(run), len(run)))
    df = spark.createDataFrame(data, SCHEMA)
    got = patterns.followed_by_consecutive(df, "sid", "seq", F.col("call_type") == "busy", F.col("call_type") == "fail", width)
    longest = {}
    for key, start, item, n in consecutive:
        longest[key, start, item] = max(n, longest.get((key, start, item), 0))
    assert rows(got) == sorted(((*k, n) for k, n in longest.items()), key=repr)
    runs = patterns.run_then_within(df, "sid", "seq", "t", F.col("call_type") == "fail", F.col("call_type") == "success", 6, width)
    assert rows(runs, "sid", "end_seq", "start_seq", "n") == sorted(within, key=repr)


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("width", [5, 10_000])
def test_sessions_with_gaps_per_row(spark, seed, width):
    data, want = events(seed), []
    for key, rs in by_key(data).items():
        current = None
        for r in rs:
            upto = r[2] + (3 if r[3] == "fail" else 5)
            if current is not None and r[2] <= current[2]:
                current[2] = max(current[2], upto)
            else:
                current = [key, r[2], upto, 0, 0]
                want.append(current)
            current[3] += r[4]
            current[4] += 1
    gap = F.when(F.col("call_type") == "fail", 3).otherwise(5)
    got = windows.sessions(spark.createDataFrame(data, SCHEMA), ["sid"], "t", gap, F.col("duration"), width)
    assert rows(got, "sid", "t_start", "t_end", "total", "n") == sorted(map(tuple, want), key=repr)


@pytest.mark.parametrize("width", [2, 10_000])
def test_expiring_total(spark, width):
    data, want = events(1), []
    for key, rs in by_key(data).items():
        last, total = None, 0
        for r in rs:
            total = r[4] if last is None or r[2] - last >= 8 else total + r[4]
            last = r[2]
            want.append((key, r[0], total))
    got = state.expiring_total(spark.createDataFrame(data, SCHEMA), "sid", "seq", "t", "duration", 8, width)
    assert rows(got, "sid", "seq", "total") == sorted(want, key=repr)


@pytest.mark.parametrize("width", [1, 9, 10_000])
def test_time_range_sums_include_ties(spark, width):
    data = events(0)
    want = [(key, r[0], sum(x[4] for x in rs if r[2] - 4 <= x[2] <= r[2])) for key, rs in by_key(data).items() for r in rs]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(overs.sums_over_time_range(df, ["sid"], "t", 4, width, s=F.col("duration")), "sid", "seq", "s") == sorted(want, key=repr)
    assert rows(overs.over_time_range(df, ["sid"], "t", 4, width, s=F.sum("duration")), "sid", "seq", "s") == sorted(want, key=repr)


def traced(rs, item, end):
    """item+ end, fed row by row: open loops go on over end rows, and every prefix waits for its next end row."""
    loops, waiting, out = {}, [], []
    for seq, _, _, kind, _ in rs:
        if kind == item:
            loops = {s: n + 1 for s, n in loops.items()} | {seq: 1}
            waiting += [(s, n) for s, n in loops.items()]
        elif kind == end:
            out += [(s, n, seq) for s, n in waiting]
            waiting = []
    return out


@pytest.mark.parametrize("seed", range(3))
def test_matches_counted_per_start_follow_the_automaton(spark, seed):
    data = events(seed)
    ends, until, strategies = [], [], []
    for key, rs in by_key(data).items():
        for i, r in enumerate(rs):
            later = [x[0] for x in rs[i + 1 :] if x[3] == "success"]
            if r[3] == "busy" and later:
                ends.append((key, r[0], len(later), later[0], later[-1]))
            if r[3] == "busy":
                run = []
                for x in rs[i:]:
                    if x[3] == "success":
                        break
                    run += [x[0]] * (x[3] == "busy")
                until.append((key, r[0], len(run), run[-1]))
        found = traced(rs, "fail", "success")
        for start in sorted({m[0] for m in found}):
            mine = [m for m in found if m[0] == start]
            first_end = min(m[2] for m in mine)
            own = [m for m in mine if m[2] == first_end]
            strategies.append(("none", key, start, len(mine), max(m[1] for m in mine), first_end))
            strategies.append(("to_next", key, start, 1, max(m[1] for m in own), first_end))
            strategies.append(("to_first", key, start, len(own), max(m[1] for m in own), first_end))
        for end in sorted({m[2] for m in found}):
            inside = sorted(m for m in found if m[2] == end and not any(x[2] < end and x[0] == m[0] for x in found))
            if inside:
                best = max(m[1] for m in inside if m[0] == inside[0][0])
                strategies += [(name, key, inside[0][0], 1, best, end) for name in ("past_last", "to_last")]
                if inside[-1][0] != inside[0][0]:
                    strategies.append(("to_last", key, inside[-1][0], 1, 1, end))
    df = spark.createDataFrame(data, SCHEMA)
    busy, fail, success = (F.col("call_type") == k for k in ("busy", "fail", "success"))
    assert rows(patterns.later_ends(df, "sid", "seq", busy, success, None)) == sorted(ends, key=repr)
    assert rows(patterns.prefixes_until(df, "sid", "seq", busy, success, None)) == sorted(until, key=repr)
    got = patterns.skip_strategies(df, "sid", "seq", "t", fail, success, None)
    assert rows(got, "strategy", "sid", "start_seq", "matches", "longest", "end_seq") == sorted(strategies, key=repr)
