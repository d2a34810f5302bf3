"""The prefix trie against a plain one built conversation by conversation."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from eddyline.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, parent string, ids string, name string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(xs)] for c, xs in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    below = defaultdict(list)
    for node in members:
        if node:
            below[node[:-1]].append(node)
    out, leaves, saved = [], {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[b] for b in below[node]) or 1
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = (len(members[node]) - 1) * size + sum(saved[b] for b in below[node])
        ends = ",".join(str(c) for c in members[node] if len(convs[c]) == len(node))
        up = members[node[:-1]][0] if node else None
        out.append((members[node][0], len(node), up, len(members[node]), len(below[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def random_turns(n, seed):
    """Few texts, so that prefixes and whole conversations meet; some conversations are long, some ids negative or missing."""
    rnd = random.Random(seed)
    rows = [(7000, t, "user", "same") for t in range(150)] + [(7005, t, "user", "same") for t in range(140)]
    hot = [(rnd.choice("ua"), rnd.choice(["x", "é" * 5])) for _ in range(12)]
    for c in rnd.sample(range(-40, 3 * n), n):
        turns = hot if rnd.random() < 0.4 else [(rnd.choice("ua"), rnd.choice(["x", "yy", "é", None])) for _ in range(rnd.randrange(1, 11))]
        rows += [(c, t if rnd.random() < 0.95 else None, r, x) for t, (r, x) in enumerate(turns)]
    rnd.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], SCHEMA).repartition(3)


def found(spark, rows, **options):
    return sorted(map(tuple, prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.conversations_of(frame(spark, rows))), **options).collect()), key=repr)


@pytest.mark.parametrize("options", [{}, {"range_bytes": 2000, "fan_in": 2}, {"range_bytes": 300, "fan_in": 7}])
def test_trie(spark, options, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 3)
    # turns without a number share a place; they are told apart by text here, so give each conversation at most one
    rows, without = [], set()
    for c, t, r, x in random_turns(160, 1):
        if t is None and c in without:
            t = 99
        without |= {c} if t is None else set()
        rows.append((c, t, r, x))
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())
    assert found(spark, rows, **options) == trie(rows)


def test_join_of_parents_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "MAX_BROADCAST_BYTES", 0)
    rows = [(c, t, "u", "abc"[: 1 + (c * t) % 3]) for c in range(40) for t in range(6)]
    assert found(spark, rows, range_bytes=500, fan_in=3) == trie(rows)


def test_odd_conversations(spark):
    assert found(spark, []) == []
    rows = [(None, 0, "u", "x"), (1, None, None, None), (1, 0, "", ""), (1, 1, "u", ""), (2**40, 5, "u", "\x00" * 1000), (-3, 0, "u", "z" * 100_000)]
    assert found(spark, rows) == trie(rows)
    assert found(spark, rows[:1]) == []


def test_turns_that_share_a_place_have_one_order(spark):
    rows = [(0, 1, "u", t) for t in ("b", "a", "c", "a")]
    assert found(spark, rows) == found(spark, rows[::-1]) and len(found(spark, rows)) == 5
