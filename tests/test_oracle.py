"""Every registered query against its SQL oracle, with one block per key and with many."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import canonical
from eddyline.operators import blocks
from eddyline.plans import catalog

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES

# queries whose plan cuts keys into blocks
BLOCKED = ("agg_running", "over_", "win_session", "win_count", "win_global", "win_trigger_anchored", "win_evict_late", "wm_p", "late_",
           "join_temporal", "state_", "timer_", "cl_emit", "cep_", "mr_", "sink_upsert")


def check(spark, sf, oracle, name):
    got = QUERIES[name](spark, sf).toPandas()
    want = oracle.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert canonical(got) == canonical(want)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf, oracle, name):
    check(spark, sf, oracle, name)


@pytest.mark.parametrize("name", [n for n in sorted(ORACLES) if n.startswith(BLOCKED)])
def test_oracle_with_many_blocks(spark, sf, oracle, name, monkeypatch):
    """About half of the users count as hot and are cut at quantiles; fixed widths are covered by test_plans and test_brute_force."""
    monkeypatch.setattr(blocks, "HOT_ROWS", 66)
    monkeypatch.setattr(blocks, "EDGE_SAMPLES", 66)
    check(spark, sf, oracle, name)


def test_entry(spark):
    assert entry.entry(spark).columns == ["word", "n"]
