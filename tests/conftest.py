from __future__ import annotations

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eddyline.session import build  # noqa: E402

SF = os.environ.get("EDDYLINE_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build("tests", "local[8]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def oracle():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con
