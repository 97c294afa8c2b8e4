"""Registered queries against their SQL in DuckDB.

By default a part of them at the smallest scale. All of them, at the scale the flows' own data tests
need (sf0.01): `TRIPMART_ALL_QUERIES=1 python -m pytest tests/test_queries.py`.
"""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as contract
from gallery import ORACLES, QUERIES
from tests.compare import connect, difference

ALL = bool(os.environ.get("TRIPMART_ALL_QUERIES"))
SF_DIR = "/root/testdata/sf0.01" if ALL else "/root/testdata/sf0.001"
PART = """c01 c03 c06 c07 c08 c10 f02 f03 f05 f07 f09 f14 p02 p05 p07 j01 j04 a02 a06 n01 u02 m01 m04
    m06 q07 q10 s02 s08 s09 v01 v07 i02""".split()
NAMES = [n for n in QUERIES if ALL or n.split("_")[0] in PART]


@pytest.fixture(scope="module")
def db():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test data")
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    assert difference(df, db, ORACLES[name]) is None


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert 0 < len(rows) <= 10


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


def test_names_follow_the_inventory():
    ids = {n.split("_")[0] for n in QUERIES}
    wanted = {
        **{"s": 10, "w": 11, "c": 17, "p": 12, "j": 5, "a": 8, "n": 3, "o": 3, "u": 2},
        **{"f": 14, "m": 8, "q": 13, "v": 9, "i": 8},
    }
    assert ids == {f"{k}{n:02d}" for k, count in wanted.items() for n in range(1, count + 1)}
    assert all(re.fullmatch(r"[a-z]\d\d_[a-z0-9_]+", n) for n in QUERIES)
