"""Every query of the survey engine against its SQL in DuckDB."""

import math
from decimal import Decimal

import duckdb
import pytest

from starloom.plans import ORACLES, QUERIES

SMALL, FULL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
"""Images are whole rectangles at the larger size only."""


@pytest.fixture(scope="module")
def duck():
    both = {}
    for sf in (SMALL, FULL):
        both[sf] = c = duckdb.connect()
        for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"):
            c.sql(f"CREATE VIEW {t} AS FROM read_parquet('{sf}/{t}.parquet')")
    return both


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return float(v) if isinstance(v, (int, float, Decimal)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    sf = FULL if name.startswith("p") else SMALL
    got = QUERIES[name](spark, sf)
    want = duck[sf].sql(ORACLES[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    ours = [tuple(plain(r[c]) for c in columns) for r in got.collect()]
    place = [want.columns.index(c) for c in columns]
    theirs = [tuple(plain(r[i]) for i in place) for r in want.fetchall()]
    assert sorted(map(str, ours)) == sorted(map(str, theirs))
