"""Every query of the registry against its SQL in DuckDB, on the smallest tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

from almanac.plans import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SF}/{f}'")
    return con


def _value(v):
    if isinstance(v, (Decimal, float)):
        return None if math.isnan(v) else round(float(v), 6)
    return float(v) if isinstance(v, int) and not isinstance(v, bool) else v


def _table(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_value(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    got = _table(df.columns, [tuple(r) for r in df.collect()])
    if name not in registry.ORACLES:
        return
    r = duck.execute(registry.ORACLES[name])
    assert got == _table([c[0] for c in r.description], r.fetchall())
