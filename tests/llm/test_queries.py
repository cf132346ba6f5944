"""Corpus queries against their SQL in DuckDB, on the smallest tables."""

import pytest

from almanac.llm import registry

from ..test_queries import SF, _table, duck  # noqa: F401


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, duck, name):  # noqa: F811
    df = registry.QUERIES[name](spark, SF)
    r = duck.execute(registry.ORACLES[name])
    assert _table(df.columns, [tuple(x) for x in df.collect()]) == _table([c[0] for c in r.description], r.fetchall())


def test_names():
    assert [n.split("_")[0] for n in sorted(registry.QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{i}" for i in range(1, 11)]
