"""Every query of the engine against its SQL on the smallest tables, values compared."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from spanloom import registry


def plain(x):
    if isinstance(x, float):
        return round(x, 6)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    ours = sorted((plain(tuple(r)) for r in df.select(*cols).collect()), key=repr)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert ours
        return
    rel = duck.sql(sql)
    assert sorted(rel.columns) == cols
    theirs = sorted((plain(r) for r in rel.select(*cols).fetchall()), key=repr)
    assert ours == theirs
