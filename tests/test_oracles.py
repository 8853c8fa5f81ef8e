"""Every registered query with SQL against DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from sievewright.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    with duckdb.connect() as con:
        for path in Path(SF).glob("*.parquet"):
            con.execute(f"create view {path.stem} as from '{path}{'/*.parquet' if path.is_dir() else ''}'")
        yield con


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}" if math.isfinite(v) else str(v)
    return str(v)


def table(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[k] for k in order], sorted(tuple(plain(r[k]) for k in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(registry.ORACLES[name])
    want = table([d[0] for d in result.description], result.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1], "the query shows nothing"


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)
