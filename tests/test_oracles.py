"""Every query of the engine's own operators against its DuckDB SQL on the smallest tables."""

import math

import duckdb
import pytest

from millrace.plans.queries import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def rows(columns, data):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted((tuple(norm(r[i]) for i in at) for r in data), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    got = df.collect()
    if name in ORACLES:
        want = duck.sql(ORACLES[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert rows(df.columns, got) == rows(want.columns, want.fetchall())
    else:
        assert got
