"""Every query of the core gives the rows of its SQL; those without SQL give the same rows of the same schema when run again."""

import math
import os

import duckdb
import pytest

from leafmill.plans import catalogue


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(data):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{data}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(name, spark, data, duck):
    df = catalogue.QUERIES[name](spark, data)
    cols = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    if name not in catalogue.ORACLES:
        again = catalogue.QUERIES[name](spark, data)
        assert rows and again.schema == df.schema and sorted((tuple(plain(r[c]) for c in cols) for r in again.collect()), key=str) == rows
        return
    rel = duck.sql(catalogue.ORACLES[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=str)
