"""Every core query against its SQL in DuckDB on the small tables."""

import math
import os

import duckdb
import pytest

from millrace import catalog


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return str(v)


@pytest.fixture(scope="module")
def db(data):
    c = duckdb.connect()
    for f in os.listdir(data):
        c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{data}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows(spark, db, data, name):
    df = catalog.QUERIES[name](spark, data)
    got = db.execute(catalog.ORACLES[name])
    cols = [c[0] for c in got.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(tuple(norm(r[cols.index(c)]) for c in sorted(cols)) for r in got.fetchall())
    assert sorted(tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect()) == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, data, name):
    assert catalog.QUERIES[name](spark, data).count() > 0
