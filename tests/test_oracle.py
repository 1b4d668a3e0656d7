"""Every query with SQL equals DuckDB on the smallest driver tables."""

import glob
import math

import duckdb
import pytest

from tessera.plans.queries import ORACLES, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for path in glob.glob(f"{DIR}/*.parquet"):
        c.sql(f"CREATE VIEW {path.split('/')[-1][:-8]} AS SELECT * FROM read_parquet('{path}')")
    return c


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    clean = lambda v: None if v is None or isinstance(v, float) and math.isnan(v) else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(clean(r[k]) for k in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, db, name):
    got, want = QUERIES[name](spark, DIR), db.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DIR).count() > 0
