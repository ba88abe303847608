"""Every registered query against its SQL on DuckDB, and those without SQL for rows."""

import datetime
import glob
import os

import duckdb
import pytest

from skeinworks.plans import procedures  # noqa: F401  registers its queries
from skeinworks.plans import queries as plans

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((repr([plain(r[i]) for i in order]) for r in data))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", sorted(plans.ORACLE))
def test_oracle(spark, duck, name):
    got = plans.QUERIES[name](spark, SF)
    want = duck.sql(plans.ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLE)))
def test_rows(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0
