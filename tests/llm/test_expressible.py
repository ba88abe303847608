"""The queries that SQL can express, against DuckDB."""

import glob
import os

import duckdb
import pytest

from skeinworks.llm import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_oracle(spark, name):
    duck = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        duck.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    got, want = registry.QUERIES[name](spark, SF), duck.sql(registry.ORACLE[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    rows = lambda columns, data: sorted(repr([r[columns.index(c)] for c in order]) for r in data)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())
