"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from pitchhouse import registry
from tests.compare import diff

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "team_name"


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    got = registry.queries()[name](spark, SF).toPandas()
    expected = con.execute(registry.oracle_sql()[name]).df()
    assert diff(got, expected) == []
