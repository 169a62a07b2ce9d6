"""Catalogue queries vs. their DuckDB oracles on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from candlewick.sources.tables import TABLES
from tests.conftest import SF001
from tools.oracle_check import digest

from candlewick.plans import catalogue

NAMES = sorted(catalogue.QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    got = E.queries()[name](spark, SF001).toPandas()
    exp = duck.sql(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    assert digest(got) == digest(exp)
