"""Driver contract of __spark_entry__.py."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert len(df.columns) >= 5
    assert df.count() > 0


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    from candlewick.plans import catalogue
    assert set(o) <= set(q)
    assert set(catalogue.QUERIES) <= set(o)  # every query of the candle engine has its SQL


def test_each_operator_id_is_claimed_by_a_query_that_runs_it():
    from candlewick.plans import catalogue
    assert all(x.ids for x in catalogue.QUERIES.values())
