"""Every registered query against its SQL on the same tables."""

import pytest

from lectern.plans.queries import ORACLE_SQL, QUERIES


def plain(rows):
    return sorted(repr(tuple(x)) for x in rows)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, tables, duck, name):
    found = QUERIES[name](spark, tables)
    expected = duck.execute(ORACLE_SQL[name])
    columns = [x[0] for x in expected.description]
    assert sorted(columns) == sorted(found.columns)
    assert plain(found.select(*columns).collect()) == plain(expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_other_queries_run(spark, tables, name):
    assert QUERIES[name](spark, tables).count() > 0


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
