"""Every query that has SQL, against DuckDB on the same tables."""

import pytest

import __spark_entry__ as entry
from tests.comparing import duck_rows, spark_rows
from tidemark.plans import alignments, compare, extras, phylogeny, posterior, problems, records, signals

CORE = {n: (m.QUERIES[n], m.SQL.get(n)) for m in (records, alignments, compare, phylogeny, posterior, signals, extras, problems) for n in m.QUERIES}


@pytest.mark.parametrize("name", [n for n, (_, sql) in CORE.items() if sql])
def test_query_equals_sql(spark, duck, data, name):
    query, sql = CORE[name]
    names, rows = spark_rows(query(spark, data))
    wanted_names, wanted = duck_rows(duck, sql)
    assert names == wanted_names
    assert rows == wanted


@pytest.mark.parametrize("name", [n for n, (_, sql) in CORE.items() if not sql])
def test_query_without_sql_runs(spark, data, name):
    assert CORE[name][0](spark, data).count() > 0


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
