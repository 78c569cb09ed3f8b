"""Registered queries against their SQL."""

from __future__ import annotations

import pytest

from compare import connect, duck_rows, spark_rows
from daylake.llm import queries


@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_matches_sql(spark, small, name):
    df = queries.QUERIES[name](spark, small)
    columns, expected = duck_rows(connect(small), queries.ORACLE[name])
    assert sorted(columns) == sorted(df.columns)
    assert spark_rows(df) == expected


def test_runs_of_all_documents_match_sql(spark):
    """A larger table, with documents that repeat themselves throughout."""
    larger = "/root/testdata/sf0.01"
    _, expected = duck_rows(connect(larger), queries.ORACLE["op11_periodic_runs"])
    assert spark_rows(queries.op11_periodic_runs(spark, larger)) == expected
