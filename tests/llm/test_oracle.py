"""Queries of this subpackage that SQL can express, against DuckDB."""

import pytest

from __spark_entry__ import oracle_sql, queries
from chronokey.llm.oracle import ORACLE_SQL
from chronokey.llm.queries import QUERIES
from tools.oracle_check import compare

SF001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_oracle_sf0001(spark, name):
    assert {*QUERIES, "pipeline"} <= set(queries()) and ORACLE_SQL.items() <= oracle_sql().items()
    r = compare(spark, SF001, name, queries()[name], oracle_sql()[name])
    assert r["ok"], r
