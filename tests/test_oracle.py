"""Every registered query of the keyed operators against its DuckDB oracle SQL (the driver's gate).

The training-data queries have their own tests in ``tests/llm``."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from chronokey.queries import BATCH_QUERIES
from chronokey.streaming.replay import STREAM_QUERIES
from conftest import SF001, SF01
from tools.oracle_check import compare, duck

CORE = [*BATCH_QUERIES, *STREAM_QUERIES]


@pytest.fixture(scope="module")
def con001():
    return duck(SF001)


def test_every_query_has_oracle():
    assert set(CORE) <= set(queries())
    assert set(CORE) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() == 587
    assert df.columns == ["user_id", "session_start_us", "session_end_us", "segment", "event_types", "closed_by"]


@pytest.mark.parametrize("name", CORE)
def test_oracle_sf0001(spark, con001, name):
    r = compare(spark, SF001, name, queries()[name], oracle_sql()[name], con001)
    assert r["ok"], r


@pytest.mark.parametrize("name", ["capped_sessions_arrival", "terminated_sessions", "arrival_window_mean", "late_audit"])
def test_oracle_sf001(spark, name):
    r = compare(spark, SF01, name, queries()[name], oracle_sql()[name])
    assert r["ok"], r
