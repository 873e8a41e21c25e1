"""Plan shape of the registered queries on the bucketed (hot-key) path."""

import pytest

from chronokey.plans import scan
from chronokey.queries import BATCH_QUERIES
from conftest import SF001
from tools.plan_report import summarize

# Rows are judged in arrival order, then counted by key and window; positions are counted from the last terminator,
# whose own count the buckets after it need first.
RAW_SHUFFLES = {"early_count_late_dropped": 2, "terminated_session_rows": 2}
NO_RAW_SHUFFLE = {"tumbling_mean", "gap_sessions", "inactivity_alerts", "inactivity_alerts_open"}


@pytest.fixture
def bucketed(spark):
    spark.conf.set(scan.TARGET_ROWS_CONF, "10")
    yield spark
    spark.conf.unset(scan.TARGET_ROWS_CONF)


@pytest.mark.parametrize("name", list(BATCH_QUERIES))
def test_rows_shuffled_at_most_once(bucketed, name):
    df = BATCH_QUERIES[name](bucketed, SF001)
    df.write.format("noop").mode("overwrite").save()
    shape = summarize(df._jdf.queryExecution().executedPlan().toString())
    assert shape["raw_row_exchanges"] <= (0 if name in NO_RAW_SHUFFLE else RAW_SHUFFLES.get(name, 1)), shape
    assert shape["joins"] == shape["broadcasts"], shape  # summaries join by broadcast, rows never re-shuffled
