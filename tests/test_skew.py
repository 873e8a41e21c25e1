"""A key holding a third of all rows: automatic buckets split it, results stay exact.

The skewed table is derived from events (every third event is moved to one
hot user), so the hot key interleaves with everything else in time.
"""

import pytest
from pyspark.sql import functions as F

from chronokey import (
    arrival_window_mean,
    capped_sessions,
    early_count,
    gap_sessions,
    inactivity_alerts,
    late_audit,
    terminated_sessions,
)
from chronokey.functions.time import epoch_us
from chronokey.plans.scan import auto_bucket
from chronokey.sources.tables import read_events
from conftest import SF01

HOT = -7
TARGET = 400


@pytest.fixture(scope="module")
def skewed(spark):
    ev = read_events(spark, SF01)
    return ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("user_id")))


def _same(a, b):
    ra, rb = a.collect(), b.collect()
    assert len(ra) == len(rb)
    assert sorted(map(repr, ra)) == sorted(map(repr, rb))


def test_hot_key_is_split(skewed):
    per_key = skewed.groupBy("user_id").count().orderBy(F.desc("count")).first()
    assert per_key["user_id"] == HOT and per_key["count"] > 3000
    b = auto_bucket(skewed, ["user_id"], epoch_us("ts"), target_rows=TARGET)
    assert b is not None
    biggest = skewed.groupBy("user_id", b.alias("b")).count().agg(F.max("count")).first()[0]
    assert biggest <= 3 * TARGET  # was > 3000 rows in one window partition


@pytest.mark.parametrize(
    "op",
    [
        lambda df, **k: gap_sessions(df, "user_id", "ts", "event_id", "12 hours", **k),
        lambda df, **k: terminated_sessions(df, "user_id", "ts", "event_id", "event_type", "12 hours", ("purchase", "error"), **k),
        lambda df, **k: capped_sessions(df, "user_id", "ts", "event_id", "12 hours", "36 hours", "arrival", **k),
        lambda df, **k: inactivity_alerts(df, "user_id", "ts", "event_id", "24 hours", True, **k),
        lambda df, **k: early_count(df, "user_id", "ts", "event_id", "7 days", 5, True, **k),
        lambda df, **k: arrival_window_mean(df, "user_id", "ts", "value", "event_id", "1 day", **k).withColumn(
            "mean", F.round("mean", 6)
        ),
        lambda df, **k: late_audit(df, "user_id", "ts", "event_id", "5 hours", "1 day", **k),
    ],
    ids=["gap", "terminated", "capped", "alerts", "early", "arrival_mean", "late"],
)
def test_split_equals_unsplit(skewed, op):
    _same(op(skewed, bucket="auto", target_rows=TARGET), op(skewed, bucket=None))


def test_capped_hot_island_by_doubling(skewed):
    # The hot key's islands exceed the fold limit and go through pointer doubling.
    args = ("user_id", "ts", "event_id", "12 hours", "36 hours", "event_time")
    _same(
        capped_sessions(skewed, *args, bucket="auto", target_rows=TARGET, fold_limit=200),
        capped_sessions(skewed, *args, bucket=None),
    )


def test_bucket_width_ignores_small_bursty_keys(spark):
    # a small key with two rows in the same microsecond must not shrink the
    # buckets sized for the one large key
    big = spark.range(0, 5000).select(F.lit("big").alias("k"), (F.col("id") * 1000).alias("v"))
    burst = spark.createDataFrame([("tiny", 7), ("tiny", 7)], "k string, v long")
    df = big.unionByName(burst)
    b = auto_bucket(df, ["k"], F.col("v"), target_rows=1000)
    per = df.filter("k = 'big'").groupBy(b.alias("b")).count()
    assert per.count() <= 6 and per.agg(F.max("count")).first()[0] <= 1000


def test_bucket_width_splits_a_burst(spark):
    # one key: 4,000 rows spread over a long span plus 4,000 rows in a burst
    # a thousand times denser
    spread = spark.range(0, 4000).select(F.lit("k").alias("k"), (F.col("id") * 1_000_000).alias("v"))
    burst = spark.range(0, 4000).select(F.lit("k").alias("k"), (F.lit(2_000_000_000) + F.col("id") * 1000).alias("v"))
    df = spread.unionByName(burst)
    b = auto_bucket(df, ["k"], F.col("v"), target_rows=1000)
    assert df.groupBy(b.alias("b")).count().agg(F.max("count")).first()[0] <= 2000
