"""Capped sessions in arrival order and sessions as labelled rows, against plain-Python folds."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from chronokey import capped_sessions, terminated_session_rows, terminated_sessions
from chronokey.plans import arrival_chain

T0 = dt.datetime(2024, 1, 1)
GAP, MAX = 5, 7
SCHEMA = "user_id string, seq long, ts timestamp, event_type string"


def at(s):
    return T0 + dt.timedelta(seconds=s)


def fold(times):
    """Sessions of one key's times (seconds) as they arrived: (start, end, sorted times, reason)."""
    out, cur = [], []

    def close(reason):
        out.append((cur[0], cur[0] + MAX if reason == "Max" else max(cur) + GAP, sorted(cur), reason))

    for t in times:
        if cur and t >= cur[-1] + GAP:
            close("Inactivity")
            cur = []
        elif cur and t > cur[0] + MAX:
            close("Max")
            cur = []
        cur.append(t)
    if cur:
        close("Inactivity" if cur[-1] + GAP <= cur[0] + MAX else "Max")
    return out


def disordered(seed, keys, n):
    """Times that step by at most the gap and back, with ties, exact gaps and caps; long islands for some keys."""
    rng = random.Random(seed)
    rows, want, seq = [], [], 0
    for k in range(keys):
        key, t, times = None if k == 0 else f"k{k}", 50, []
        for _ in range(rng.randrange(1, n)):
            t = max(0, t + rng.choice([-9, -5, -2, 0, 0, 1, 2, 3, 4, 4] + ([5, 6, 30] if k % 3 else [])))
            times.append(t)
            rows.append((key, seq, at(t), "x"))
            seq += 1
        want += [(key, at(a), at(b), len(c), [at(x) for x in c], r) for a, b, c, r in fold(times)]
    rng.shuffle(rows)
    return rows, sorted(want, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("fold_rows, block, target_rows", [(None, 64, None), (0, 4, None), (0, 4, 30), (20, 64, 30)])
def test_arrival_order_equals_fold(spark, monkeypatch, fold_rows, block, target_rows):
    """Folded islands, blocks of maxima over several levels, and keys cut into buckets."""
    monkeypatch.setattr(arrival_chain, "BLOCK", block)
    rows, want = disordered(5, 24, 150)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("extra", F.lit("clash"))
    got = capped_sessions(df, gap="5 seconds", max_len="7 seconds", order="arrival", fold_limit=fold_rows, target_rows=target_rows)
    assert got.columns == ["user_id", "session_start", "session_end", "n", "timestamps", "reason"]
    assert rows_of(got) == want


def test_arrival_order_of_ordered_rows_is_time_order(spark):
    rows, _ = disordered(6, 10, 80)
    rows = [(k, i, t, e) for i, (k, _, t, e) in enumerate(sorted(rows, key=lambda r: r[2]))]
    df = spark.createDataFrame(rows, SCHEMA)
    same = lambda **k: rows_of(capped_sessions(df, gap="5 seconds", max_len="7 seconds", **k))
    assert same(order="arrival") == same()


def test_arrival_order_edges(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert capped_sessions(df, order="arrival").count() == 0
    one = spark.createDataFrame([("a", 1, None, "x"), ("a", 2, at(3), "x")], SCHEMA)
    assert [tuple(r) for r in capped_sessions(one, order="arrival").collect()] == [("a", at(3), at(8), 1, [at(3)], "Inactivity")]
    assert "timestamps" not in capped_sessions(one, order="arrival", lists=False, fold_limit=0).columns
    with pytest.raises(ValueError):
        capped_sessions(one, order="arrival", mode="event_time")


@pytest.mark.parametrize("target_rows", [None, 25])
def test_session_rows_are_the_lists(spark, target_rows):
    """The labelled rows, gathered, are the sessions with their lists; null types and keys, ties."""
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None]) if i % 3 else "hot", i, None if i % 40 == 0 else at(rng.randrange(0, 6000, 5)),
             rng.choice(["click", "LOGOUT", "CHECKOUT_COMPLETE", None, "view"])) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("segment", F.lit("clash"))
    labelled = terminated_session_rows(df, gap="60 seconds", target_rows=target_rows)
    assert labelled.columns == ["user_id", "seq", "ts", "event_type", "session_start", "segment", "position"]
    assert labelled.count() == sum(r[2] is not None for r in rows)
    got = labelled.groupBy("user_id", "session_start", "segment").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", F.struct("event_type").alias("e")))), lambda x: x["e"]["event_type"]).alias("event_types"),
        F.sort_array(F.collect_list("position")).alias("p"))
    assert got.filter(F.col("p") != F.sequence(F.lit(0).cast("long"), F.size("p").cast("long") - 1)).isEmpty()
    # A list leaves null types in place as well.
    want = terminated_sessions(df, gap="60 seconds").select("user_id", "session_start", "segment", "event_types")
    assert rows_of(got.drop("p")) == rows_of(want)
