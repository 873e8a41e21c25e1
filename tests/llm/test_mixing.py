import re

import pytest

from chronokey.llm import mixing as M
from chronokey.llm.common import documents

from .cases import edge_documents, empty_documents


def brute_targets(sizes):
    """The stated rule: share by weight, cap, reshare the excess until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, capped, left = {}, set(), M.SHARE * sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        total = sum(weight[s] for s in free)
        rest = left - sum(2 * sizes[s] for s in capped)
        target = {s: 2.0 * sizes[s] if s in capped else rest * weight[s] / total for s in order}
        above = {s for s in free if target[s] > 2 * sizes[s] + 1e-9}
        if not above:
            return target
        capped |= above


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


@pytest.mark.parametrize("table", ["edge", "sf0.001"])
def test_targets_and_taken(spark, table):
    docs = edge_documents(spark) if table == "edge" else documents(spark, "/root/testdata/sf0.001")
    rows = docs.collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + words(r["text"])
    want = brute_targets(sizes)
    got = M.mix(docs).collect()
    assert len(got) == len(rows)
    assert sorted((r["doc_id"] or -1, r["size"]) for r in got) == sorted((r["doc_id"] or -1, words(r["text"])) for r in rows)
    taken, largest = {}, {}
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        assert len(r["positions"]) == r["copies"] and all(0 <= p <= 1 for p in r["positions"])
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
    assert all(abs(taken[s] - want[s]) <= largest[s] / 2 + 1 for s in sizes)
    assert sorted(map(str, M.mix(docs).collect())) == sorted(map(str, got))


def test_positions_invert_the_demand(spark):
    """The share of a schedule's area up to the position of u is u."""
    from pyspark.sql import functions as F

    df = spark.range(0, 101).select((F.col("id") / 100).alias("u"), F.explode(F.array(*map(F.lit, range(3)))).alias("place"))
    for r in df.select("u", "place", M.position_of(F.col("u"), F.col("place"), M.SCHEDULES).alias("t")).collect():
        knots = M.SCHEDULES[r["place"]]
        area = lambda upto: sum((min(b[0], upto) - a[0]) * (a[1] + a[1] + (b[1] - a[1]) / (b[0] - a[0]) * (min(b[0], upto) - a[0])) / 2
                                for a, b in zip(knots, knots[1:]) if upto > a[0])
        assert area(r["t"]) / area(1.0) == pytest.approx(r["u"], abs=1e-9)


def test_curriculum_rows(spark):
    docs = edge_documents(spark)
    plan, out = M.mix(docs).collect(), M.curriculum(docs)
    assert out.columns == docs.columns
    assert out.count() == sum(r["copies"] for r in plan)
    heavy = [r["source"] for r in M.curriculum(documents(spark, "/root/testdata/sf0.001")).collect()]
    assert len(heavy) > 100


def test_empty(spark):
    assert M.mix(empty_documents(spark)).count() == 0
    assert M.curriculum(empty_documents(spark)).count() == 0
