"""Cap chains in arrival order (capped sessions of rows whose times are out of order).

Rows of a key are taken as they arrived. An *island* is a run in which no row comes ``gap`` or
more after the row that arrived before it (a row that goes back in time moves the deadline back with
it). Inside an island a session starts at the first row, and then at the first *arrived* row with
``ts > start + max``, where ``start`` is the time of the session's first arrived row. Times are not sorted
here, so that row can't be found by an as-of lookup.

* Small islands are folded, one array each, as in :mod:`chronokey.plans.chain`.
* Large ones: every row looks for its next start in a table of block maxima over positions. Level 0 holds
  the rows in blocks of ``BLOCK``, level 1 the maxima of those blocks, and so on. A row climbs while
  nothing behind it in its block is above its threshold, and then descends into the first block
  that holds something above it. Each step is a join on (key, block) in which a block is one row of at
  most ``BLOCK`` numbers: ``O(log rows)`` joins, no group ever holds an island. The starts
  reached from each island's head follow by pointer doubling (``chain.orbit``).

Result columns: key, start_us, last_us (time of the last arrived row), max_us, n, ts_list (sorted; null for
large islands when ``lists=False``), close ('cap', 'gap', or 'end' for the key's last session).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronokey.plans.chain import _KEY, _written, orbit
from chronokey.plans.scan import ordered_scan
from chronokey.session import checkpoint_dir

BLOCK = 64
FOLD_ROWS = 5_000  # rows of an island folded in one group; a fold costs rows x sessions

_POS, _HEAD, _LAST = "__pos", "__head", "__is_last"


def arrival_sessions(
    d: DataFrame, key: str, us: str, order: list[str], gap_us: int, max_us: int, bucket: Column | None, fold_rows: int | None = None, lists: bool = True
) -> DataFrame:
    """``d`` has one row per event with ``key``, ``us`` and the ``order`` columns; see the module."""
    folder = f"{checkpoint_dir(d.sparkSession).rstrip('/')}/chains/{uuid.uuid4().hex}"
    limit = FOLD_ROWS if fold_rows is None else fold_rows
    one = F.lit(1).cast("long")
    d = ordered_scan(d, [key], order, {"__prev": ("prev", us), "__next": ("next", F.lit(1)), _POS: ("sum_before", one)}, bucket)
    starts = F.col("__prev").isNull() | (F.col(us) - F.col("__prev") >= F.lit(gap_us))
    d = ordered_scan(d, [key], order, {_HEAD: ("max", F.when(starts, F.col(_POS)))}, bucket)
    # Positions are dense in the key, so an island is a range of them, named by the first.
    rows = _written(d.select(F.struct(F.col(key)).alias(_KEY), _POS, F.col(us).alias("us"), _HEAD, F.col("__next").isNull().alias(_LAST)), folder, "rows")
    islands = rows.groupBy(_KEY, _HEAD).agg(F.max(_POS).alias("__end"))
    rows = rows.join(islands, [_KEY, _HEAD])
    size = F.col("__end") - F.col(_HEAD) + one
    out = _folded(rows.filter(size <= limit), max_us)
    if not islands.filter(size > limit).isEmpty():
        out = out.unionByName(_doubled(_written(rows.filter(size > limit), folder, "large"), max_us, folder, lists))
    return out.select(F.col(f"{_KEY}.{key}").alias(key), "start_us", "last_us", "max_us", "n", "ts_list", "close")


def _close(in_island: Column, at_end: Column) -> Column:
    return F.when(in_island, F.lit("cap")).when(at_end, F.lit("end")).otherwise(F.lit("gap"))


def _folded(rows: DataFrame, max_us: int) -> DataFrame:
    isl = rows.groupBy(_KEY, _HEAD).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(_POS, "us"))), lambda x: x["us"]).alias("a"), F.max(_LAST).alias(_LAST))
    zero = F.struct(F.lit(None).cast("long").alias("cur"), F.array().cast("array<int>").alias("acc"))
    firsts = F.aggregate(
        F.transform("a", lambda t, i: F.struct(t.alias("t"), i.alias("i"))), zero,
        lambda st, x: F.when(st["cur"].isNull() | (x["t"] > st["cur"] + F.lit(max_us)),
                             F.struct(x["t"].alias("cur"), F.concat(st["acc"], F.array(x["i"])).alias("acc"))).otherwise(st),
        lambda st: st["acc"])
    cut = isl.withColumn("s", firsts).select(
        _KEY, "a", _LAST, "s", F.posexplode("s").alias("k", "p")).withColumn("q", F.coalesce(F.get("s", F.col("k") + 1), F.size("a")))
    part = cut.select(_KEY, _LAST, F.slice("a", F.col("p") + 1, F.col("q") - F.col("p")).alias("b"), (F.col("q") < F.size("a")).alias("more"))
    return part.select(_KEY, F.get("b", F.lit(0)).alias("start_us"), F.element_at("b", -1).alias("last_us"), F.array_max("b").alias("max_us"),
                       F.size("b").cast("long").alias("n"), F.array_sort("b").alias("ts_list"), _close(F.col("more"), F.col(_LAST)).alias("close"))


def next_above(rows: DataFrame, max_us: int, folder: str) -> DataFrame:
    """(key, src, dst): the next position in the key after ``src`` whose time is above that of ``src`` + ``max_us``."""
    block = lambda c: F.floor(F.col(c) / F.lit(BLOCK)).cast("long")
    # Level by level: the blocks of the level below, each an array of (position, maximum).
    levels, now = [], rows.select(_KEY, F.col(_POS).alias("p"), F.col("us").alias("m"))
    while True:
        lvl = _written(now.groupBy(_KEY, block("p").alias("b")).agg(F.array_sort(F.collect_list(F.struct("p", "m"))).alias("arr")), folder, f"max-{len(levels)}")
        levels.append(lvl)
        if lvl.filter("b > 0").isEmpty():
            break
        now = lvl.select(_KEY, F.col("b").alias("p"), F.array_max(F.transform("arr", lambda x: x["m"])).alias("m"))

    def first(behind: bool) -> Column:
        hit = F.filter("arr", lambda x: (x["m"] > F.col("thr")) & ((x["p"] > F.col("at")) if behind else F.lit(True)))
        return F.get(hit, F.lit(0))["p"]

    climb = rows.select(_KEY, F.col(_POS).alias("src"), (F.col("us") + F.lit(max_us)).alias("thr"), F.col(_POS).alias("at"))
    found = []
    for k, lvl in enumerate(levels):
        step = climb.withColumn("b", block("at")).join(lvl, [_KEY, "b"]).withColumn("hit", first(True))
        step = _written(step.select(_KEY, "src", "thr", "b", "hit"), folder, f"up-{k}")
        found.append(step.filter("hit is not null").select(_KEY, "src", "thr", F.col("hit").alias("b")))
        climb = step.filter("hit is null").select(_KEY, "src", "thr", F.col("b").alias("at"))
    down = found[-1]
    for k in range(len(levels) - 2, -1, -1):
        # What was found above names a block of this level; its first number above the threshold is the answer here.
        into = down.join(levels[k], [_KEY, "b"]).select(_KEY, "src", "thr", first(False).alias("b"))
        down = _written(into.unionByName(found[k]), folder, f"down-{k}")
    return down.select(_KEY, "src", F.col("b").alias("dst"))


def _doubled(rows: DataFrame, max_us: int, folder: str, lists: bool) -> DataFrame:
    ends = rows.select(_KEY, F.col(_POS).alias("src"), "__end")
    jump = next_above(rows, max_us, folder).join(ends, [_KEY, "src"]).filter("dst <= __end").select(_KEY, "src", "dst")
    starts = orbit(jump, rows.filter(F.col(_POS) == F.col(_HEAD)).select(_KEY, F.col(_POS).alias("src")), folder)
    marked = rows.join(starts.select(_KEY, F.col("src").alias(_POS), F.lit(True).alias("__start")), [_KEY, _POS], "left")
    # Positions are dense, so buckets of them hold equal numbers of rows.
    cut = F.floor(F.col(_POS) / F.lit(1_000_000)).cast("long")
    marked = ordered_scan(marked, [_KEY], [_POS], {"__first": ("max", F.when(F.col("__start"), F.col(_POS)))}, cut)
    return marked.groupBy(_KEY, "__first").agg(
        F.min_by("us", _POS).alias("start_us"), F.max_by("us", _POS).alias("last_us"), F.max("us").alias("max_us"), F.count(F.lit(1)).alias("n"),
        (F.array_sort(F.collect_list("us")) if lists else F.lit(None).cast("array<bigint>")).alias("ts_list"),
        (F.max(_POS) < F.max("__end")).alias("more"), F.max(_LAST).alias(_LAST),
    ).select(_KEY, "start_us", "last_us", "max_us", "n", "ts_list", _close(F.col("more"), F.col(_LAST)).alias("close"))
