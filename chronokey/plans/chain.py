"""Cap chains inside gap islands (the maximum-length rule of capped sessions).

Inside an island (rows of one key with gaps below the inactivity gap) the
session starts are a chain: the first row, then repeatedly the first row with
``ts > start + max``. This is a sequential rule, so it cannot be one window
expression. Two exact ways, picked per island by its row count:

* small islands (``<= fold_limit`` rows, and rows x sessions within
  ``FOLD_BUDGET``): collect the island's sorted times, fold them once with
  ``aggregate`` into the list of starts, and cut the list into sessions with
  ``slice``. One group is at most ``fold_limit`` rows.
* large islands: pointer doubling over DataFrame joins on their *distinct
  times* (sessions depend on times only, so repeated times and ``seq`` play no
  part). Every time gets a pointer ``nxt`` to the time that would start the next
  session if it were a start (an as-of lookup done with the bucketed scan).
  Jump tables ``nxt^(2^k)`` are built by self-joins on the unique
  ``(key, time)`` up to the first empty one, then the set of times reachable
  from the island's first time is expanded level by level. ``O(log chain
  length)`` joins, no group ever holds an island, and the join keys are unique
  so no key is hot. Every level is written to the shared checkpoint folder and
  read back: that cuts lineage, and the planner sees true file sizes (a
  checkpointed frame keeps a size estimate that each self-join would square).

The key travels as one struct column, so a null key joins like any other.

Result columns: key, start_us, last_us, n, ts_list (sorted; null for large
islands when ``lists=False``), next_us (time of the row after the session,
null for the key's last session).
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronokey.plans.scan import ordered_scan
from chronokey.session import checkpoint_dir

DEFAULT_FOLD_LIMIT = 100_000  # rows per island folded in one group (at most ~0.8 MB of longs)
# The fold costs about rows x sessions per island (each session start is
# located in the sorted times). Islands over this budget go to doubling.
FOLD_BUDGET = 50_000_000
_KEY = "__chain_key"


def chain_starts(
    d: DataFrame,
    key: str,
    ts_us: str,
    seq: str,
    island: str,
    max_us: int,
    bucket: Column | None = None,
    fold_limit: int | None = None,
    max_island_rows: int | None = None,
    lists: bool = True,
    max_steps: int | None = None,
) -> DataFrame:
    """``d`` has one row per event with ``key, ts_us, island, next_us``;
    returns one row per capped session (see module doc).
    ``max_island_rows`` is an upper bound on island size if known (rows of
    the largest key): when it is within ``fold_limit`` the plan stays a
    single lazy fold with no sizing join and no extra job. ``max_steps``
    (span / max length) bounds the sessions per island for the fold budget."""
    limit = DEFAULT_FOLD_LIMIT if fold_limit is None else fold_limit
    if fold_limit is None and max_steps:
        # sessions per island <= min(rows, max_steps): keep rows * sessions within budget
        limit = min(limit, max(FOLD_BUDGET // max_steps, math.isqrt(FOLD_BUDGET)))
    rows = d.select(F.struct(F.col(key)).alias(_KEY), ts_us, island, "next_us")

    def named(sessions: DataFrame) -> DataFrame:
        return sessions.select(F.col(f"{_KEY}.{key}").alias(key), "start_us", "last_us", "n", "ts_list", "next_us")

    if max_island_rows is not None and 0 < max_island_rows <= limit:
        return named(_fold_small(rows, ts_us, island, max_us))
    sizes = rows.groupBy(_KEY, island).agg(F.count(F.lit(1)).alias("__island_n"))
    sized = rows.join(sizes, [_KEY, island])
    small = _fold_small(sized.filter(F.col("__island_n") <= limit), ts_us, island, max_us)
    if limit > 0 and sizes.filter(F.col("__island_n") > limit).isEmpty():
        return named(small)
    big = _double_large(
        sized.filter(F.col("__island_n") > limit).drop("__island_n"), ts_us, island, max_us, bucket, lists
    )
    return named(small.unionByName(big))


def _last_next(time: Column) -> Column:
    """``next_us`` of the last row, as a max over (time, is null, next_us): of the rows at one
    time, all but the last have that same time next; a null marks the key's end."""
    return F.max(F.struct(time.alias("t"), F.col("next_us").isNull().alias("e"), F.col("next_us").alias("v")))["v"]


def _fold_small(rows: DataFrame, ts_us: str, island: str, max_us: int) -> DataFrame:
    isl = rows.groupBy(_KEY, island).agg(
        F.array_sort(F.collect_list(ts_us)).alias("a"),
        _last_next(F.col(ts_us)).alias("island_next"),
    )
    starts = F.expr(
        f"""aggregate(a,
                named_struct('cur', CAST(NULL AS BIGINT), 'acc', CAST(array() AS ARRAY<BIGINT>)),
                (st, t) -> IF(st.cur IS NULL OR t > st.cur + {max_us},
                              named_struct('cur', t, 'acc', concat(st.acc, array(t))), st),
                st -> st.acc)"""
    )
    cuts = F.expr(
        """transform(sequence(1, size(s)), i -> named_struct(
               'start_us', element_at(s, i),
               'p', CAST(array_position(a, element_at(s, i)) AS INT),
               'q', IF(i < size(s), CAST(array_position(a, element_at(s, i + 1)) AS INT), size(a) + 1),
               'next_us', IF(i < size(s), element_at(s, i + 1), island_next)))"""
    )
    return (
        isl.select(_KEY, "a", "island_next", starts.alias("s"))
        .select(_KEY, "a", F.explode(cuts).alias("c"))
        .select(
            _KEY,
            F.col("c.start_us").alias("start_us"),
            F.expr("slice(a, c.p, c.q - c.p)").alias("ts_list"),
            F.col("c.next_us").alias("next_us"),
        )
        .select(
            _KEY,
            "start_us",
            F.element_at("ts_list", -1).alias("last_us"),
            F.size("ts_list").cast("long").alias("n"),
            "ts_list",
            "next_us",
        )
    )


def _written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back."""
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")


def orbit(jump: DataFrame, heads: DataFrame, folder: str) -> DataFrame:
    """All that is reached from ``heads`` (key, src) by any number of jumps (key, src, dst; one for each src)."""

    def square(lvl: DataFrame) -> DataFrame:
        a, b = lvl.alias("a"), lvl.alias("b")
        return a.join(b, (F.col(f"a.{_KEY}") == F.col(f"b.{_KEY}")) & (F.col("a.dst") == F.col("b.src"))).select(
            F.col(f"a.{_KEY}").alias(_KEY), F.col("a.src").alias("src"), F.col("b.dst").alias("dst")
        )

    # Jumps of 1, 2, 4, ... steps; a level is empty once no chain is that long.
    levels = [_written(jump, folder, "level-0")]
    while not levels[-1].isEmpty():
        levels.append(_written(square(levels[-1]), folder, f"level-{len(levels)}"))

    # After a level of 2^k steps the set holds nxt^j(head) for all multiples j of 2^k in the chain.
    starts = heads
    for k, lvl in reversed(list(enumerate(levels[:-1]))):
        hop = starts.join(lvl, [_KEY, "src"]).select(_KEY, F.col("dst").alias("src"))
        starts = _written(starts.unionByName(hop).distinct(), folder, f"starts-{k}")
    return starts


def _double_large(
    rows: DataFrame, ts_us: str, island: str, max_us: int, bucket: Column | None, lists: bool = True
) -> DataFrame:
    folder = f"{checkpoint_dir(rows.sparkSession).rstrip('/')}/chains/{uuid.uuid4().hex}"
    # One row per distinct time, read several times below: written once.
    times = _written(
        rows.groupBy(_KEY, ts_us).agg(
            F.min(island).alias(island), F.count(F.lit(1)).alias("__n"), _last_next(F.col(ts_us)).alias("next_us")
        ),
        folder, "times",
    )
    # nxt(t): first time > t + max, as an as-of lookup. Targets and probes are
    # merged and scanned backwards (descending order), where "first target
    # after the probe" is the running max of the marker -t over the rows
    # already seen. At equal time a target sorts before the probe, so
    # t + max itself is not taken (strict >).
    targets = times.select(_KEY, F.col(ts_us).alias("__t"), F.lit(0).alias("__k"), island, F.col(ts_us).alias("__src"))
    probes = times.select(_KEY, (F.col(ts_us) + F.lit(max_us)).alias("__t"), F.lit(1).alias("__k"), island, F.col(ts_us).alias("__src"))
    both = targets.unionByName(probes)
    marker = F.when(F.col("__k") == 0, F.struct((-F.col("__t")).alias("nt"), F.col(island).alias("i")))
    rev_bucket = None if bucket is None else -bucket.cast("long")
    if rev_bucket is not None:
        both = both.withColumn(ts_us, F.col("__t"))  # the bucket expression reads ts_us
    scanned = ordered_scan(both, [_KEY], [-F.col("__t"), -F.col("__k")], {"__m": ("max_before", marker)}, rev_bucket)
    jump = scanned.filter(F.col("__k") == 1).select(
        _KEY,
        F.col("__src").alias("src"),
        F.when(F.col("__m.i") == F.col(island), -F.col("__m.nt")).alias("dst"),
    ).filter(F.col("dst").isNotNull())

    starts = orbit(jump, times.select(_KEY, F.col(island).alias("src")).distinct(), folder)
    marked = times.join(
        starts.select(F.col(_KEY).alias("__sk"), F.col("src"), F.lit(True).alias("__start")),
        (F.col(_KEY) == F.col("__sk")) & (F.col(ts_us) == F.col("src")), "left",
    ).select(_KEY, ts_us, "next_us", "__n", "__start")
    labelled = ordered_scan(
        marked, [_KEY], [ts_us], {"start_us": ("max", F.when(F.col("__start"), F.col(ts_us)))}, bucket
    )
    repeated = F.array_repeat(F.col(ts_us), F.col("__n").cast("int"))
    return labelled.groupBy(_KEY, "start_us").agg(
        F.max(ts_us).alias("last_us"),
        F.sum("__n").alias("n"),
        (F.array_sort(F.flatten(F.collect_list(repeated))) if lists else F.lit(None).cast("array<bigint>")).alias("ts_list"),
        _last_next(F.col(ts_us)).alias("next_us"),
    ).select(_KEY, "start_us", "last_us", "n", "ts_list", "next_us")
