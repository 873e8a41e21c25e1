"""Tumbling windows that emit early once a count is reached (J6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronokey.functions.time import duration_us, epoch_us, from_epoch_us, window_floor
from chronokey.operators._common import as_list, order_value
from chronokey.operators.late import drop_late
from chronokey.plans.scan import ordered_scan, resolve_bucket

# ---- fixed values: defaults of the original early-count job ----
EARLY_WIDTH = "1 hour"
EARLY_N = 5
# ---- end of fixed values ----


def early_count(
    df: DataFrame,
    key: str = "user_id",
    ts: str = "ts",
    seq="seq",
    width=EARLY_WIDTH,
    n: int = EARLY_N,
    include_final: bool = True,
    once: bool = False,
    bucket="auto",
    target_rows: int | None = None,
    delay=None,
) -> DataFrame:
    """Per-key tumbling windows that fire early.

    Within a (key, window), rows are counted in arrival order ``seq``; from
    the ``n``-th row on, *every* row fires an ``early`` pane with the count
    so far (``once=True``: only the ``n``-th). With ``include_final`` every
    window also emits a ``final`` pane with its full count at window end.

    ``delay``: leave out the rows that arrive after the watermark (this much
    behind the latest time seen before) has passed their window, as a live
    windowed job drops them; None takes every row.

    Output: key, window_start, window_end, count, pane.
    The running count is a bucketed scan over ``(key, window)`` split by the
    first ``seq`` column; the final panes are a plain partial aggregate.
    """
    width_us = duration_us(width)
    order = as_list(seq)
    if delay is not None:
        df = drop_late(df.select(*dict.fromkeys([key, *order, ts])), ts, order, delay, width, target_rows=target_rows)
    d = df.select(key, *order, window_floor(epoch_us(ts), width_us).alias("__ws"))
    b = resolve_bucket(d, [key, "__ws"], order_value(d, order[0]), bucket, target_rows)
    specs = {"count": ("sum", F.lit(1).cast("long"))}
    if include_final and delay is not None:
        specs["__next"] = ("next", F.lit(1))
    counted = ordered_scan(d, [key, "__ws"], order, specs, b)
    fire = F.col("count") == F.lit(n) if once else F.col("count") >= F.lit(n)

    def shape(x: DataFrame, pane: Column) -> DataFrame:
        return x.select(
            key,
            from_epoch_us("__ws").alias("window_start"),
            from_epoch_us(F.col("__ws") + F.lit(width_us)).alias("window_end"),
            "count",
            pane.alias("pane"),
        )

    early, final = F.lit("early"), F.lit("final")
    if "__next" in specs:
        # Judging lateness shuffles the rows once already, so both panes come from the one counted
        # pass: a window's last row carries its final count.
        panes = F.array(F.when(fire, early), F.when(F.col("__next").isNull(), final))
        return shape(counted.withColumn("__pane", F.explode(F.array_compact(panes))), F.col("__pane"))
    out = shape(counted.filter(fire), early)
    if include_final:
        totals = d.groupBy(key, "__ws").agg(F.count(F.lit(1)).alias("count"))
        out = out.unionByName(shape(totals, final))
    return out
