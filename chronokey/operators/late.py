"""Which rows a tumbling-window job with a bounded-disorder watermark drops (J7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronokey.functions.time import duration_us, epoch_us, from_epoch_us, window_floor
from chronokey.operators._common import as_list, order_value
from chronokey.plans.scan import ordered_scan, resolve_bucket

# ---- fixed values: watermark delay and window of the original windowed jobs ----
DEFAULT_DELAY = "5 seconds"
DEFAULT_WIDTH = "1 hour"
# ---- end of fixed values ----

MIN_BUCKETS = 64


def late_audit(
    df: DataFrame,
    key: str = "user_id",
    ts: str = "ts",
    seq="seq",
    delay=DEFAULT_DELAY,
    width=DEFAULT_WIDTH,
    bucket="auto",
    target_rows: int | None = None,
) -> DataFrame:
    """Flag rows that arrive after the watermark passed their window.

    The watermark is per source (before keying), so it is global: the largest
    event time among all rows that arrived earlier (order ``seq``), minus
    ``delay``. A row is late when its window end is at or before it.

    The global running maximum is a bucketed scan with no key: rows are split
    into arrival-order buckets, each bucket's max is prefix-maxed over the
    (small) bucket summary and joined back. Output: key, seq columns, ts,
    watermark_before, is_late.
    """
    order = as_list(seq)
    columns = [key, *[c for c in order if c != key], ts]
    d = _judged(df.select(*columns), ts, order, delay, width, bucket, target_rows)
    return d.select(*columns, from_epoch_us("__wm").alias("watermark_before"), F.col("__late").alias("is_late"))


def drop_late(
    df: DataFrame,
    ts: str = "ts",
    seq="seq",
    delay=DEFAULT_DELAY,
    width=DEFAULT_WIDTH,
    bucket="auto",
    target_rows: int | None = None,
) -> DataFrame:
    """``df`` without the rows that :func:`late_audit` flags."""
    return _judged(df, ts, as_list(seq), delay, width, bucket, target_rows).filter(~F.col("__late")).select(*df.columns)


def _judged(df: DataFrame, ts: str, order: list[str], delay, width, bucket, target_rows: int | None) -> DataFrame:
    delay_us, width_us = duration_us(delay), duration_us(width)
    d = df.withColumn("__us", epoch_us(ts))
    # No key: always split into buckets, even for small inputs.
    b = resolve_bucket(d, [], order_value(d, order[0]), bucket, target_rows, min_buckets=MIN_BUCKETS)
    d = ordered_scan(d, [], order, {"__max_before": ("max_before", "__us")}, b)
    end = window_floor(F.col("__us"), width_us) + F.lit(width_us)
    d = d.withColumn("__wm", F.col("__max_before") - F.lit(delay_us))
    return d.withColumn("__late", F.coalesce(end <= F.col("__wm"), F.lit(False)))
