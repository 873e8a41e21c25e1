"""Tumbling-window means (J1) and the arrival-order mean of the sensor job (J2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronokey.functions.time import duration_us, epoch_us, from_epoch_us, window_floor
from chronokey.operators._common import as_list, order_value
from chronokey.plans.scan import ordered_scan, resolve_bucket

# Defaults are the constants of the original sensor job: 1-minute windows.
DEFAULT_WIDTH = "60 seconds"


def tumbling_mean(
    df: DataFrame, key: str = "sensor_id", ts: str = "ts", value: str = "temperature", width=DEFAULT_WIDTH
) -> DataFrame:
    """Per-key epoch-aligned tumbling windows: count and mean of ``value``.

    Output: key, window_start, window_end, n, mean. A single hash aggregate
    with map-side partial aggregation, so a hot key is pre-combined in every
    input partition before the exchange. Works unchanged on a streaming
    DataFrame that has a watermark on ``ts`` (append mode).
    """
    t = F.col(ts) if isinstance(df.schema[ts].dataType, T.TimestampType) else F.col(ts).cast("timestamp")
    w = F.window(t, f"{duration_us(width)} microseconds")
    return (
        df.groupBy(F.col(key), w.alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))
        .select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "mean")
    )


def arrival_window_mean(
    df: DataFrame,
    key: str = "sensor_id",
    ts: str = "ts",
    value: str = "temperature",
    seq="seq",
    width=DEFAULT_WIDTH,
    bucket="auto",
    target_rows: int | None = None,
) -> DataFrame:
    """The sensor job's mean, including its handling of out-of-order rows.

    Rows are taken in arrival order ``seq`` (a column or list of columns). A
    row is added to the key's open window if its time is before that window's
    end, otherwise it closes the open window and opens its own. Closed form:
    the window end of a row is the running maximum, in arrival order, of the
    natural window end ``ts - ts % width + width``.

    Output as :func:`tumbling_mean`. The running maximum uses the bucketed
    scan, split by the first ``seq`` column.
    """
    width_us = duration_us(width)
    order = as_list(seq)
    us = epoch_us(ts)
    d = df.select(key, value, *order, (window_floor(us, width_us) + F.lit(width_us)).alias("__natural_end"))
    b = resolve_bucket(d, [key], order_value(d, order[0]), bucket, target_rows)
    d = ordered_scan(d, [key], order, {"__end": ("max", "__natural_end")}, b)
    return (
        d.groupBy(key, "__end")
        .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))
        .select(
            key,
            from_epoch_us(F.col("__end") - F.lit(width_us)).alias("window_start"),
            from_epoch_us("__end").alias("window_end"),
            "n",
            "mean",
        )
    )
