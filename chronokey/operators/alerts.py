"""Inactivity alerts (J3) and the combined sensor monitor output (J4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronokey.functions.time import duration_us, from_epoch_us
from chronokey.operators._common import order_value
from chronokey.operators.windows import DEFAULT_WIDTH, arrival_window_mean
from chronokey.plans.scan import ordered_scan

# ---- fixed values: default inactivity threshold of the original sensor job ----
DEFAULT_THRESHOLD = "10 seconds"
# ---- end of fixed values ----


def inactivity_alerts(
    df: DataFrame,
    key: str = "sensor_id",
    time_col: str = "ts",
    seq: str = "seq",
    threshold=DEFAULT_THRESHOLD,
    include_open: bool = False,
    bucket="auto",
    target_rows: int | None = None,
) -> DataFrame:
    """One alert per silence of at least ``threshold`` after a row of a key.

    ``time_col`` plays the role of processing time (e.g. an ingest time
    column, as a timestamp or as epoch microseconds). Rows are taken in ``(time, seq)`` order; a row raises an alert at
    ``time + threshold`` when the key's next row is that late or later. The
    key's last row raises one only with ``include_open`` (a live stream would
    fire it; a finished bounded run does not).

    Default (``bucket="auto"`` or an int): aggregate-only over buckets no
    wider than the threshold (partial aggregation, a window over at most
    span/threshold buckets per key). ``bucket=None``: a plain ``lead`` window.

    Output: key, last_seen, alert_time, idle_seconds, next_seen.
    """
    thr = duration_us(threshold)
    d = df.select(key, seq, order_value(df, time_col).alias("__t")).filter(F.col("__t").isNotNull())
    if bucket is None:
        d = ordered_scan(d, [key], ["__t", seq], {"__next": ("next", "__t")})
    else:
        # Buckets no wider than the threshold: rows inside a bucket are less
        # than the threshold apart, so a long enough silence can only follow
        # a bucket's last row. Aggregate-only: no raw row is shuffled.
        width = min(bucket, thr) if isinstance(bucket, int) else thr
        d = (
            d.groupBy(F.struct(key).alias("__k"), F.floor(F.col("__t") / F.lit(width)).alias("__b"))
            .agg(F.min("__t").alias("__first"), F.max("__t").alias("__t"))
            .select(
                F.col(f"__k.{key}").alias(key),
                "__t",
                F.lead("__first").over(Window.partitionBy("__k").orderBy("__b")).alias("__next"),
            )
        )
    late_next = F.col("__next") - F.col("__t") >= F.lit(thr)
    cond = late_next | F.col("__next").isNull() if include_open else late_next
    return d.filter(cond).select(
        key,
        from_epoch_us("__t").alias("last_seen"),
        from_epoch_us(F.col("__t") + F.lit(thr)).alias("alert_time"),
        F.lit(thr // 1_000_000).alias("idle_seconds"),
        from_epoch_us("__next").alias("next_seen"),
    )


def sensor_monitor(
    df: DataFrame,
    key: str = "sensor_id",
    ts: str = "ts",
    value: str = "temperature",
    seq="seq",
    width=DEFAULT_WIDTH,
    threshold=DEFAULT_THRESHOLD,
    time_col: str | None = None,
    include_open: bool = False,
    bucket="auto",
) -> DataFrame:
    """Both outputs of the sensor job in one table.

    kind='mean': at = window end, value = mean, n = count (arrival-order
    windows). kind='alert': at = alert time and idle_seconds, value and n null.
    """
    means = arrival_window_mean(df, key, ts, value, seq, width, bucket=bucket).select(
        key, F.lit("mean").alias("kind"), F.col("window_end").alias("at"), F.col("mean").alias("value"), "n"
    )
    seq_col = seq if isinstance(seq, str) else seq[-1]
    alerts = inactivity_alerts(df, key, time_col or ts, seq_col, threshold, include_open, bucket=bucket).select(
        key, F.lit("alert").alias("kind"), F.col("alert_time").alias("at"), "idle_seconds"
    )
    return means.unionByName(alerts, allowMissingColumns=True)
