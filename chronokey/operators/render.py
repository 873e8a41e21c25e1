"""Human-readable messages in the wording of the original jobs (J10)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: message wording of the original jobs ----
MEAN_MESSAGE = "Average temperature for sensor %s for window ending at %d = %s"
ALERT_MESSAGE = "ALERT: Sensor %s has been inactive for %d seconds"
COUNT_MESSAGE = "User %s had %d events in window [%s,%s)"
SESSION_MESSAGE = "Session for user %s [%s,%s) -> Events: [%s]"
CAPPED_MESSAGE = "Window([%s]) // closed by %s (start=%d, end=%d)"
# ---- end of fixed values ----


def _java_timestamp(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss.f`` with trailing zeros of the fraction cut (at
    least one digit), the text form of a SQL timestamp; always UTC here."""
    frac = F.regexp_replace(F.date_format(c, "SSSSSS"), "0+$", "")
    return F.concat(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit("."), F.when(frac == "", F.lit("0")).otherwise(frac))


def _message(kind: str, key: str) -> Column:
    k = F.col(key).cast("string")
    if kind == "mean":
        return F.format_string(MEAN_MESSAGE, k, F.unix_millis("window_end"), F.col("mean").cast("string"))
    if kind == "alert":
        return F.format_string(ALERT_MESSAGE, k, F.col("idle_seconds"))
    if kind == "early_count":
        return F.format_string(
            COUNT_MESSAGE, k, F.col("count"), _java_timestamp(F.col("window_start")), _java_timestamp(F.col("window_end"))
        )
    if kind == "terminated_sessions":
        return F.format_string(
            SESSION_MESSAGE,
            k,
            _java_timestamp(F.col("session_start")),
            _java_timestamp(F.col("session_end")),
            F.array_join("event_types", ", "),
        )
    if kind == "capped_sessions":
        ms = F.transform("timestamps", lambda t: F.unix_millis(t).cast("string"))
        return F.format_string(
            CAPPED_MESSAGE,
            F.array_join(ms, ", "),
            F.col("reason"),
            F.unix_millis("session_start"),
            F.unix_millis("session_end"),
        )
    raise ValueError(f"unknown message kind {kind!r}")


def render(df: DataFrame, kind: str, key: str = "key") -> DataFrame:
    """Add a ``message`` column. ``kind``: mean, alert, monitor, early_count,
    terminated_sessions, capped_sessions."""
    if kind == "monitor":
        msg = F.when(
            F.col("kind") == "mean",
            F.format_string(MEAN_MESSAGE, F.col(key).cast("string"), F.unix_millis("at"), F.col("value").cast("string")),
        ).otherwise(F.format_string(ALERT_MESSAGE, F.col(key).cast("string"), F.col("idle_seconds")))
        return df.withColumn("message", msg)
    return df.withColumn("message", _message(kind, key))
