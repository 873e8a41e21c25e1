"""Parquet readers for the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Physical schema of events.parquet (ts is stored as timestamp[us] without zone).
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_instant(df: DataFrame, col: str = "ts") -> DataFrame:
    """Reinterpret a zone-less timestamp as UTC instant (``TIMESTAMP``).

    ``unix_micros`` and friends reject ``TIMESTAMP_NTZ``; with the session zone
    pinned to UTC this cast keeps the wall-clock digits.
    """
    return df.withColumn(col, F.col(col).cast("timestamp"))


def read_events(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The ``events`` table with ``ts`` as a UTC ``TIMESTAMP``.

    Only ``columns`` are read (parquet column pruning); ``props`` is never
    needed by the operators.
    """
    cols = columns or ["event_id", "ts", "user_id", "event_type", "value"]
    return as_instant(read_table(spark, sf_dir, "events").select(*cols))
