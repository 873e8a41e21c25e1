"""The four hard-coded sample inputs of the original demos, as DataFrames.

``seq`` is the position in the list, i.e. arrival order. ``ts`` is the epoch
millisecond value turned into a UTC ``TIMESTAMP``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values: sample rows of the original demos (must stay as given) ----
SENSOR_SAMPLE = [
    ("sensor_1", 0, 22.5),
    ("sensor_1", 5000, 23.0),
    ("sensor_1", 11000, 21.0),
    ("sensor_1", 10000, 24.0),
    ("sensor_2", 3000, 30.0),
    ("sensor_2", 61000, 32.0),
]
EARLY_COUNT_SAMPLE = [
    ("user_1", "page_view", 1738362000000),
    ("user_1", "add_to_cart", 1738362001000),
    ("user_1", "page_view", 1738362002000),
    ("user_1", "page_view", 1738362003000),
    ("user_1", "checkout", 1738362004000),
    ("user_1", "page_view", 1738362060000),
    ("user_2", "page_view", 1738362000000),
    ("user_2", "page_view", 1738362005000),
    ("user_2", "page_view", 1738362010000),
    ("user_2", "page_view", 1738362015000),
    ("user_2", "checkout", 1738362020000),
]
TERMINATED_SESSION_SAMPLE = [
    ("user_1", "login", 1738362000000),
    ("user_1", "click", 1738362005000),
    ("user_1", "click", 1738362010000),
    ("user_1", "LOGOUT", 1738362020000),
    ("user_1", "login", 1738365600000),
    ("user_1", "click", 1738365605000),
    ("user_1", "click", 1738365625000),
    ("user_2", "login", 1738369895000),
    ("user_2", "click", 1738369899000),
    ("user_2", "CHECKOUT_COMPLETE", 1738369999000),
]
CAPPED_SESSION_SAMPLE = [
    ("user1", "click", 1000),
    ("user1", "scroll", 2000),
    ("user1", "view", 3000),
    ("user1", "click", 5000),
    ("user1", "scroll", 6000),
    ("user1", "click", 9000),
    ("user1", "view", 15000),
    ("user1", "click", 19000),
    ("user1", "click", 22000),
]
# ---- end of fixed values ----


def sensor_readings(spark: SparkSession, rows=None) -> DataFrame:
    rows = SENSOR_SAMPLE if rows is None else rows
    data = [(i, k, ms, t) for i, (k, ms, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "seq long, sensor_id string, ts_ms long, temperature double")
    return df.withColumn("ts", F.timestamp_millis("ts_ms"))


def user_events(spark: SparkSession, rows) -> DataFrame:
    data = [(i, k, e, ms) for i, (k, e, ms) in enumerate(rows)]
    df = spark.createDataFrame(data, "seq long, user_id string, event_type string, ts_ms long")
    return df.withColumn("ts", F.timestamp_millis("ts_ms"))
