"""Largest task of the streams that keep every row, with a third of all rows under one key.

Runs each stream over ``events`` (skewed, fed in parts) in a session of its own with Spark's event
log in a scratch folder, and reports from that log how many rows the largest task
got from shuffles, against the hot key's rows in a micro-batch. One JSON line for each stream:

    python tools/hot_streams.py [sf_dir] [target_rows] [parts]
"""

from __future__ import annotations

import json
import sys
import tempfile
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

HOT = -7


def largest_reads(folder: str) -> dict[str, int]:
    """Per job group: the most rows that a task read from shuffles."""
    group, most = {}, {}
    for path in Path(folder).rglob("*"):
        if not path.is_file():
            continue
        for line in path.open(errors="replace"):
            e = json.loads(line) if line.startswith("{") else {}
            if e.get("Event") == "SparkListenerJobStart":
                name = (e.get("Properties") or {}).get("spark.chronokey.step", "")
                group.update((s, name) for s in e["Stage IDs"])
            elif e.get("Event") == "SparkListenerTaskEnd":
                read = ((e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                name = group.get(e["Stage ID"], "")
                most[name] = max(most.get(name, 0), read)
    return most


def main(argv: list[str]) -> None:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.1"
    target, parts = int(argv[1]) if len(argv) > 1 else 2000, int(argv[2]) if len(argv) > 2 else 2
    from pyspark.sql import functions as F

    from chronokey import arrival_window_mean, capped_sessions, terminated_sessions
    from chronokey.plans import scan
    from chronokey.session import get_spark
    from chronokey.sources.tables import read_events
    from chronokey.streaming.revised import ArrivalMeanStream, CappedSessionStream, TerminatedSessionStream

    base = tempfile.mkdtemp(prefix="hot-streams-")
    log = Path(base, "events")
    log.mkdir()
    spark = get_spark("local[8]", shuffle_partitions=32, **{
        "spark.checkpoint.dir": f"{base}/checkpoint", "spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{log}",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    # Small partitions stay apart, so that a task is one partition, as on large data.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set(scan.TARGET_ROWS_CONF, str(target))
    ev = read_events(spark, sf_dir).withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(HOT)).otherwise(F.col("user_id")))
    n = ev.count()
    key_type = ev.schema["user_id"].dataType
    kinds = {
        "arrival_mean": (lambda f: ArrivalMeanStream(spark, f, key_type, "user_id", "ts", "value", "event_id", "1 day"),
                         lambda d: arrival_window_mean(d, "user_id", "ts", "value", "event_id", "1 day"), lambda op: op.output().drop("revision")),
        "capped": (lambda f: CappedSessionStream(spark, f, key_type, "user_id", "ts", "event_id", "1 hour", "3 hours"),
                   lambda d: capped_sessions(d, "user_id", "ts", "event_id", "1 hour", "3 hours", "event_time"), lambda op: op.latest()),
        "terminated": (lambda f: TerminatedSessionStream(spark, f, key_type, "user_id", "ts", "event_id", "event_type", "1 hour", ("purchase", "error")),
                       lambda d: terminated_sessions(d, "user_id", "ts", "event_id", "event_type", "1 hour", ("purchase", "error")), lambda op: op.latest()),
    }
    out = {}
    for name, (make, batch, read) in kinds.items():
        spark.sparkContext.setLocalProperty("spark.chronokey.step", name)
        op = make(f"{base}/{name}")
        op.begin()
        for k in range(parts):
            # Every part spans the whole time, so later parts are late all over.
            op.update(ev.filter(F.pmod(F.floor(F.col("event_id") / 3), F.lit(parts)) == k), k)
        op.flush()
        spark.sparkContext.setLocalProperty("spark.chronokey.step", "")
        rounded = lambda d: d.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in d.dtypes])
        got, want = rounded(read(op)), rounded(batch(ev))
        out[name] = {"stream": name, "rows": n, "hot_rows_a_batch": n // 3 // parts, "equal_to_batch": got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()}
    spark.stop()
    most = largest_reads(str(log))
    for name, line in out.items():
        print(json.dumps(line | {"largest_task_rows": most.get(name)}), flush=True)


if __name__ == "__main__":
    main(sys.argv[1:])
