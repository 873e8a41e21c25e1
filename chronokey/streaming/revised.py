"""Streams that keep every row, however late, and correct what they have said.

The original process functions handle every record, with no look at the watermark; Spark's
stateful operators drop rows behind it. Here each micro-batch is handled as a DataFrame
(``foreachBatch``), with the state in versioned tables (:mod:`chronokey.streaming.versions`), so

* a row behind the watermark counts like any other, and the result over all batches equals
  the batch operator over all rows;
* a batch that runs again after a failure gives the same rows again and they count once;
* the work inside a batch is the batch operators' own: a key that holds a third of the rows
  is cut into buckets (``plans/scan.py``) instead of going to one worker.

Arrival-order means need no more state than each key's open window. Sessions are taken in
event-time order, where a late row can change a session long closed. The rows are kept in a log,
and a batch works out anew the sessions near its rows: those whose times reach within the gap
of a new row, merged where they bridge. Results that are new or differ go out under
the batch's number as *revision*, ids that no longer exist as retracted; :func:`latest` is
the reader that lets the last revision stand. What can be said at once is said at once (a segment
closed by a terminator); a session that only time can close waits until the watermark has passed
its end.

Rows without a time are left out, as in the batch operators. Null keys are keys.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronokey.functions.time import duration_us, epoch_us, from_epoch_us, window_floor
from chronokey.operators._common import as_list, order_value
from chronokey.operators.alerts import DEFAULT_THRESHOLD
from chronokey.operators.late import DEFAULT_DELAY as LATE_DELAY
from chronokey.operators.late import DEFAULT_WIDTH as LATE_WIDTH
from chronokey.operators.late import MIN_BUCKETS
from chronokey.operators.sessions import (
    CAPPED_GAP, CAPPED_MAX, TERMINATED_GAP, TERMINATORS, capped_sessions, gap_sessions, terminated_sessions,
)
from chronokey.operators.windows import DEFAULT_WIDTH
from chronokey.plans.scan import ordered_scan, resolve_bucket, session_summary, target_rows_for
from chronokey.streaming.versions import GONE, VersionedTable

_FOREVER = 2**62  # the watermark after the end of the input
_US, _SEQ = "__us", "__seq"


class _Revised:
    """What the operators share: the folder, the watermark's own table and the run."""

    def __init__(self, spark: SparkSession, folder: str, delay):
        self.spark, self.folder, self.delay_us = spark, folder.rstrip("/"), duration_us(delay)
        self.spread = 1  # tasks that share a bucket's rows when a batch is logged

    def table(self, name: str, schema: T.StructType, key: str, ids: list[str] | None = None) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.folder}/{name}", schema, key, ids)

    _MARK = "version long, top_us long"

    def _mark(self, version: int, top: int | None) -> None:
        self.spark.createDataFrame([(version, top)], self._MARK).coalesce(1).write.mode("overwrite").parquet(
            f"{self.folder}/watermark/version={version}")

    def _marks(self, folder: str) -> DataFrame:
        return self.spark.read.schema(self._MARK).parquet(f"{self.folder}/watermark/{folder}")

    def begin(self) -> None:
        """The state before the first batch (a mark without a time) and an empty output."""
        none = self.spark.createDataFrame([(-1, None)], self._MARK)
        none.coalesce(1).write.mode("ignore").parquet(f"{self.folder}/watermark/version=-1")
        self.spark.createDataFrame([], self.out_schema()).write.mode("ignore").parquet(f"{self.folder}/out/revision=-1")

    def _emit(self, rows: DataFrame, version: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/out/revision={version}")

    def update(self, batch: DataFrame, version: int) -> None:
        """Handle a micro-batch; ``version`` is its id."""
        rows = self.prepared(batch).persist()
        try:
            held = rows.agg(F.max(_US).alias("top"), F.count(F.lit(1)).alias("n")).first()
            self.spread = max(1, -(-held["n"] // target_rows_for(rows, self.target_rows)))
            tops = [held["top"], self._marks(f"version={version - 1}").first()["top_us"]]
            top = max((t for t in tops if t is not None), default=None)
            self.handle(rows, version, None if top is None else top - self.delay_us)
            # The version is complete once this is written; the next one starts from it.
            self._mark(version, top)
        finally:
            rows.unpersist()

    def run(self, sdf: DataFrame, **trigger) -> DataFrame:
        """Run the stream to the end of what is there (or with another ``trigger``) and return what was put out."""
        self.begin()
        query = sdf.writeStream.foreachBatch(self.update).option("checkpointLocation", f"{self.folder}/checkpoint").trigger(
            **(trigger or {"availableNow": True})).start()
        query.awaitTermination()
        return self.output()

    def flush(self) -> DataFrame:
        """The end of the input: the watermark passes everything that is open.

        It takes the number of the next batch, which would overwrite it, so a stream can go on after it.
        """
        last = self._marks("*").agg(F.max("version")).first()[0]
        self.handle(self.spark.createDataFrame([], self.state_schema()), last + 1, _FOREVER)
        return self.output()

    def output(self) -> DataFrame:
        """All revisions put out so far, with the number of the batch in ``revision``."""
        schema = T.StructType([*self.out_schema().fields, T.StructField("revision", T.LongType())])
        return self.spark.read.schema(schema).option("basePath", f"{self.folder}/out").parquet(f"{self.folder}/out/revision=*")


def latest(revisions: DataFrame, ids: list[str]) -> DataFrame:
    """The rows that stand: of each id its last revision, unless that retracts it."""
    rest = [c for c in revisions.columns if c not in ids]
    last = revisions.groupBy(F.struct(*ids).alias("__id")).agg(F.max_by(F.struct(*rest), "revision").alias("__row"))
    return last.filter("not __row.retracted").select(
        *[F.col(f"__id.{c}" if c in ids else f"__row.{c}").alias(c) for c in revisions.columns if c not in ("revision", "retracted")])


class ArrivalMeanStream(_Revised):
    """J2 with every row kept: the open window of a key is all its state.

    Batches come in arrival order, rows of a batch by ``seq``. A row before the end of its key's
    open window joins it, however old; a later one closes it and opens its own. A
    window is put out as soon as a row closes it, and the last one at :meth:`flush`; none is
    revised. Output: key, window_start, window_end, n, mean.
    """

    def __init__(self, spark, folder, key_type: T.DataType, key="sensor_id", ts="ts", value="temperature", seq="seq", width=DEFAULT_WIDTH,
                 bucket="auto", target_rows: int | None = None):
        super().__init__(spark, folder, 0)
        self.key, self.ts, self.value, self.order, self.width_us = key, ts, value, as_list(seq), duration_us(width)
        self.key_type, self.bucket, self.target_rows = key_type, bucket, target_rows
        self.open = self.table("open", self.state_schema(), key, [key])

    def state_schema(self) -> T.StructType:
        return T.StructType([T.StructField(self.key, self.key_type), T.StructField(_US, T.LongType()), T.StructField("total", T.DoubleType()),
                             T.StructField("n", T.LongType()), T.StructField("known", T.LongType())])

    def out_schema(self) -> T.StructType:
        t = T.TimestampType()
        return T.StructType([T.StructField(self.key, self.key_type), T.StructField("window_start", t), T.StructField("window_end", t),
                             T.StructField("n", T.LongType()), T.StructField("mean", T.DoubleType())])

    def prepared(self, batch: DataFrame) -> DataFrame:
        columns = dict.fromkeys([self.key, *self.order])
        return batch.select(*columns, epoch_us(self.ts).alias(_US), F.col(self.value).cast("double").alias("__value")).filter(F.col(_US).isNotNull())

    def handle(self, rows: DataFrame, version: int, watermark_us: int | None) -> None:
        key, end = self.key, "__end"
        flushed = watermark_us == _FOREVER
        held = self.open.read(version, None if flushed else self.open.touched(rows))
        held = held.select(key, F.col(_US).alias(end), "total", "n", "known", F.lit(True).alias("held"))
        groups = held
        if not flushed:
            natural = window_floor(F.col(_US), self.width_us) + F.lit(self.width_us)
            cut = resolve_bucket(rows, [key], order_value(rows, self.order[0]), self.bucket, self.target_rows)
            d = ordered_scan(rows, [key], self.order, {end: ("max", natural)}, cut)
            new = d.groupBy(key, end).agg(F.sum("__value").alias("total"), F.count(F.lit(1)).alias("n"), F.count("__value").alias("known"))
            groups = held.unionByName(new.withColumn("held", F.lit(False)))
        # A handful of groups for each key: its windows in this batch and the one that was open.
        of_key = groups.groupBy(F.struct(key).alias("__k")).agg(
            F.max(F.when(F.col("held"), F.col(end))).alias("from"), F.max(end).alias("last"), F.min("held").alias("idle"))
        groups = groups.withColumn("__k", F.struct(key)).join(of_key, "__k")
        groups = groups.filter(F.lit(flushed) | ~F.col("idle")).withColumn(end, F.greatest(end, "from"))
        merged = groups.groupBy("__k", end, "last").agg(F.sum("total").alias("total"), F.sum("n").alias("n"), F.sum("known").alias("known")).select(
            F.col(f"__k.{key}").alias(key), end, "total", "n", "known", (F.lit(flushed) | (F.col(end) < F.col("last"))).alias("closed")).persist()
        self._emit(merged.filter("closed").select(
            key, from_epoch_us(F.col(end) - F.lit(self.width_us)).alias("window_start"), from_epoch_us(end).alias("window_end"), "n",
            F.when(F.col("known") > 0, F.col("total") / F.col("known")).alias("mean")), version)
        self.open.write(merged.filter("not closed").withColumnRenamed(end, _US), version)
        merged.unpersist()


class LateAuditStream(_Revised):
    """J7 as a stream: every row with the watermark just before it, and whether that had passed its window.

    The watermark is the source's: the latest time of all rows that arrived before, in this batch (by
    ``seq``) or an earlier one, less ``delay``. What is carried over batches is that one time. Output: key, seq
    columns, ts, watermark_before, is_late, one row for each row with a time.
    """

    def __init__(self, spark, folder, schema: T.StructType, key="user_id", ts="ts", seq="seq", delay=LATE_DELAY, width=LATE_WIDTH,
                 bucket="auto", target_rows: int | None = None):
        super().__init__(spark, folder, delay)
        self.key, self.ts, self.order, self.width_us = key, ts, as_list(seq), duration_us(width)
        self.columns = list(dict.fromkeys([key, *self.order, ts]))
        self.schema, self.bucket, self.target_rows = T.StructType([schema[c] for c in self.columns]), bucket, target_rows

    def state_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(_US, T.LongType())])

    def out_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("watermark_before", T.TimestampType()), T.StructField("is_late", T.BooleanType())])

    def prepared(self, batch: DataFrame) -> DataFrame:
        return batch.select(*self.columns, epoch_us(self.ts).alias(_US)).filter(F.col(_US).isNotNull())

    def handle(self, rows: DataFrame, version: int, watermark_us: int | None) -> None:
        carried = self._marks(f"version={version - 1}").first()["top_us"]
        cut = resolve_bucket(rows, [], order_value(rows, self.order[0]), self.bucket, self.target_rows, min_buckets=MIN_BUCKETS)
        d = rows if cut is None else ordered_scan(rows, [], self.order, {"__before": ("max_before", _US)}, cut)
        before = F.greatest(F.col("__before") if cut is not None else F.lit(None).cast("long"), F.lit(carried).cast("long"))
        mark = before - F.lit(self.delay_us)
        end = window_floor(F.col(_US), self.width_us) + F.lit(self.width_us)
        self._emit(d.select(*self.columns, from_epoch_us(mark).alias("watermark_before"), F.coalesce(end <= mark, F.lit(False)).alias("is_late")), version)

    def flush(self) -> DataFrame:
        """Nothing is open."""
        return self.output()


class _SessionStream(_Revised):
    """Sessions in event-time order with every row kept. Subclasses name the batch operator and its ids."""

    #: Logged rows meet the stretches to be worked out anew by cells of this many gaps.
    CELL_GAPS = 16

    def __init__(self, spark, folder, key_type, key, ts, seq, gap, delay, extra: dict[str, T.DataType], bucket, target_rows):
        super().__init__(spark, folder, delay)
        self.key, self.ts, self.seq, self.gap_us, self.extra = key, ts, seq, duration_us(gap), extra
        self.key_type, self.bucket, self.target_rows = key_type, bucket, target_rows
        self.ids = self.id_columns()
        self.log = self.table("log", self.state_schema(), key)
        self.said = self.table("said", self.result_schema(), key, self.ids)
        self.open = lambda v: f"{self.folder}/open/version={v}"

    def state_schema(self) -> T.StructType:
        return T.StructType([T.StructField(self.key, self.key_type), T.StructField(_US, T.LongType()), T.StructField(_SEQ, T.LongType()),
                             *[T.StructField(c, t) for c, t in self.extra.items()]])

    def result_schema(self) -> T.StructType:
        none = self.spark.createDataFrame([], self.state_schema())
        return T.StructType([T.StructField(f.name, f.dataType) for f in self.sessions(none).schema.fields])

    def out_schema(self) -> T.StructType:
        return T.StructType([*self.said.schema.fields, T.StructField("retracted", T.BooleanType())])

    def prepared(self, batch: DataFrame) -> DataFrame:
        return batch.select(self.key, epoch_us(self.ts).alias(_US), F.col(self.seq).cast("long").alias(_SEQ), *self.extra).filter(F.col(_US).isNotNull())

    def timed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("__ts", from_epoch_us(_US))

    def handle(self, rows: DataFrame, version: int, watermark_us: int | None) -> None:
        key, gap = self.key, self.gap_us
        touched = self.log.touched(rows)
        columns = self.said.schema.names
        empty = self.spark.createDataFrame([], self.said.schema)
        waiting = self.spark.read.schema(self.said.schema).parquet(self.open(version - 1)) if version else empty

        # 1. Stretches of time per key: the new rows' own and the known sessions'. Those within the gap of each other
        #    merge; the ones with a new row in them are worked out anew. A session's end lies at or after its last row,
        #    so a stretch covers whole islands of rows.
        near = F.floor(F.col(_US) / F.lit(max(1, gap)))
        spans = rows.groupBy(key, near.alias("__b")).agg(F.min(_US).alias("a"), F.max(_US).alias("b"))
        known = self.said.read(version, touched).withColumn("said", F.lit(True)).unionByName(waiting.withColumn("said", F.lit(False)))
        known = known.select(F.struct(key).alias("__key"), epoch_us("session_start").alias("a"), epoch_us("session_end").alias("b"),
                             "said", F.struct(*columns).alias("was")).persist()
        parts = spans.select(F.struct(key).alias("__key"), "a", "b", F.lit(True).alias("new")).unionByName(
            known.select("__key", "a", "b", F.lit(False).alias("new")))
        parts = parts.groupBy("__key", "a").agg(F.max("b").alias("b"), F.max("new").alias("new"))
        cut = resolve_bucket(parts, ["__key"], F.col("a"), self.bucket, self.target_rows)
        parts = ordered_scan(parts, ["__key"], ["a"], {"reach": ("max_before", "b")}, cut)
        starts = F.col("reach").isNull() | (F.col("a") - F.col("reach") > F.lit(gap))
        parts = ordered_scan(parts, ["__key"], ["a"], {"lo": ("max", F.when(starts, F.col("a")))}, cut).select("__key", "a", "b", "lo", "new")
        stretches = parts.groupBy("__key", "lo").agg(F.max("b").alias("hi"), F.max("new").alias("anew"), F.collect_set("a").alias("starts"))
        stretches = stretches.filter("anew").persist()

        # 2. The rows of those stretches, from the log by (key, cell of time), and the sessions they make.
        cell = lambda c: F.floor(F.col(c) / F.lit(self.CELL_GAPS * max(1, gap)))
        asked = stretches.select("__key", "lo", "hi", F.explode(F.sequence(cell("lo"), cell("hi"))).alias("__cell"))
        reach = stretches.agg(F.min("lo"), F.max("hi")).first()
        logged = self.log.read(version, touched).filter(F.col(_US).between(*(reach if reach[0] is not None else (0, -1))))
        logged = logged.withColumn("__key", F.struct(key)).withColumn("__cell", cell(_US))
        logged = logged.join(asked, ["__key", "__cell"]).filter((F.col(_US) >= F.col("lo")) & (F.col(_US) <= F.col("hi"))).select(*rows.columns)
        fresh = self.sessions(rows.unionByName(logged)).select(*columns)

        # 3. Against what is known of those stretches; sessions that wait elsewhere stay as they are.
        anew = stretches.select("__key", F.explode("starts").alias("a"), F.lit(True).alias("anew"))
        old = known.join(anew, ["__key", "a"], "left").select(
            F.struct(*[F.col(f"was.{c}") for c in self.ids]).alias("__id"), "said", "was", F.coalesce("anew", F.lit(False)).alias("anew"))
        now = fresh.select(F.struct(*self.ids).alias("__id"), F.struct(*columns).alias("is"))
        both = now.join(old.filter("anew").drop("anew"), "__id", "full").select("is", "was", "said").unionByName(
            old.filter("not anew and not said").select(F.col("was").alias("is"), "was", "said"))
        both = both.withColumn("said", F.coalesce("said", F.lit(False))).withColumn(
            "due", F.col("is").isNotNull() & F.coalesce(self.due("is", watermark_us), F.lit(False))).persist()
        changed = F.col("due") & (~F.col("said") | ~F.col("is").eqNullSafe(F.col("was")))
        gone = F.col("said") & ~F.col("due")  # it no longer exists, or is open again
        say = both.filter(changed | gone).select(F.when(gone, F.col("was")).otherwise(F.col("is")).alias("row"), gone.alias("retracted"))
        say = say.select("row.*", "retracted")
        self._emit(say, version)
        self.said.write(say.withColumnRenamed("retracted", GONE), version)
        both.filter("is is not null and not due").select("is.*").write.mode("overwrite").parquet(self.open(version))
        self.log.write(rows, version, self.spread)
        for frame in (both, stretches, known):
            frame.unpersist()

    def latest(self) -> DataFrame:
        return latest(self.output(), self.ids)


class TerminatedSessionStream(_SessionStream):
    """J8 that fires at once: a segment closed by a terminator is put out by the batch that brings the terminator,
    any other once the watermark has passed its timeout. A row that changes a segment later, within
    the delay or beyond it, gives a revision. Output: the columns of ``terminated_sessions``, retracted, revision.
    """

    def __init__(self, spark, folder, key_type: T.DataType, key="user_id", ts="ts", seq="seq", event_type="event_type", gap=TERMINATED_GAP,
                 terminators=TERMINATORS, delay="5 seconds", bucket="auto", target_rows: int | None = None):
        self.event_type, self.terminators = event_type, tuple(terminators)
        super().__init__(spark, folder, key_type, key, ts, seq, gap, delay, {event_type: T.StringType()}, bucket, target_rows)

    def id_columns(self) -> list[str]:
        return [self.key, "session_start", "segment"]

    def sessions(self, rows: DataFrame) -> DataFrame:
        return terminated_sessions(self.timed(rows), self.key, "__ts", _SEQ, self.event_type, dt.timedelta(microseconds=self.gap_us), self.terminators, self.bucket, self.target_rows)

    def due(self, row: str, watermark_us: int | None) -> Column:
        if watermark_us is None:
            return F.col(f"{row}.closed_by") == "terminator"
        return (F.col(f"{row}.closed_by") == "terminator") | (epoch_us(F.col(f"{row}.session_end")) < F.lit(watermark_us))


class CappedSessionStream(_SessionStream):
    """J5 with every row kept; sessions close in event time, as their deadlines pass the watermark.
    A row behind the watermark revises the sessions it falls into. Output: the columns of
    ``capped_sessions(mode="event_time")``, retracted, revision.
    """

    def __init__(self, spark, folder, key_type: T.DataType, key="user_id", ts="ts", seq="seq", gap=CAPPED_GAP, max_len=CAPPED_MAX,
                 delay="0 seconds", bucket="auto", target_rows: int | None = None):
        self.max_us = duration_us(max_len)
        super().__init__(spark, folder, key_type, key, ts, seq, gap, delay, {}, bucket, target_rows)

    def id_columns(self) -> list[str]:
        return [self.key, "session_start"]

    def sessions(self, rows: DataFrame) -> DataFrame:
        return capped_sessions(self.timed(rows), self.key, "__ts", _SEQ, dt.timedelta(microseconds=self.gap_us), dt.timedelta(microseconds=self.max_us), "event_time", self.bucket, self.target_rows)

    def due(self, row: str, watermark_us: int | None) -> Column:
        if watermark_us is None:
            return F.lit(False)
        end = epoch_us(F.col(f"{row}.session_end"))
        # Inactivity closes at its deadline, the cap once it has passed.
        return F.when(F.col(f"{row}.reason") == "Max", end < F.lit(watermark_us)).otherwise(end <= F.lit(watermark_us))


class GapSessionStream(_SessionStream):
    """J9 with every row kept: a session is put out once the watermark has passed its end, and revised by later rows.
    Output: the columns of ``gap_sessions``, retracted, revision.
    """

    def __init__(self, spark, folder, key_type: T.DataType, key="user_id", ts="ts", seq="seq", gap=TERMINATED_GAP, delay="5 seconds",
                 bucket="auto", target_rows: int | None = None):
        super().__init__(spark, folder, key_type, key, ts, seq, gap, delay, {}, bucket, target_rows)

    def id_columns(self) -> list[str]:
        return [self.key, "session_start"]

    def sessions(self, rows: DataFrame) -> DataFrame:
        return gap_sessions(self.timed(rows), self.key, "__ts", _SEQ, dt.timedelta(microseconds=self.gap_us))

    def due(self, row: str, watermark_us: int | None) -> Column:
        return F.lit(False) if watermark_us is None else epoch_us(F.col(f"{row}.session_end")) < F.lit(watermark_us)


class InactivityAlertStream(_SessionStream):
    """J3 in event time with every row kept. A silence follows each run of rows less than ``threshold`` apart; its
    alert is put out once the watermark has reached its time, retracted if a late row fills the silence, and revised
    if one prolongs the run. Output: key, session_start and session_end (the run's first time and its
    alert's), last_seen, alert_time, idle_seconds, retracted, revision.
    """

    def __init__(self, spark, folder, key_type: T.DataType, key="sensor_id", ts="ts", seq="seq", threshold=DEFAULT_THRESHOLD, delay="5 seconds",
                 bucket="auto", target_rows: int | None = None):
        super().__init__(spark, folder, key_type, key, ts, seq, threshold, delay, {}, bucket, target_rows)

    def id_columns(self) -> list[str]:
        return [self.key, "session_start"]

    def sessions(self, rows: DataFrame) -> DataFrame:
        thr = self.gap_us
        runs = session_summary(rows, [self.key], _US, thr, True, thr).groupBy("__ck_key", "session_start_us").agg(F.max("__last").alias("last"))
        alert = from_epoch_us(F.col("last") + F.lit(thr))
        return runs.select(
            F.col(f"__ck_key.{self.key}").alias(self.key), from_epoch_us("session_start_us").alias("session_start"), alert.alias("session_end"),
            from_epoch_us("last").alias("last_seen"), alert.alias("alert_time"), F.lit(thr // 1_000_000).cast("long").alias("idle_seconds"))

    def due(self, row: str, watermark_us: int | None) -> Column:
        return F.lit(False) if watermark_us is None else epoch_us(F.col(f"{row}.alert_time")) <= F.lit(watermark_us)
