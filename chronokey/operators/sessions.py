"""Session operators: plain gap sessions (J9), sessions cut by terminating
events (J8) and sessions with a maximum length and a close reason (J5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronokey.functions.time import duration_us, epoch_us, from_epoch_us
from chronokey.operators._common import as_list, order_value, sorted_by
from chronokey.plans.arrival_chain import arrival_sessions
from chronokey.plans.chain import chain_starts
from chronokey.plans.scan import key_stats, ordered_scan, resolve_bucket, resolve_width, session_summary, sessionize, target_rows_for

# ---- fixed values: defaults of the original session jobs ----
TERMINATORS = ("LOGOUT", "CHECKOUT_COMPLETE")
TERMINATED_GAP = "15 minutes"
CAPPED_GAP = "5 seconds"
CAPPED_MAX = "7 seconds"
# ---- end of fixed values ----

_US = "__ts_us"


def _prepare(df: DataFrame, key: str, ts: str, seq: str, cols: list[str], bucket, target_rows: int, stats=None):
    """Project the needed columns; resolve the bucket width (None = plain windows)."""
    d = df.select(key, seq, *cols, epoch_us(ts).alias(_US)).filter(F.col(_US).isNotNull())
    return d, resolve_width(d, [key], F.col(_US), bucket, target_rows, stats=stats)


def _key_cols(key: str) -> Column:
    return F.col(f"__ck_key.{key}").alias(key)


def gap_sessions(
    df: DataFrame,
    key: str = "user_id",
    ts: str = "ts",
    seq: str = "seq",
    gap=TERMINATED_GAP,
    bucket="auto",
    target_rows: int | None = None,
) -> DataFrame:
    """Event-time session windows: a row joins the session if it is at most
    ``gap`` after the previous row (two rows exactly ``gap`` apart merge, like
    ``session_window``). Output: key, session_start, session_end (last + gap), n.

    Aggregate-only: rows are partially aggregated per ``(key, floor(ts/gap))``
    on the map side, sessions are found over those bucket rows (at most
    span/gap per key, however hot the key) and summed. No raw row is
    shuffled. ``bucket=None`` uses plain windows over the key instead (for
    comparison); an int narrows the buckets.
    """
    gap_us = duration_us(gap)
    d = df.select(key, seq, epoch_us(ts).alias(_US)).filter(F.col(_US).isNotNull())
    if bucket is None:
        d = sessionize(d, [key], _US, seq, gap_us, inclusive_break=False)
        agg = d.groupBy(key, "session_start_us").agg(F.count(F.lit(1)).alias("n"), F.max(_US).alias("__last"))
    else:
        width = min(bucket, gap_us) if isinstance(bucket, int) else gap_us
        agg = (
            session_summary(d, [key], _US, gap_us, False, width)
            .groupBy("__ck_key", "session_start_us")
            .agg(F.sum("__n").alias("n"), F.max("__last").alias("__last"))
            .select(_key_cols(key), "session_start_us", "n", "__last")
        )
    return agg.select(
        key,
        from_epoch_us("session_start_us").alias("session_start"),
        from_epoch_us(F.col("__last") + F.lit(gap_us)).alias("session_end"),
        "n",
    )


def terminated_sessions(
    df: DataFrame,
    key: str = "user_id",
    ts: str = "ts",
    seq: str = "seq",
    event_type: str = "event_type",
    gap=TERMINATED_GAP,
    terminators=TERMINATORS,
    bucket="auto",
    target_rows: int | None = None,
    lists: bool = True,
) -> DataFrame:
    """Gap sessions that also emit immediately at a terminating event.

    A terminator closes the current *segment* (it is included) but not the
    session: later rows within ``gap`` form the next segment of the same
    session, reported with the session's original start. Nothing is emitted
    for a session that ends right after a terminator.

    Output: key, session_start, session_end, segment (0-based in the session),
    event_types (in (ts, seq) order), closed_by ('terminator' | 'timeout').
    ``session_end`` is the segment's last time + gap: for a terminator segment
    the window end at the moment it fires, for the last segment the session's
    timeout. ``lists=False`` returns the number of events ``n`` instead of
    the list (a segment of a busy key can be arbitrarily long).
    """
    gap_us = duration_us(gap)
    d, width = _prepare(df, key, ts, seq, [event_type], bucket, target_rows)
    is_term = F.col(event_type).isin(*terminators)
    term = F.coalesce(is_term, F.lit(False)).cast("long")
    d = sessionize(
        d,
        [key],
        _US,
        seq,
        gap_us,
        inclusive_break=False,
        width_us=width,
        extra={"__terms_before": ("sum_before", term)},
        sums={"__terms_at_start": term},
    )
    # Rows with the same count of earlier terminators inside a session form
    # one segment; its number is that count less the count before the session,
    # which comes with the session's start.
    d = d.withColumn("segment", F.col("__terms_before") - F.col("__terms_at_start"))
    d = d.withColumn("__session", F.struct(key, "session_start_us"))
    return (
        d.groupBy("__session", "segment")
        .agg(
            F.max(_US).alias("__last"),
            F.max_by(is_term, F.struct(F.col(_US), F.col(seq))).alias("__closed"),
            (sorted_by(F.col(event_type), F.col(_US), F.col(seq)) if lists else F.count(F.lit(1))).alias(
                "event_types" if lists else "n"
            ),
        )
        .select(
            F.col(f"__session.{key}").alias(key),
            from_epoch_us("__session.session_start_us").alias("session_start"),
            from_epoch_us(F.col("__last") + F.lit(gap_us)).alias("session_end"),
            "segment",
            "event_types" if lists else "n",
            F.when(F.col("__closed"), F.lit("terminator")).otherwise(F.lit("timeout")).alias("closed_by"),
        )
    )


def terminated_session_rows(
    df: DataFrame,
    key: str = "user_id",
    ts: str = "ts",
    seq: str = "seq",
    event_type: str = "event_type",
    gap=TERMINATED_GAP,
    terminators=TERMINATORS,
    bucket="auto",
    target_rows: int | None = None,
) -> DataFrame:
    """The contents of :func:`terminated_sessions` as labelled rows.

    One row for each row with a time: key, seq, ts, event_type, session_start, segment (0-based in
    the session), position (0-based in the segment, in (ts, seq) order). The labels are running
    columns of the bucketed scan, so a session without end, or a segment of any number of rows, is
    spread over tasks like any other rows; no list of a segment's rows is ever built.
    """
    gap_us = duration_us(gap)
    d, width = _prepare(df, key, ts, seq, [event_type], bucket, target_rows)
    one = F.lit(1).cast("long")
    term = F.coalesce(F.col(event_type).isin(*terminators), F.lit(False))
    d = sessionize(
        d,
        [key],
        _US,
        seq,
        gap_us,
        inclusive_break=False,
        width_us=width,
        extra={"__terms_before": ("sum_before", term.cast("long")), "__rows_before": ("sum_before", one)},
        sums={"__terms_at_start": term.cast("long"), "__rows_at_start": one},
    )
    # A segment starts with its session or after the latest terminator, whichever is later.
    b = None if width is None else F.col("__ck_bucket")
    d = ordered_scan(d, [key], [_US, seq], {"__after": ("max_before", F.when(term, F.col("__rows_before") + one))}, b)
    return d.select(
        key,
        seq,
        from_epoch_us(_US).alias("ts"),
        event_type,
        from_epoch_us("session_start_us").alias("session_start"),
        (F.col("__terms_before") - F.col("__terms_at_start")).alias("segment"),
        (F.col("__rows_before") - F.greatest("__rows_at_start", "__after")).alias("position"),
    )


def capped_sessions(
    df: DataFrame,
    key: str = "user_id",
    ts: str = "ts",
    seq: str = "seq",
    gap=CAPPED_GAP,
    max_len=CAPPED_MAX,
    mode: str = "arrival",
    bucket="auto",
    target_rows: int | None = None,
    fold_limit: int | None = None,
    lists: bool = True,
    order: str = "time",
) -> DataFrame:
    """Sessions closed by inactivity (``ts >= last + gap``) or by length
    (``ts > start + max_len``), with the reason.

    Taken per key in ``(ts, seq)`` order. ``end`` is ``start + max_len`` for
    "Max" and ``last + gap`` for "Inactivity". ``mode="arrival"``: the row that
    breaks the session decides the reason; the last session of a key closes
    at the earlier deadline (tie: Inactivity). ``mode="event_time"``: every
    session closes at its earlier deadline, as event-time timers would fire.
    Membership is the same in both modes.

    ``order="arrival"`` takes the rows of a key as they arrived (``seq``, a column or a list) in place
    of ``(ts, seq)`` order, as the original process function does: the start is the first *arrived* time, the
    inactivity deadline follows the last arrived row, also backwards, and the gap and the cap are judged against
    those. ``session_end`` is still ``start + max_len`` or the largest time + gap. It has ``mode="arrival"`` only.

    Output: key, session_start, session_end, n, timestamps (sorted), reason.
    ``lists=False`` leaves out ``timestamps`` (a session of a busy key can
    hold up to ``max_len`` worth of rows).
    """
    if mode not in ("arrival", "event_time"):
        raise ValueError("mode must be 'arrival' or 'event_time'")
    gap_us, max_us = duration_us(gap), duration_us(max_len)
    if order == "arrival":
        if mode != "arrival":
            raise ValueError("order='arrival' has mode 'arrival' only")
        by = as_list(seq)
        d = df.select(*dict.fromkeys([key, *by]), epoch_us(ts).alias(_US)).filter(F.col(_US).isNotNull())
        b = resolve_bucket(d, [key], order_value(d, by[0]), bucket, target_rows)
        return _close_arrival(arrival_sessions(d, key, _US, by, gap_us, max_us, b, fold_limit, lists), key, gap_us, max_us, lists)
    # One stats job sizes the buckets and bounds the largest island (an
    # island never has more rows than its key).
    stats = key_stats(df.select(key, epoch_us(ts).alias(_US)), [key], F.col(_US), target_rows_for(df, target_rows))
    d, width = _prepare(df, key, ts, seq, [], bucket, target_rows, stats)
    # Islands: the gap test only looks at the previous row, so cap splits
    # never change them. next_us feeds the arrival-mode reason.
    d = sessionize(
        d, [key], _US, seq, gap_us, inclusive_break=True, width_us=width, extra={"next_us": ("next", F.col(_US))}
    ).withColumnRenamed("session_start_us", "island_us")
    b = None if width is None else F.floor(F.col(_US) / F.lit(min(width, gap_us))).cast("long")
    sessions = chain_starts(
        d, key, _US, seq, "island_us", max_us, bucket=b, fold_limit=fold_limit,
        max_island_rows=stats["n"] if stats else 0, lists=lists,
        max_steps=stats["span"] // max_us + 1 if stats else None,
    )
    return _close(sessions, key, gap_us, max_us, mode, lists)


def _close_arrival(s: DataFrame, key: str, gap_us: int, max_us: int, lists: bool) -> DataFrame:
    """Sessions in arrival order -> typed output. The last one closes at the earlier deadline (tie: Inactivity)."""
    start = F.col("start_us")
    inactivity = F.when(F.col("close") == "end", F.col("last_us") + F.lit(gap_us) <= start + F.lit(max_us)).otherwise(F.col("close") == "gap")
    return s.select(
        key,
        from_epoch_us(start).alias("session_start"),
        from_epoch_us(F.when(inactivity, F.col("max_us") + F.lit(gap_us)).otherwise(start + F.lit(max_us))).alias("session_end"),
        "n",
        *([F.transform("ts_list", lambda x: from_epoch_us(x)).alias("timestamps")] if lists else []),
        F.when(inactivity, F.lit("Inactivity")).otherwise(F.lit("Max")).alias("reason"),
    )


def _close(s: DataFrame, key: str, gap_us: int, max_us: int, mode: str, lists: bool = True) -> DataFrame:
    """sessions(key, start_us, last_us, n, ts_list, next_us) -> typed output."""
    start, last, nxt = F.col("start_us"), F.col("last_us"), F.col("next_us")
    by_deadline = last + F.lit(gap_us) <= start + F.lit(max_us)
    if mode == "event_time":
        inactivity: Column = by_deadline
    else:
        inactivity = F.when(nxt.isNull(), by_deadline).otherwise(nxt - last >= F.lit(gap_us))
    end = F.when(inactivity, last + F.lit(gap_us)).otherwise(start + F.lit(max_us))
    return s.select(
        key,
        from_epoch_us(start).alias("session_start"),
        from_epoch_us(end).alias("session_end"),
        "n",
        *([F.transform("ts_list", lambda x: from_epoch_us(x)).alias("timestamps")] if lists else []),
        F.when(inactivity, F.lit("Inactivity")).otherwise(F.lit("Max")).alias("reason"),
    )
