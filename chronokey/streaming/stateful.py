"""Per-key state functions for ``groupBy(key).applyInPandasWithState``.

Each operator whose emission rule is not a built-in streaming aggregate is a
fold over a key's rows with one state row and one timeout:

* the state row travels with the data (no round trip per state access);
* the timeout is an event-time timeout at the earliest deadline of the key
  (window end, session end), or a processing-time timeout for live alerts.

Rows of a key inside one micro-batch come in no fixed order, so every
function sorts them first (by arrival order or by ``(ts, seq)``). The rules that
depend on event-time order (silences, sessions) hold rows at or above the
watermark in the state and fold them once it has passed them: Spark accepts no
row below it any more, so the result does not depend on how rows within the
delay were cut into batches. Times are epoch microseconds; timeouts are epoch
milliseconds and fire once the watermark passes them.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor

# Ship these functions inside the pickled task: executors need no install of
# this package (nothing else of it runs in Python workers).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _rows(pdfs, order: list[str]) -> pd.DataFrame:
    frames = [p for p in pdfs if len(p)]
    if not frames:
        return pd.DataFrame(columns=order)
    df = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
    return df.sort_values(order, kind="stable")


def _ceil_ms(us: int) -> int:
    return -(-us // 1000)


def _arm(state, deadline_us: int, strictly_after: bool = False) -> None:
    """Time out once the watermark reaches ``deadline_us`` (or passes it, if
    ``strictly_after``). A timeout fires when the watermark is above the
    value set, so the value is the first firing watermark (ms) minus one."""
    fire_ms = deadline_us // 1000 + 1 if strictly_after else _ceil_ms(deadline_us)
    state.setTimeoutTimestamp(max(fire_ms - 1, state.getCurrentWatermarkMs() + 1))


def _settle(pdfs, state, held: list, columns: list[str]):
    """Add a call's rows to the held columns (time, seq, ...); split them at the watermark.

    Returns (settled, held) as lists of arrays in (time, seq) order, and the
    watermark. Rows below the watermark are settled: none can come before them."""
    wm_us = state.getCurrentWatermarkMs() * 1000
    new = pd.DataFrame(columns=columns) if state.hasTimedOut else _rows(pdfs, columns[:2])
    cols = [np.concatenate([np.asarray(h, dtype=object), new[c].to_numpy(dtype=object)]) for h, c in zip(held, columns)]
    us, seq = cols[0].astype("int64"), cols[1].astype("int64")
    cols = [us, seq, *cols[2:]]
    order = np.lexsort((seq, us))
    cols = [c[order] for c in cols]
    cut = int(np.searchsorted(cols[0], wm_us, side="left"))
    return [c[:cut] for c in cols], [c[cut:] for c in cols], wm_us


def _arm_first(state, held_us, *deadlines) -> None:
    """Time out at the first of: the first held row settles, (time, strictly_after) deadlines."""
    if len(held_us):
        deadlines = (*deadlines, (int(held_us[0]), True))
    _arm(state, *min(deadlines, key=lambda d: (d[0], d[1])))


def _out(records: list[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    if records:
        yield pd.DataFrame.from_records(records, columns=columns)


EARLY_COLUMNS = ["key", "window_start_us", "first", "last", "pane"]
EARLY_STATE = "keys array<{}>, counts array<long>"
#: Counts that a row of the output stands for at most, so that none grows with a hot key.
EARLY_SPAN = 10_000


def early_count_fn(width_us: int, n: int, include_final: bool, once: bool):
    """Grouped by a bucket of keys and window start: the state row holds the
    window's count of each key of the bucket, so a call is made for thousands of rows.
    From the n-th row on every row of a key fires an ``early`` pane, put out as runs of counts
    (first, last); the timeout at the window end emits the ``final`` panes. Rows of a
    window only need counting, so their order inside a batch plays no part. The
    null key has a bucket (-1) of its own, so other keys' columns have no nulls."""

    def out(keys, ws, first, last, pane):
        first, last = np.asarray(first, dtype="int64"), np.asarray(last, dtype="int64")
        pieces = np.maximum(-(-(last - first + 1) // EARLY_SPAN), 0)
        if not pieces.sum():
            return
        row = np.repeat(np.arange(len(pieces)), pieces)
        first = first[row] + EARLY_SPAN * (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        yield pd.DataFrame({"key": keys[row], "window_start_us": ws, "first": first, "last": np.minimum(last[row], first + EARLY_SPAN - 1), "pane": pane})

    def fn(key, pdfs, state):
        bucket, ws = int(key[0]), int(key[1])
        keys, before = state.get if state.exists else ([], [])
        if state.hasTimedOut:
            state.remove()
            if include_final:
                yield from out(pd.Series(keys, dtype=object if bucket < 0 else None).to_numpy(), ws, before, before, "final")
            return
        known = len(keys)
        if bucket < 0:
            keys, count = np.array([None], dtype=object), np.array([sum(before) + sum(len(p) for p in pdfs)], dtype="int64")
        else:
            held = pd.Series(before, index=keys, dtype="int64") if known else None
            # Keys of the state come first and in its order.
            parts = [p.groupby("__key", sort=False).size() for p in pdfs if len(p)]
            total = pd.concat([held, *parts] if known else parts).groupby(level=0, sort=False).sum()
            keys, count = total.index.to_numpy(), total.to_numpy(dtype="int64")
        before = np.concatenate([np.asarray(before, dtype="int64"), np.zeros(len(keys) - known, dtype="int64")])
        state.update((keys.tolist(), count.tolist()))
        _arm(state, ws + width_us)
        yield from out(keys, ws, np.maximum(before + 1, n), np.minimum(count, n) if once else count, "early")

    return fn


MEAN_COLUMNS = ["key", "window_start_us", "window_end_us", "n", "mean"]
MEAN_STATE = "end_us long, total double, n long, values long"


def _mean_fold(ts, values, end, total, cnt, vals, width_us):
    """Arrival-order window rule; returns closed windows (end, n, mean) and the open one.

    The window end of each row is the running maximum of the natural window
    ends, starting from the open window's end; each change of it closes a
    window. ``n`` counts rows; the mean is over the values that are not null
    (null if there are none), as ``avg`` does."""
    ts = np.asarray(ts, dtype="int64")
    if not len(ts):
        return [], end, total, cnt, vals
    values = np.asarray(values, dtype="float64")
    known = (~np.isnan(values)).astype("int64")
    values = np.nan_to_num(values)
    natural = ts - np.mod(ts, width_us) + width_us
    if end is not None:
        natural = np.concatenate([[end], natural])
        values = np.concatenate([[total], values])
        known = np.concatenate([[vals], known])
        counts = np.concatenate([[cnt], np.ones(len(ts), dtype="int64")])
    else:
        counts = np.ones(len(ts), dtype="int64")
    ends = np.maximum.accumulate(natural)
    bounds = np.flatnonzero(np.diff(ends)) + 1
    starts = np.concatenate([[0], bounds])
    groups = [(int(e), int(n), float(v), int(k)) for e, n, v, k in zip(
        ends[starts], np.add.reduceat(counts, starts), np.add.reduceat(values, starts), np.add.reduceat(known, starts))]
    closed = [(e, n, v / k if k else None) for e, n, v, k in groups[:-1]]
    e, n, v, k = groups[-1]
    return closed, e, v, n, k


def _alert_fold(ts_sorted, last, threshold_us):
    """Silences of at least ``threshold`` between rows, (last, next), and the latest time."""
    ts = np.asarray(ts_sorted, dtype="int64")
    if not len(ts):
        return [], last
    prev = np.concatenate([[ts[0] if last is None else last], ts[:-1]])
    if last is not None:
        prev = np.maximum.accumulate(prev)
    hit = ts - prev >= threshold_us
    return list(zip(prev[hit].tolist(), ts[hit].tolist())), int(ts[-1]) if last is None else max(last, int(ts[-1]))


def arrival_mean_fn(width_us: int, order: list[str]):
    """Add a row to the open window while its time is before the window end,
    else emit the open window and open the row's own; the timeout at the
    window end emits it."""

    def fn(key, pdfs, state):
        if state.hasTimedOut:
            end, total, cnt, vals = state.get
            state.remove()
            yield from _out([(key[0], end - width_us, end, cnt, total / vals if vals else None)], MEAN_COLUMNS)
            return
        end, total, cnt, vals = state.get if state.exists else (None, 0.0, 0, 0)
        rows = _rows(pdfs, order)
        closed, end, total, cnt, vals = _mean_fold(rows["__us"].tolist(), rows["__value"].tolist(), end, total, cnt, vals, width_us)
        state.update((end, total, cnt, vals))
        _arm(state, end)
        yield from _out([(key[0], e - width_us, e, c, m) for e, c, m in closed], MEAN_COLUMNS)

    return fn


ALERT_COLUMNS = ["key", "last_seen_us", "alert_time_us", "idle_seconds", "next_seen_us"]
ALERT_STATE = "last_us long, said boolean, held_us array<long>, held_seq array<long>"


def _alerts_out(records: list[tuple]) -> Iterator[pd.DataFrame]:
    for frame in _out(records, ALERT_COLUMNS):
        # Times stay whole numbers beside a null one, where pandas would make doubles.
        yield frame.assign(next_seen_us=pd.array([r[4] for r in records], dtype="Int64"))


def inactivity_fn(threshold_us: int, domain: str = "event", revise: bool = False):
    """``domain="event"``: silence in event time, over settled rows; the
    timeout at last + threshold raises the alert. What ends the silence may not be
    known then (rows within the delay may still come before a row that is
    held): such an alert's ``next_seen`` is null. With ``revise`` the key's last
    time stays in the state, and the alert goes out once more, with
    ``next_seen``, when the row that ends its silence has settled.
    ``domain="processing"``: wall-clock timeout re-armed by every batch with
    rows (live monitor)."""
    idle_s = threshold_us // 1_000_000

    def live(key, pdfs, state):
        if state.hasTimedOut:
            last = state.get[0]
            state.remove()
            yield from _alerts_out([(key[0], last, state.getCurrentProcessingTimeMs() * 1000, idle_s, None)])
            return
        ts = _rows(pdfs, ["__us", "__seq"])["__us"].to_numpy(dtype="int64")
        last = int(max(ts.max(), state.get[0] if state.exists else ts.max()))
        state.update((last, False, [], []))
        state.setTimeoutDuration(threshold_us // 1000)

    def fn(key, pdfs, state):
        last, said, *held = state.get if state.exists else (None, False, [], [])
        settled, held, wm_us = _settle(pdfs, state, held, ["__us", "__seq"])
        alerts, last = _alert_fold(settled[0], last, threshold_us)
        said = said and not len(settled[0])
        out = [(key[0], a, a + threshold_us, idle_s, b) for a, b in alerts]
        if last is not None and not said and last + threshold_us <= wm_us:
            out.append((key[0], last, last + threshold_us, idle_s, None))
            last, said = (last, True) if revise else (None, False)
        if last is None and not len(held[0]):
            state.remove()
        else:
            state.update((last, said, held[0].tolist(), held[1].tolist()))
            if len(held[0]) or not said:
                _arm_first(state, held[0], *([(last + threshold_us, False)] if last is not None and not said else []))
        yield from _alerts_out(out)

    return fn if domain == "event" else live


class IdleTimer(StatefulProcessor):
    """Wall-clock silence with a processing-time timer per key: every call with rows deletes the key's timer and
    registers a new one; a timer that fires raises the alert and clears the key. For ``transformWithState`` with
    ``timeMode="ProcessingTime"``, which unlike the function above can stand beside another stateful operator."""

    def __init__(self, threshold_us: int):
        self.threshold_us = threshold_us

    def init(self, handle) -> None:
        self.handle = handle
        self.state = handle.getValueState("idle", "last_us long, timer_ms long")

    def handleInputRows(self, key, rows, timerValues):
        last = max(r["__us"] for r in rows)
        if self.state.exists():
            before, timer = self.state.get()
            self.handle.deleteTimer(timer)
            last = max(last, before)
        timer = timerValues.getCurrentProcessingTimeInMs() + self.threshold_us // 1000
        self.handle.registerTimer(timer)
        self.state.update((last, timer))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last, _ = self.state.get()
        self.state.clear()
        yield Row(key=key[0], last_seen_us=last, alert_time_us=timerValues.getCurrentProcessingTimeInMs() * 1000,
                  idle_seconds=self.threshold_us // 1_000_000)

    def close(self) -> None:
        pass


MONITOR_COLUMNS = ["key", "kind", "at_us", "value", "n"]
MONITOR_STATE = "end_us long, total double, n long, values long, last_us long, held_us array<long>, held_seq array<long>"


def sensor_monitor_fn(width_us: int, threshold_us: int, order: list[str]):
    """Both outputs of the sensor job from one state row per key: the
    arrival-order window (as :func:`arrival_mean_fn`) and the event-time
    silence (as :func:`inactivity_fn`). One timeout at the earliest deadline;
    when it fires, every deadline the watermark has reached is handled."""

    def fn(key, pdfs, state):
        end, total, cnt, vals, last, *held = state.get if state.exists else (None, 0.0, 0, 0, None, [], [])
        frames = [] if state.hasTimedOut else list(pdfs)
        out = []
        settled, held, wm_us = _settle(frames, state, held, ["__us", "__seq"])
        if state.hasTimedOut:
            if end is not None and end <= wm_us:
                out.append((key[0], "mean", end, total / vals if vals else None, cnt))
                end, total, cnt, vals = None, 0.0, 0, 0
        else:
            rows = _rows(frames, order)
            closed, end, total, cnt, vals = _mean_fold(rows["__us"].tolist(), rows["__value"].tolist(), end, total, cnt, vals, width_us)
            out += [(key[0], "mean", e, m, c) for e, c, m in closed]
        alerts, last = _alert_fold(settled[0], last, threshold_us)
        out += [(key[0], "alert", a + threshold_us, None, None) for a, _ in alerts]
        if last is not None and last + threshold_us <= wm_us:
            out.append((key[0], "alert", last + threshold_us, None, None))
            last = None
        if end is None and last is None and not len(held[0]):
            state.remove()
        else:
            state.update((end, total, cnt, vals, last, held[0].tolist(), held[1].tolist()))
            _arm_first(state, held[0], *([(end, False)] if end is not None else []),
                       *([(last + threshold_us, False)] if last is not None else []))
        yield from _out(out, MONITOR_COLUMNS)

    return fn


TERMINATED_COLUMNS = ["key", "session_start_us", "session_end_us", "segment", "event_types", "n", "closed_by"]
TERMINATED_STATE = ("start_us long, last_us long, segment long, n long, types array<string>, "
                    "held_us array<long>, held_seq array<long>, held_type array<string>")


def terminated_session_fn(gap_us: int, terminators, lists: bool = True):
    """Gap sessions with a segment per terminating event, over settled rows.
    The state row holds the session bounds, the segment number and the open
    segment (its event types, or with ``lists=False`` only their number). A
    terminator emits the segment (itself included) without ending the session; a
    gap larger than ``gap`` or the timeout at ``last + gap`` ends the session
    and emits a non-empty open segment."""
    terms = list(terminators)

    def fn(key, pdfs, state):
        start, last, seg, n, types, *held = state.get if state.exists else (None, None, 0, 0, [], [], [], [])
        (us, _, typ), held, wm_us = _settle(pdfs, state, held, ["__us", "__seq", "__type"])
        types, out = list(types), []

        def emit(closed_by: str, end: int) -> None:
            out.append((key[0], start, end + gap_us, seg, types if lists else None, n, closed_by))

        if len(us):
            ends = np.isin(typ.astype(str), terms) & (typ != None)  # noqa: E711
            gap = np.diff(us, prepend=us[0] if last is None else last) > gap_us
            # Rows between cuts belong to one segment: after a terminator, and before a gap.
            cuts = np.flatnonzero(gap | np.concatenate([[False], ends[:-1]]))
            for a, b in zip([0, *cuts[cuts > 0]], [*cuts[cuts > 0], len(us)]):
                if gap[a]:
                    if n:
                        emit("timeout", last)
                    start = None
                if start is None:
                    start, seg, n, types = int(us[a]), 0, 0, []
                n += b - a
                types = types + typ[a:b].tolist() if lists else []
                last = int(us[b - 1])
                if ends[b - 1]:
                    emit("terminator", last)
                    seg, n, types = seg + 1, 0, []
        if last is not None and last + gap_us < wm_us:  # a row at exactly last + gap still joins
            if n:
                emit("timeout", last)
            start, last, seg, n, types = None, None, 0, 0, []
        if start is None and not len(held[0]):
            state.remove()
        else:
            state.update((start, last, seg, n, types, *(h.tolist() for h in held)))
            _arm_first(state, held[0], *([(last + gap_us, True)] if last is not None else []))
        yield from _out(out, TERMINATED_COLUMNS)

    return fn


CAPPED_COLUMNS = ["key", "session_start_us", "session_end_us", "n", "timestamps", "reason"]
CAPPED_STATE = "start_us long, last_us long, n long, ts array<long>, held_us array<long>, held_seq array<long>"


def capped_session_fn(gap_us: int, max_us: int, mode: str = "event_time", lists: bool = True):
    """Sessions closed by inactivity or maximum length, over settled rows; the
    timeout is at the earlier deadline. ``mode="event_time"`` attributes every
    close to the earlier deadline (what the timeouts decide when the watermark
    moves on); ``mode="arrival"`` lets the breaking row decide, like the batch
    mode. ``lists=False`` keeps the number of rows only."""

    def fn(key, pdfs, state):
        start, last, n, ts, *held = state.get if state.exists else (None, None, 0, [], [], [])
        (us, _), held, wm_us = _settle(pdfs, state, held, ["__us", "__seq"])
        ts, out, at = list(ts), [], 0

        def close(inactivity: bool) -> None:
            end = last + gap_us if inactivity else start + max_us
            out.append((key[0], start, end, n, ts if lists else None, "Inactivity" if inactivity else "Max"))

        # Ends of the runs without a gap; a session ends there or at its cap.
        gaps = np.append(np.flatnonzero(np.diff(us) >= gap_us) + 1, len(us))
        while at < len(us):
            if start is not None and (us[at] >= last + gap_us or us[at] > start + max_us):
                close(us[at] >= last + gap_us if mode == "arrival" else last + gap_us <= start + max_us)
                start = None
            if start is None:
                start, n, ts = int(us[at]), 0, []
            upto = min(int(gaps[np.searchsorted(gaps, at, side="right")]), int(np.searchsorted(us, start + max_us, side="right")))
            n, last = n + upto - at, int(us[upto - 1])
            ts = ts + us[at:upto].tolist() if lists else []
            at = upto
        # inactivity: a row at last + gap breaks; cap: a row at start + max still joins
        if start is not None and (last + gap_us <= wm_us or start + max_us < wm_us):
            close(last + gap_us <= start + max_us)
            start, last, n, ts = None, None, 0, []
        if start is None and not len(held[0]):
            state.remove()
        else:
            state.update((start, last, n, ts, *(h.tolist() for h in held)))
            _arm_first(state, held[0], *([(last + gap_us, False), (start + max_us, True)] if start is not None else []))
        yield from _out(out, CAPPED_COLUMNS)

    return fn
