"""DuckDB SQL oracles for the registered queries (run on the same parquet).

Written independently of the Spark operators: plain window functions over
whole keys, and recursive CTEs that step through each key's rows one by one
for the sequential rules (arrival-order windows, capped sessions). Times are
epoch microseconds: ``epoch_us(ts)`` (``epoch_ms`` would round).
"""

from __future__ import annotations

DAY = 86_400_000_000
WEEK = 7 * DAY
HOUR = 3_600_000_000
GAP = 12 * HOUR
MAX_LEN = 36 * HOUR
IDLE = 24 * HOUR
LATE_DELAY = 5 * HOUR

_E = "SELECT user_id, event_id, event_type, value, epoch_us(ts) AS t FROM events"
_EA = f"SELECT user_id, event_id, value, epoch_us(ts) AS t, epoch_us(ts) + ((event_id * 7919) % 13) * {HOUR} AS arr FROM events"

TUMBLING_MEAN = f"""
WITH e AS ({_E})
SELECT user_id, t - t % {DAY} AS window_start_us, t - t % {DAY} + {DAY} AS window_end_us,
       count(*) AS n, round(avg(value), 6) AS mean
FROM e GROUP BY ALL
"""

# Step through each key's rows in arrival order: a row joins the open window
# if its time is before the window end, otherwise it opens its own window.
_ARRIVAL_WINDOWS = f"""
WITH RECURSIVE e AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY arr, event_id) AS rn FROM ({_EA})
), s(user_id, rn, we) AS (
  SELECT user_id, rn, t - t % {DAY} + {DAY} FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn, CASE WHEN e.t < s.we THEN s.we ELSE e.t - e.t % {DAY} + {DAY} END
  FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1
), m AS (
  SELECT e.user_id, s.we - {DAY} AS window_start_us, s.we AS window_end_us,
         count(*) AS n, round(avg(e.value), 6) AS mean
  FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn GROUP BY ALL
)
"""

ARRIVAL_WINDOW_MEAN = _ARRIVAL_WINDOWS + "SELECT * FROM m"

_ALERTS = f"""
WITH e AS ({_E}),
a AS (SELECT user_id, t, lead(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS nxt FROM e)
SELECT user_id, t AS last_seen_us, t + {IDLE} AS alert_time_us, CAST({IDLE // 1_000_000} AS BIGINT) AS idle_seconds,
       nxt AS next_seen_us
FROM a WHERE nxt - t >= {IDLE}
"""

INACTIVITY_ALERTS = _ALERTS
INACTIVITY_ALERTS_OPEN = _ALERTS + " OR nxt IS NULL"

SENSOR_MONITOR = (
    _ARRIVAL_WINDOWS
    + f""", a AS (SELECT user_id, t, lead(t) OVER (PARTITION BY user_id ORDER BY t, event_id) AS nxt FROM ({_E}))
SELECT user_id, 'mean' AS kind, window_end_us AS at_us, mean AS value, n FROM m
UNION ALL
SELECT user_id, 'alert', t + {IDLE}, CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT) FROM a WHERE nxt - t >= {IDLE}
"""
)

# The same means; silences between arrivals, in arrival time.
SENSOR_MONITOR_ARRIVAL = (
    _ARRIVAL_WINDOWS
    + f""", a AS (SELECT user_id, arr, lead(arr) OVER (PARTITION BY user_id ORDER BY arr, event_id) AS nxt FROM ({_EA}))
SELECT user_id, 'mean' AS kind, window_end_us AS at_us, mean AS value, n FROM m
UNION ALL
SELECT user_id, 'alert', arr + {IDLE}, CAST(NULL AS DOUBLE), CAST(NULL AS BIGINT) FROM a WHERE nxt - arr >= {IDLE}
"""
)

# Alerts that keep every late row: without the row that ends the silence.
STREAM_INACTIVITY_ALERTS_OPEN = f"SELECT user_id, last_seen_us, alert_time_us, idle_seconds FROM ({INACTIVITY_ALERTS_OPEN})"

# A flushed stream also fires each key's final silence (open alert).
STREAM_SENSOR_MONITOR = SENSOR_MONITOR + " OR nxt IS NULL\n"

# Step through each key's rows in (t, event_id) order with the close rules:
# t >= last + gap -> new session; else t > start + max -> new session.
_CAPPED = f"""
WITH RECURSIVE e AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS rn FROM ({_E})
), s(user_id, rn, t, start, last) AS (
  SELECT user_id, rn, t, t, t FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn, e.t,
         CASE WHEN e.t >= s.last + {GAP} OR e.t > s.start + {MAX_LEN} THEN e.t ELSE s.start END,
         e.t
  FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1
), g AS (
  SELECT s.user_id, s.start, max(s.t) AS last, max(s.rn) AS last_rn, count(*) AS n,
         string_agg(CAST(s.t AS VARCHAR), ',' ORDER BY s.t, e.event_id) AS timestamps_us
  FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn GROUP BY ALL
), r AS (
  SELECT g.*, nx.t AS next_t FROM g LEFT JOIN e nx ON nx.user_id = g.user_id AND nx.rn = g.last_rn + 1
)
"""

CAPPED_SESSIONS_ARRIVAL = (
    _CAPPED
    + f""", c AS (
  SELECT *, CASE WHEN next_t IS NULL THEN last + {GAP} <= start + {MAX_LEN}
                 ELSE next_t >= last + {GAP} END AS inactivity FROM r
)
SELECT user_id, start AS session_start_us,
       CASE WHEN inactivity THEN last + {GAP} ELSE start + {MAX_LEN} END AS session_end_us,
       n, timestamps_us, CASE WHEN inactivity THEN 'Inactivity' ELSE 'Max' END AS reason
FROM c
"""
)

CAPPED_SESSIONS_EVENT_TIME = (
    _CAPPED
    + f""", c AS (SELECT *, last + {GAP} <= start + {MAX_LEN} AS inactivity FROM r)
SELECT user_id, start AS session_start_us,
       CASE WHEN inactivity THEN last + {GAP} ELSE start + {MAX_LEN} END AS session_end_us,
       n, timestamps_us, CASE WHEN inactivity THEN 'Inactivity' ELSE 'Max' END AS reason
FROM c
"""
)

# Rows one by one as they arrived: the deadline follows the last arrived row, the start is the first arrived time.
CAPPED_SESSIONS_DISORDERED = f"""
WITH RECURSIVE e AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY arr, event_id) AS rn FROM ({_EA})
), s(user_id, rn, t, start, id, broke) AS (
  SELECT user_id, rn, t, t, rn, CAST(NULL AS VARCHAR) FROM e WHERE rn = 1
  UNION ALL
  SELECT e.user_id, e.rn, e.t,
         CASE WHEN e.t >= s.t + {GAP} OR e.t > s.start + {MAX_LEN} THEN e.t ELSE s.start END,
         CASE WHEN e.t >= s.t + {GAP} OR e.t > s.start + {MAX_LEN} THEN e.rn ELSE s.id END,
         CASE WHEN e.t >= s.t + {GAP} THEN 'Inactivity' WHEN e.t > s.start + {MAX_LEN} THEN 'Max' END
  FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1
), g AS (
  SELECT user_id, id, start, arg_max(t, rn) AS last, max(t) AS top, max(rn) AS last_rn, count(*) AS n,
         string_agg(CAST(t AS VARCHAR), ',' ORDER BY t) AS timestamps_us
  FROM s GROUP BY user_id, id, start
), c AS (
  SELECT g.*, coalesce(nx.broke, CASE WHEN g.last + {GAP} <= g.start + {MAX_LEN} THEN 'Inactivity' ELSE 'Max' END) AS reason
  FROM g LEFT JOIN s nx ON nx.user_id = g.user_id AND nx.rn = g.last_rn + 1
)
SELECT user_id, start AS session_start_us, CASE WHEN reason = 'Max' THEN start + {MAX_LEN} ELSE top + {GAP} END AS session_end_us,
       n, timestamps_us, reason
FROM c
"""

_EARLY = f"""
WITH e AS ({_E}),
w AS (SELECT user_id, t - t % {WEEK} AS ws,
             row_number() OVER (PARTITION BY user_id, t - t % {WEEK} ORDER BY event_id) AS k FROM e)
SELECT user_id, ws AS window_start_us, ws + {WEEK} AS window_end_us, k AS "count", 'early' AS pane
FROM w WHERE k >= 5
"""

EARLY_COUNT = _EARLY
EARLY_COUNT_FINAL = (
    _EARLY
    + f"""UNION ALL
SELECT user_id, t - t % {WEEK}, t - t % {WEEK} + {WEEK}, count(*), 'final' FROM ({_E}) GROUP BY ALL
"""
)

LATE_AUDIT = f"""
WITH e AS ({_EA}),
w AS (SELECT *, max(t) OVER (ORDER BY arr, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                - {LATE_DELAY} AS wm FROM e)
SELECT user_id, event_id, t AS ts_us, wm AS watermark_before_us,
       coalesce(t - t % {DAY} + {DAY} <= wm, false) AS is_late
FROM w
"""

_SESSIONS = f"""
WITH e AS ({_E}),
a AS (
  SELECT *, lag(t) OVER w AS p,
         CAST(coalesce(sum(CASE WHEN event_type IN ('purchase', 'error') THEN 1 ELSE 0 END)
                       OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS tb
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)
),
b AS (
  SELECT *, sum(CASE WHEN p IS NULL OR t - p > {GAP} THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS sid
  FROM a
),
c AS (
  SELECT *, min(t) OVER (PARTITION BY user_id, sid) AS ss, tb - min(tb) OVER (PARTITION BY user_id, sid) AS seg
  FROM b
)
"""

TERMINATED_SESSIONS = (
    _SESSIONS
    + f"""SELECT user_id, ss AS session_start_us, max(t) + {GAP} AS session_end_us, seg AS segment,
       string_agg(event_type, ',' ORDER BY t, event_id) AS event_types,
       CASE WHEN (array_agg(event_type ORDER BY t DESC, event_id DESC))[1] IN ('purchase', 'error')
            THEN 'terminator' ELSE 'timeout' END AS closed_by
FROM c GROUP BY user_id, ss, seg
"""
)

TERMINATED_SESSION_ROWS = (
    _SESSIONS
    + """SELECT user_id, event_id, t AS ts_us, event_type, ss AS session_start_us, seg AS segment,
       row_number() OVER (PARTITION BY user_id, ss, seg ORDER BY t, event_id) - 1 AS position
FROM c
"""
)

GAP_SESSIONS = (
    _SESSIONS
    + f"""SELECT user_id, ss AS session_start_us, max(t) + {GAP} AS session_end_us, count(*) AS n
FROM c GROUP BY user_id, ss
"""
)

# Timestamp text: 'yyyy-MM-dd HH:mm:ss.' + fraction without trailing zeros (at least one digit).
def _ts_text(us: str) -> str:
    t = f"make_timestamp({us})"
    frac = f"rtrim(strftime({t}, '%f'), '0')"
    return f"(strftime({t}, '%Y-%m-%d %H:%M:%S') || '.' || CASE WHEN {frac} = '' THEN '0' ELSE {frac} END)"


TERMINATED_SESSION_MESSAGES = (
    _SESSIONS
    + f""", g AS (
  SELECT user_id, ss, seg, max(t) + {GAP} AS se, string_agg(event_type, ', ' ORDER BY t, event_id) AS types
  FROM c GROUP BY user_id, ss, seg
)
SELECT user_id, ss AS session_start_us, seg AS segment,
       'Session for user ' || CAST(user_id AS VARCHAR) || ' [' || {_ts_text("ss")} || ',' || {_ts_text("se")}
       || ') -> Events: [' || types || ']' AS message
FROM g
"""
)

CAPPED_SESSION_MESSAGES = (
    _CAPPED
    + f""", c AS (
  SELECT *, CASE WHEN next_t IS NULL THEN last + {GAP} <= start + {MAX_LEN}
                 ELSE next_t >= last + {GAP} END AS inactivity FROM r
), m AS (
  SELECT s.user_id, s.start, string_agg(CAST(s.t // 1000 AS VARCHAR), ', ' ORDER BY s.t, e.event_id) AS ms
  FROM s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn GROUP BY ALL
)
SELECT c.user_id, c.start AS session_start_us,
       'Window([' || m.ms || ']) // closed by ' || CASE WHEN inactivity THEN 'Inactivity' ELSE 'Max' END
       || ' (start=' || CAST(c.start // 1000 AS VARCHAR) || ', end='
       || CAST((CASE WHEN inactivity THEN last + {GAP} ELSE c.start + {MAX_LEN} END) // 1000 AS VARCHAR) || ')' AS message
FROM c JOIN m ON m.user_id = c.user_id AND m.start = c.start
"""
)

def _mean_text(mean: str, end: str) -> str:
    return (f"'Average temperature for sensor ' || CAST(user_id AS VARCHAR) || ' for window ending at ' || CAST({end} // 1000 AS VARCHAR)"
            f" || ' = ' || CAST({mean} AS VARCHAR)")


_ALERT_TEXT = f"'ALERT: Sensor ' || CAST(user_id AS VARCHAR) || ' has been inactive for {IDLE // 1_000_000} seconds'"

MEAN_MESSAGES = f"SELECT user_id, window_end_us, {_mean_text('mean', 'window_end_us')} AS message FROM ({TUMBLING_MEAN})"

ALERT_MESSAGES = f"SELECT user_id, last_seen_us, {_ALERT_TEXT} AS message FROM ({INACTIVITY_ALERTS})"

EARLY_COUNT_MESSAGES = f"""SELECT user_id, window_start_us, pane, "count",
       'User ' || CAST(user_id AS VARCHAR) || ' had ' || CAST("count" AS VARCHAR) || ' events in window ['
       || {_ts_text("window_start_us")} || ',' || {_ts_text("window_end_us")} || ')' AS message
FROM ({EARLY_COUNT_FINAL})
"""

MONITOR_MESSAGES = f"""SELECT user_id, kind, at_us,
       CASE WHEN kind = 'mean' THEN {_mean_text('value', 'at_us')} ELSE {_ALERT_TEXT} END AS message
FROM ({SENSOR_MONITOR})
"""

# Rows whose day has been passed by the watermark of all earlier arrivals are left out, then counted by arrival.
EARLY_COUNT_LATE_DROPPED = f"""
WITH e AS ({_EA}),
w AS (SELECT *, t - t % {DAY} AS ws, max(t) OVER (ORDER BY arr, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                - {LATE_DELAY} AS wm FROM e),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id, ws ORDER BY arr, event_id) AS k
      FROM w WHERE wm IS NULL OR ws + {DAY} > wm)
SELECT user_id, ws AS window_start_us, ws + {DAY} AS window_end_us, k AS "count", 'early' AS pane FROM k WHERE k >= 2
UNION ALL
SELECT user_id, ws, ws + {DAY}, count(*), 'final' FROM k GROUP BY ALL
"""

ORACLE_SQL: dict[str, str] = {
    "tumbling_mean": TUMBLING_MEAN,
    "arrival_window_mean": ARRIVAL_WINDOW_MEAN,
    "inactivity_alerts": INACTIVITY_ALERTS,
    "inactivity_alerts_open": INACTIVITY_ALERTS_OPEN,
    "sensor_monitor": SENSOR_MONITOR,
    "capped_sessions_arrival": CAPPED_SESSIONS_ARRIVAL,
    "capped_sessions_event_time": CAPPED_SESSIONS_EVENT_TIME,
    "capped_sessions_disordered": CAPPED_SESSIONS_DISORDERED,
    "early_count": EARLY_COUNT,
    "early_count_final": EARLY_COUNT_FINAL,
    "late_audit": LATE_AUDIT,
    "terminated_sessions": TERMINATED_SESSIONS,
    "gap_sessions": GAP_SESSIONS,
    "sensor_monitor_arrival": SENSOR_MONITOR_ARRIVAL,
    "terminated_session_rows": TERMINATED_SESSION_ROWS,
    "terminated_session_messages": TERMINATED_SESSION_MESSAGES,
    "capped_session_messages": CAPPED_SESSION_MESSAGES,
    "mean_messages": MEAN_MESSAGES,
    "alert_messages": ALERT_MESSAGES,
    "early_count_messages": EARLY_COUNT_MESSAGES,
    "monitor_messages": MONITOR_MESSAGES,
    "early_count_late_dropped": EARLY_COUNT_LATE_DROPPED,
    "stream_sensor_monitor": STREAM_SENSOR_MONITOR,
    # With every row kept, the last revisions are the batch operator's rows.
    "stream_arrival_window_mean_late": ARRIVAL_WINDOW_MEAN,
    "stream_gap_sessions_late": GAP_SESSIONS,
    "stream_inactivity_alerts_late": STREAM_INACTIVITY_ALERTS_OPEN,
    "stream_capped_sessions_late": CAPPED_SESSIONS_EVENT_TIME,
    "stream_terminated_sessions_revised": TERMINATED_SESSIONS,
}
