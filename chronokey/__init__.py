"""chronokey: keyed event-time analytics on Spark DataFrames and streams.

Every operator is a plain function ``DataFrame -> DataFrame`` built from
Spark SQL expressions, windows and aggregates; see ``chronokey.operators``.
"""

from chronokey.operators.alerts import inactivity_alerts, sensor_monitor
from chronokey.operators.late import late_audit
from chronokey.operators.render import render
from chronokey.operators.sessions import capped_sessions, gap_sessions, terminated_session_rows, terminated_sessions
from chronokey.operators.triggers import early_count
from chronokey.operators.windows import arrival_window_mean, tumbling_mean

__all__ = [
    "arrival_window_mean",
    "capped_sessions",
    "early_count",
    "gap_sessions",
    "inactivity_alerts",
    "late_audit",
    "render",
    "sensor_monitor",
    "terminated_session_rows",
    "terminated_sessions",
    "tumbling_mean",
]
