"""Structured Streaming forms of the operators and the bounded replay helper."""

from chronokey.streaming.operators import (
    revised_alerts,
    stream_arrival_window_mean,
    stream_capped_sessions,
    stream_early_count,
    stream_gap_sessions,
    stream_inactivity_alerts,
    stream_live_monitor,
    stream_sensor_monitor,
    stream_terminated_sessions,
    stream_tumbling_mean,
)
from chronokey.streaming.revised import (
    ArrivalMeanStream,
    CappedSessionStream,
    GapSessionStream,
    InactivityAlertStream,
    LateAuditStream,
    TerminatedSessionStream,
    latest,
)

__all__ = [
    "ArrivalMeanStream",
    "CappedSessionStream",
    "GapSessionStream",
    "InactivityAlertStream",
    "LateAuditStream",
    "TerminatedSessionStream",
    "latest",
    "revised_alerts",
    "stream_arrival_window_mean",
    "stream_capped_sessions",
    "stream_early_count",
    "stream_gap_sessions",
    "stream_inactivity_alerts",
    "stream_live_monitor",
    "stream_sensor_monitor",
    "stream_terminated_sessions",
    "stream_tumbling_mean",
]
