from chronokey.sources.tables import EVENT_SCHEMA, read_events, read_table
from chronokey.sources.samples import sensor_readings, user_events

__all__ = ["EVENT_SCHEMA", "read_events", "read_table", "sensor_readings", "user_events"]
