from brooklet.sources.landing import (
    as_landing,
    landing_files,
    read_events_csv,
    read_events_stream,
    write_landing,
)
from brooklet.sources.table import read_events_jdbc, read_events_table, read_stored, register_events

__all__ = [
    "as_landing",
    "landing_files",
    "read_events_csv",
    "read_events_jdbc",
    "read_events_stream",
    "read_events_table",
    "read_stored",
    "register_events",
    "write_landing",
]
