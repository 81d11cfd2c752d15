from brooklet.streaming.ingest import (
    BatchReport,
    ContractViolation,
    Ingest,
    ProgressRecorder,
    read_metrics,
    run,
)
from brooklet.streaming.live import (
    dedupe_stream,
    latest_result,
    live_events_per_minute,
    overwrite_sink,
)
from brooklet.streaming.session import stream_session
from brooklet.streaming.sinks import JdbcSink, TableSink

__all__ = [
    "BatchReport",
    "ContractViolation",
    "Ingest",
    "JdbcSink",
    "TableSink",
    "dedupe_stream",
    "latest_result",
    "live_events_per_minute",
    "overwrite_sink",
    "ProgressRecorder",
    "read_metrics",
    "run",
    "stream_session",
]
