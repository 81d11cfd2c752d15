from brooklet.functions.money import as_money, cents, line_total, round_money, total_money
from brooklet.functions.sums import exact_sum, high, joined, low
from brooklet.functions.time import (
    batch_boundary,
    event_minute,
    latency_micros,
    parse_event_time,
    render_event_time,
)

__all__ = [
    "as_money",
    "batch_boundary",
    "cents",
    "event_minute",
    "exact_sum",
    "high",
    "joined",
    "latency_micros",
    "line_total",
    "low",
    "parse_event_time",
    "render_event_time",
    "round_money",
    "total_money",
]
