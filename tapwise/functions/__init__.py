"""Column expressions. All are built-in Spark functions, so they stay in generated code."""

from tapwise.functions.geo import haversine_km
from tapwise.functions.messages import message_json, parse_message
from tapwise.functions.times import age_years, epoch_millis, event_time, parse_time, wall_clock

__all__ = [
    "age_years", "epoch_millis", "event_time", "haversine_km", "message_json",
    "parse_message", "parse_time", "wall_clock",
]
