from meterflow.functions.jsonvals import as_double, as_integer, strict_number
from meterflow.functions.numbers import haversine_km, linear_decay, path_normaliser, round_half_up
from meterflow.functions.texts import blank_to_null, control_trim, is_blank, same_text
from meterflow.functions.times import (
    dt_bucket_us, event_us, iso_local, micros_text, minutes_between, seconds_text,
)

__all__ = [
    "as_double", "as_integer", "blank_to_null", "control_trim", "dt_bucket_us", "event_us",
    "haversine_km", "is_blank", "iso_local", "linear_decay", "micros_text", "minutes_between",
    "path_normaliser", "round_half_up", "same_text", "seconds_text", "strict_number",
]
