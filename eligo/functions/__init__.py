"""Column-expression helpers: every one compiles to built-in Catalyst expressions."""

from eligo.functions.casts import json_field, nvl_decimal, typed
from eligo.functions.paths import hour_window, path_part, path_parts
from eligo.functions.time import (
    date_plus_days,
    epoch_ms_to_ts,
    landing_hour_ts,
    ts_to_epoch_ms,
    utc_to_zone,
)

__all__ = [
    "date_plus_days", "epoch_ms_to_ts", "hour_window", "json_field",
    "landing_hour_ts", "nvl_decimal", "path_part", "path_parts", "ts_to_epoch_ms",
    "typed", "utc_to_zone",
]
