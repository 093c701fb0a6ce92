"""Column-level building blocks (pure expressions, no actions)."""

from logroll.functions.timefn import (  # noqa: F401
    as_timestamp, iso_millis, minute_of, window_minutes, window_start,
)
from logroll.functions.text import clock_text, grouped_number  # noqa: F401
from logroll.functions.strict_json import decode_payload, json_type, parse_strict  # noqa: F401
