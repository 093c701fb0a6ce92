"""Time helpers: minute buckets, ISO text, trailing-window bounds, the window argument rule."""

from __future__ import annotations

import datetime as _dt
import math
import re

from pyspark.sql import Column, functions as F

from logroll.schemas import DEFAULT_WINDOW_MINUTES


def minute_of(ts: Column | str) -> Column:
    """Start of the one-minute bucket holding ``ts``."""
    return F.date_trunc("minute", F.col(ts) if isinstance(ts, str) else ts)


def iso_millis(ts: Column | str) -> Column:
    """ISO-8601 UTC text with milliseconds, e.g. ``2026-07-31T12:34:56.789Z`` (session zone is UTC)."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


# Numerals of a request argument: ASCII digits, no separators.
_BASED = re.compile(r"0[xX][0-9a-fA-F]+|0[oO][0-7]+|0[bB][01]+")
_DECIMAL = re.compile(r"[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|Infinity)")


def window_minutes(minutes=None) -> int:
    """Trailing-window length from a request argument.

    The argument is read like a JavaScript ``Number(x)``: missing, unparsable, zero or negative
    gives the default of 15.  A fraction cannot be bound to a whole-minute interval and is an
    error.
    """
    if minutes is None or isinstance(minutes, bool):
        value = float(minutes) if isinstance(minutes, bool) else math.nan
    elif isinstance(minutes, (int, float)):
        value = float(minutes)
    else:
        text = str(minutes).strip()
        if text == "":
            value = 0.0
        else:
            value = float(int(text, 0)) if _BASED.fullmatch(text) else float(text) if _DECIMAL.fullmatch(text) else math.nan
    if math.isnan(value) or value <= 0:
        return DEFAULT_WINDOW_MINUTES
    if math.isinf(value) or value != math.floor(value):
        raise ValueError(f"window must be a whole number of minutes, got {minutes!r}")
    return int(value)


def as_timestamp(as_of) -> Column:
    """``as_of`` as a timestamp Column: None → current_timestamp(), text/datetime → literal."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.datetime, _dt.date)):
        return F.lit(as_of).cast("timestamp")
    return F.lit(str(as_of)).cast("timestamp")


def window_start(as_of, minutes) -> Column:
    """Lower bound of a trailing window: ``as_of - minutes``.  Reports keep buckets whose start is at
    or after it, so the partly covered oldest bucket is left out and future buckets stay in."""
    return as_timestamp(as_of) - F.make_interval(mins=F.lit(window_minutes(minutes)))
