"""Report values as text, as a reader of the dashboard sees them (US English: ``12,345`` and ``1:05:09 PM``)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def grouped_number(c) -> Column:
    """A whole number with a comma between thousands."""
    return F.format_number(_col(c), 0)


def clock_text(c) -> Column:
    """Time of day of a timestamp on the twelve-hour clock, in the session's time zone."""
    return F.date_format(_col(c), "h:mm:ss a")
