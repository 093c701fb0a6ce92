"""Seven-day retention of raw rows and daily partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logroll.functions.timefn import as_timestamp
from logroll.schemas import RETENTION_DAYS


def expiry_cutoff(as_of=None, days: int = RETENTION_DAYS):
    return as_timestamp(as_of) - F.make_interval(days=F.lit(days))


def retain(logs: DataFrame, as_of=None, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows that survive expiry at ``as_of``: the timestamp, cut to whole seconds, plus ``days``
    is still after ``as_of``.  Pruning whole day partitions is ``LogStore.drop_expired``."""
    return logs.where(F.date_trunc("second", "timestamp") + F.make_interval(days=F.lit(days))
                      > as_timestamp(as_of))


def daily_counts(logs: DataFrame) -> DataFrame:
    """Rows per day partition (``event_date`` = UTC date of the timestamp)."""
    col = "event_date" if "event_date" in logs.columns else None
    day = F.col(col) if col else F.to_date("timestamp")
    return logs.groupBy(day.alias("event_date")).agg(F.count(F.lit(1)).alias("rows"))
