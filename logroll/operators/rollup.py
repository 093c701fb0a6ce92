"""One-minute rollup with mergeable states.

The rollup keeps, per (minute, service, level): ``total_count``, ``error_count`` (status ≥ 500),
``latency_sum`` and ``latency_quantiles`` (a KLL sketch).  Every state merges by a plain
aggregate (``sum`` / ``kll_merge_agg_bigint``), so rows written by different micro-batches for the
same key can be combined at read time or compacted later without changing any total.

Exact percentiles use a companion table of latency frequencies per (minute, service, level,
latency_ms): its ``cnt`` merges by ``sum`` and feeds ``percentile(latency_ms, q, cnt)``.  Memory is
bounded by the number of distinct latencies per group, not rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from logroll.functions.timefn import minute_of
from logroll.schemas import ERROR_STATUS, ROLLUP_KEY

COUNTERS = ["total_count", "error_count", "latency_sum"]


def rollup_1m(logs: DataFrame, sketch: bool = True, k: int | None = None,
              extra_keys: list[str] | None = None) -> DataFrame:
    """Partial rollup of log rows.  ``extra_keys`` (e.g. ``batch_id``) are kept as grouping keys so
    a micro-batch's partial rows stay separable.  Map-side partial aggregation collapses hot
    services before the shuffle."""
    keys = [minute_of("timestamp").alias("minute"), "service", "level", *(extra_keys or [])]
    aggs = [
        F.count(F.lit(1)).alias("total_count"),
        F.sum(F.when(F.col("status_code") >= ERROR_STATUS, 1).otherwise(0)).cast("bigint").alias("error_count"),
        F.sum("latency_ms").cast("bigint").alias("latency_sum"),
    ]
    if sketch:
        aggs.append((F.kll_sketch_agg_bigint("latency_ms", k) if k else F.kll_sketch_agg_bigint("latency_ms"))
                    .alias("latency_quantiles"))
    return logs.groupBy(*keys).agg(*aggs)


def latency_frequencies(logs: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """Exact latency distribution per rollup key: one row per distinct ``latency_ms`` with ``cnt``."""
    return (logs.groupBy(minute_of("timestamp").alias("minute"), "service", "level", "latency_ms",
                         *(extra_keys or []))
            .agg(F.count(F.lit(1)).alias("cnt")))


def merge_rollup(rollup: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Combine partial rows with the same key; totals are unchanged (the read-side merge)."""
    keys = keys or ROLLUP_KEY
    aggs = [F.sum(c).cast("bigint").alias(c) for c in COUNTERS]
    if "latency_quantiles" in rollup.columns:
        aggs.append(F.kll_merge_agg_bigint("latency_quantiles").alias("latency_quantiles"))
    return rollup.groupBy(*keys).agg(*aggs)


def merge_frequencies(freq: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or ROLLUP_KEY
    return freq.groupBy(*keys, "latency_ms").agg(F.sum("cnt").cast("bigint").alias("cnt"))
