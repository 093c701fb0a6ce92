"""Pipeline telemetry as table operators over metric samples ``(ts, metric, labels, value)``.

Dashboard panels are re-expressed as DataFrame work:

* ``counter_rate``      — ``sum(rate(c[step]))``, optionally ``by`` a label (counter resets handled).
* ``sliding_rate``      — the same over a trailing window at every refresh (overlapping windows).
* ``histogram_buckets`` — cumulative ``le`` buckets of observed values (one aggregation pass).
* ``histogram_quantile``— quantiles from cumulative buckets with linear interpolation.
* ``histogram_rate_quantile`` — the same over the rates of cumulative bucket counters per step.
* ``latest``            — instant value of each series (gauges, lag per partition).
* ``metric_total``      — sum over every series whose name has a prefix (latest values).

Rates divide the increase of a step by the time its samples cover; no extrapolation to the
window edges is done.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from logroll.operators.sequence import previous_value, running_totals


def series_key(labels: str = "labels") -> Column:
    """Groupable identity of a label map (maps cannot be grouping keys): sorted entries."""
    return F.sort_array(F.map_entries(F.col(labels)))


def _increase(prev: Column, value: Column) -> Column:
    """0 without a previous value, the value itself after a reset (value went down), else the
    difference."""
    return (F.when(prev.isNull(), F.lit(0.0))
            .when(value < prev, value)
            .otherwise(value - prev))


def counter_increase(samples: DataFrame, slice_unit: str = "minute") -> DataFrame:
    """Add ``increase`` to every sample: 0 for a series' first, the value itself after a reset,
    else the difference to the previous sample."""
    df = samples.withColumn("_series", series_key())
    df = previous_value(df, ["metric", "_series"], "ts", "value", out="_prev", slice_unit=slice_unit)
    return df.withColumn("increase", _increase(F.col("_prev"), F.col("value"))).drop("_prev", "_series")


def _step_seconds(step: str) -> int:
    n, unit = step.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
    return int(n) * mult


def _slice_increases(samples: DataFrame, slice_of: Callable[[Column], Column]) -> DataFrame:
    """(metric, _series, _slice, _inc, _covered): what each series' samples of a slice add to it, and
    the microseconds between them and their predecessors (in the slice or before it).  ``slice_of``
    maps a sample's microseconds to its slice, in order."""
    series = ["metric", "_series"]
    instants = (samples.where("ts IS NOT NULL AND value IS NOT NULL")
                .groupBy("metric", series_key().alias("_series"),
                         F.unix_micros(F.col("ts").cast("timestamp")).alias("_us"))
                .agg(F.max("value").alias("_v"))
                .withColumn("_slice", slice_of(F.col("_us"))))
    inside = Window.partitionBy(*series, "_slice").orderBy("_us")
    at = F.struct("_us", "_v")
    slices = (instants.withColumn("_p", F.lag(at).over(inside))
              .groupBy(*series, "_slice")
              .agg(F.sum(_increase(F.col("_p._v"), F.col("_v"))).alias("_inc"),
                   F.coalesce(F.sum(F.col("_us") - F.col("_p._us")), F.lit(0)).alias("_covered"),
                   F.min(at).alias("_first"), F.max(at).alias("_last")))
    ordered = Window.partitionBy(*series).orderBy("_slice")
    return (slices.withColumn("_p", F.lag("_last").over(ordered))
            .select(*series, "_slice",
                    (F.col("_inc") + _increase(F.col("_p._v"), F.col("_first._v"))).alias("_inc"),
                    (F.col("_covered") + F.coalesce(F.col("_first._us") - F.col("_p._us"), F.lit(0))).alias("_covered")))


def counter_rate(samples: DataFrame, step: str = "1 hour", by: list[str] | None = None) -> DataFrame:
    """Per-second rate per ``step`` bucket, summed over series (and grouped by label names in
    ``by``): columns ``time``, one per label, ``rate``.

    A series' rate in a step is the increase up to each of the step's samples, divided by the
    seconds between those samples and their predecessors (which may lie in an earlier step).  A
    step in which no series has a predecessor has a null rate.  Samples of one series at one
    instant count as one, the largest; samples without ``ts`` or ``value`` are no samples; null
    labels are a series of their own.

    Only a summary with one row per series and slice (a minute, or the part of it that divides the
    step) is ordered by series: a hot series is spread over its slices, and no row is joined back.
    """
    unit = math.gcd(_step_seconds(step), 60) * 1_000_000
    series = ["metric", "_series"]
    time = F.window(F.timestamp_micros("_slice"), step).start.cast(samples.schema["ts"].dataType)
    joined = _slice_increases(samples, lambda us: us - F.pmod(us, F.lit(unit))).withColumn("time", time)
    labels = [F.map_from_entries("_series")[k].alias(k) for k in (by or [])]
    per_series = (joined.groupBy(*series, "time")
                  .agg(F.try_divide(F.sum("_inc") * F.lit(1e6), F.sum("_covered").cast("double")).alias("_rate")))
    return per_series.groupBy("time", *labels).agg(F.sum("_rate").alias("rate"))


def sliding_rate(samples: DataFrame, window: str = "5 minutes", every: str = "5 seconds",
                 by: list[str] | None = None) -> DataFrame:
    """``sum(rate(c[window]))`` at every refresh: columns ``time``, one per label in ``by``, ``rate``.

    Refreshes are the multiples of ``every``; the one at ``t`` sees the samples in ``(t - window, t]``.
    A series' rate there is the increase up to each of those samples, divided by the seconds between
    them and their predecessors (which may lie before the window); a reset starts from 0.  A series
    without a sample in the window has no rate; refreshes at which no series has one are left out, and
    those whose only samples are the first of their series have a null rate.

    A sample enters the window at its refresh and leaves it ``window`` later, so the window's sums are
    running totals of what enters minus what leaves: overlapping windows cost two rows per series and
    refresh with samples, no self-join, and nothing is repeated per window.  Running totals are cut
    into blocks of a thousand refreshes, so a hot series is spread over tasks.
    """
    step, wide = _step_seconds(every) * 1_000_000, _step_seconds(window) * 1_000_000
    if wide % step:
        raise ValueError(f"a window of {window} is not a multiple of {every}")
    series = ["metric", "_series"]
    unit = math.gcd(step, 60_000_000)
    up = lambda us, n: us + F.pmod(-us, F.lit(n))                                          # noqa: E731
    slots = (_slice_increases(samples, lambda us: up(us, unit))
             .groupBy(*series, up(F.col("_slice"), step).alias("_t"))
             .agg(F.sum("_inc").alias("_inc"), F.sum("_covered").alias("_covered")))
    enter = slots.withColumn("_n", F.lit(1).cast("long"))
    leave = slots.select(*series, (F.col("_t") + wide).alias("_t"), (-F.col("_inc")).alias("_inc"),
                         (-F.col("_covered")).alias("_covered"), F.lit(-1).cast("long").alias("_n"))
    sums = ["_inc", "_covered", "_n"]
    changes = enter.unionByName(leave).groupBy(*series, "_t").agg(*[F.sum(c).alias(c) for c in sums])
    state = running_totals(changes, series, "_t", sums, 1000 * step, following="_until").where("_n > 0")
    # Between two changes every refresh has the same sums; what is emitted is the result itself.
    shown = state.select(*series, F.explode(F.sequence("_t", F.col("_until") - step, F.lit(step).cast("long"))).alias("_at"),
                         F.try_divide(F.col("_inc") * 1e6, F.when(F.col("_covered") > 0, F.col("_covered")).cast("double")).alias("_rate"))
    labels = [F.map_from_entries("_series")[k].alias(k) for k in (by or [])]
    time = F.timestamp_micros("_at").cast(samples.schema["ts"].dataType).alias("time")
    return shown.groupBy(time, *labels).agg(F.sum("_rate").alias("rate"))


def format_le(bound: float) -> str:
    return "+Inf" if math.isinf(bound) else format(bound, "g")


def histogram_buckets(df: DataFrame, value: str, bounds, group: list[str] | None = None,
                      with_sum: bool = False) -> DataFrame:
    """Cumulative buckets: for each bound ``le`` the number of values ≤ ``le``, plus ``+Inf`` (all
    values).  One conditional aggregation per group (partial aggregation before the shuffle), then
    unpivoted to rows ``(group..., le, count)``; ``with_sum`` adds ``sum`` and ``count`` columns."""
    group = group or []
    bounds = sorted(float(b) for b in bounds)
    v = F.col(value)
    aggs = [F.count_if(v <= F.lit(b)).alias(f"b{i}") for i, b in enumerate(bounds)]
    aggs += [F.count(v).alias(f"b{len(bounds)}"), F.sum(v).alias("_sum")]
    wide = df.groupBy(*group).agg(*aggs)
    les = [format_le(b) for b in bounds] + ["+Inf"]
    pairs = F.array(*[F.struct(F.lit(le).alias("le"), F.col(f"b{i}").alias("count")) for i, le in enumerate(les)])
    out = wide.select(*group, F.col("_sum").alias("sum"), F.col(f"b{len(bounds)}").alias("total"),
                      F.inline(pairs))
    if with_sum:
        return out
    return out.drop("sum", "total")


def le_value(le: Column) -> Column:
    return F.when(le == "+Inf", F.lit(float("inf"))).otherwise(le.cast("double"))


def _bucket_quantile(buckets: Column, q: float) -> Column:
    """Quantile ``q`` of a sorted array of ``(le, cnt)`` with cumulative counts."""
    if not 0 <= q <= 1:
        raise ValueError(f"a quantile lies between 0 and 1, not at {q}")
    inf = F.lit(float("inf"))
    last = F.try_element_at(buckets, F.lit(-1))
    total = F.when(last["le"] == inf, last["cnt"])
    rank = F.lit(float(q)) * total
    hit = F.try_element_at(F.filter(buckets, lambda x: x["cnt"] >= rank), F.lit(1))
    prev = F.try_element_at(F.filter(buckets, lambda x: x["le"] < hit["le"]), F.lit(-1))
    top = F.try_element_at(F.filter(buckets, lambda x: x["le"] < inf), F.lit(-1))["le"]
    low, below = F.coalesce(prev["le"], F.lit(0.0)), F.coalesce(prev["cnt"], F.lit(0.0))
    frac = F.coalesce(F.try_divide(rank - below, hit["cnt"] - below), F.lit(0.0))
    return F.when(total > 0, F.when(hit["le"] == inf, top).otherwise(low + (hit["le"] - low) * frac))


def histogram_quantile(buckets: DataFrame, q: float | list[float], group: list[str] | None = None,
                       le: str = "le", count: str = "count", out: str | list[str] = "quantile") -> DataFrame:
    """Quantiles ``q`` (one or a list, with as many names in ``out``) from cumulative buckets (any
    ``le`` labels, ``+Inf`` last): find the first bucket whose count reaches ``q * total`` and
    interpolate linearly inside it (from 0 for the first bucket).  If that bucket is ``+Inf`` the
    largest finite bound is returned.  A group without observations (total 0 or unknown, no
    ``+Inf`` bucket) gives null, where the panel shows no number.

    A group's buckets are as few as the bounds, so they are gathered into one small array; all
    quantiles come from the same aggregation."""
    group = group or []
    qs, names = (list(q), list(out)) if isinstance(q, (list, tuple)) else ([q], [out])
    bucket = F.struct(le_value(F.col(le)).alias("le"), F.col(count).cast("double").alias("cnt"))
    known = F.col(le).isNotNull() & F.col(count).isNotNull()
    b = buckets.groupBy(*group).agg(F.sort_array(F.collect_list(F.when(known, bucket))).alias("_b"))
    return b.select(*group, *[_bucket_quantile(F.col("_b"), x).alias(n) for x, n in zip(qs, names, strict=True)])


def histogram_rate_quantile(samples: DataFrame, bucket_metric: str, q: float | list[float], step: str = "5 minutes",
                            by: list[str] | None = None, out: str | list[str] = "quantile",
                            every: str | None = None) -> DataFrame:
    """``histogram_quantile(q, sum(rate(<bucket_metric>[step])) by (le))``: per-``le`` rates of the
    cumulative bucket counters per step, then the quantiles of each step's buckets.  With ``every``
    the step is a trailing window seen at each refresh (``sliding_rate``)."""
    rows, labels = samples.where(F.col("metric") == bucket_metric), ["le", *(by or [])]
    rates = sliding_rate(rows, step, every, labels) if every else counter_rate(rows, step, labels)
    return histogram_quantile(rates, q, ["time", *(by or [])], le="le", count="rate", out=out)


def _newest(value: str, ts: str) -> Column:
    """Value of the newest sample; the larger value of samples at one instant."""
    return F.max_by(F.col(value), F.when(F.col(ts).isNotNull(), F.struct(F.col(ts), F.col(value))))


def latest(samples: DataFrame, keys: list[str], value: str = "value", ts: str = "ts",
           out: str = "value") -> DataFrame:
    """Instant value: the newest sample's value per key (gauge panels, lag per partition)."""
    return samples.groupBy(*keys).agg(_newest(value, ts).alias(out))


def metric_total(samples: DataFrame, prefix: str) -> DataFrame:
    """Sum of the current (newest) value of every series whose metric name starts with
    ``prefix``, across all labels."""
    cur = (samples.where(F.col("metric").startswith(prefix))
           .groupBy("metric", series_key().alias("_series"))
           .agg(_newest("value", "ts").alias("value")))
    return cur.agg(F.sum("value").alias("total"))
