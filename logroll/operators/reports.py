"""Trailing-window reports answered from the rollup (never from raw rows).

Each report keeps rollup buckets whose ``minute`` is at or after ``as_of - minutes``; ``as_of``
defaults to the current time and may be a literal or a Column (e.g. a scalar subquery).  The
``minutes`` argument follows the request rule: missing, unparsable, zero or negative → 15.
Orderings add ``service`` as a tie-break so results are deterministic.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from logroll.functions.timefn import window_start
from logroll.schemas import REPORT_QUANTILES, TOP_SERVICES


def in_window(rollup: DataFrame, minutes=None, as_of=None) -> DataFrame:
    """Rollup rows of the trailing window.  The bound compares bucket starts, so it is pushed to
    the Parquet scan as a ``minute`` predicate."""
    return rollup.where(F.col("minute") >= window_start(as_of, minutes))


def throughput(rollup: DataFrame, minutes=None, as_of=None) -> DataFrame:
    """Valid rows per minute, oldest first: ``time``, ``count``."""
    return (in_window(rollup, minutes, as_of)
            .groupBy(F.col("minute").alias("time"))
            .agg(F.sum("total_count").cast("bigint").alias("count"))
            .orderBy("time"))


def errors_by_service(rollup: DataFrame, minutes=None, as_of=None) -> DataFrame:
    """Rows with status ≥ 500 per service, most first; services without errors are listed with 0."""
    return (in_window(rollup, minutes, as_of)
            .groupBy("service")
            .agg(F.sum("error_count").cast("bigint").alias("error_count"))
            .orderBy(F.desc("error_count"), "service"))


def top_services(rollup: DataFrame, minutes=None, as_of=None, n: int = TOP_SERVICES) -> DataFrame:
    """The ``n`` services with the most rows: ``service``, ``volume`` (top-k, not a full sort)."""
    return (in_window(rollup, minutes, as_of)
            .groupBy("service")
            .agg(F.sum("total_count").cast("bigint").alias("volume"))
            .orderBy(F.desc("volume"), "service")
            .limit(n))


def percentiles_by_rank(freq: DataFrame, keys: list[str], value: str = "latency_ms", count: str = "cnt",
                        quantiles=REPORT_QUANTILES, out: str = "percentiles") -> DataFrame:
    """Exact, linearly interpolated percentiles of ``value`` weighted by ``count`` per group, as an array.

    Values are cut into ranges a fiftieth wide (by their logarithm, which keeps their order).  Prefix
    sums of the ranges' totals tell which range holds each wanted rank; only those ranges are ordered by
    value, each in a task of its own.  A group with most of the rows is thus summed by value, then by
    range, and never gathered.  Rows without value or with a count below 1 do not take part.
    """
    # Same values, same range; larger values, same or later range.
    of = F.floor(F.signum(F.col(value)) * F.log1p(F.abs(F.col(value).cast("double"))) * 50)
    sums = (freq.where(F.col(value).isNotNull() & (F.col(count) > 0)).groupBy(*keys, F.col(value).alias("_v"), of.alias("_r"))
            .agg(F.sum(count).cast("long").alias("_c")))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (sums.groupBy(*keys, "_r").agg(F.sum("_c").alias("_n"))
              .withColumn("_ahead", F.coalesce(F.sum("_n").over(before), F.lit(0))).withColumn("_all", F.sum("_n").over(whole)))
    place = [F.lit(float(q)) * (F.col("_all") - 1) for q in quantiles]
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), side.alias("side"), rank.cast("long").alias("k")) for i, p in enumerate(place)
                       for side, rank in ((F.lit("lo"), F.floor(p)), (F.lit("hi"), F.ceil(p)))])
    here = F.filter(wanted, lambda w: (w["k"] >= F.col("_ahead")) & (w["k"] < F.col("_ahead") + F.col("_n")))
    hits = ranges.withColumn("_w", here).where(F.size("_w") > 0).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_r").alias("_hit"), "_ahead", "_all", "_w")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.col("_r") == F.col("_hit"))
    inside = Window.partitionBy(*keys, "_r").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = sums.join(hits, same).withColumn("_to", F.col("_ahead") + F.sum("_c").over(inside))
    picked = ranked.select(*keys, "_v", "_all", "_to", "_c", F.inline("_w")).where("k < _to AND k >= _to - _c")
    at = lambda i, side: F.max(F.when((F.col("i") == i) & (F.col("side") == side), F.col("_v"))).cast("double")
    both = picked.groupBy(*keys).agg(F.max("_all").alias("_all"), *[at(i, s).alias(f"_{s}{i}") for i in range(len(quantiles)) for s in ("lo", "hi")])
    share = [p - F.floor(p) for p in place]
    return both.select(*keys, F.array(*[F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * d for i, d in enumerate(share)]).alias(out))


def latency_percentiles(freq: DataFrame, minutes=None, as_of=None,
                        quantiles=REPORT_QUANTILES) -> DataFrame:
    """Exact, linearly interpolated latency percentiles per service from the frequency rows:
    ``service``, ``percentiles`` = [p50, p90, p99] by default."""
    return percentiles_by_rank(in_window(freq, minutes, as_of), ["service"], quantiles=quantiles).orderBy("service")


def latency_percentiles_sketch(rollup: DataFrame, minutes=None, as_of=None,
                               quantiles=REPORT_QUANTILES) -> DataFrame:
    """Approximate percentiles per service by merging the KLL sketch states; each result is an
    observed latency (no interpolation) within the sketch's rank error."""
    qs = F.array(*[F.lit(float(q)) for q in quantiles])
    return (in_window(rollup, minutes, as_of)
            .groupBy("service")
            .agg(F.kll_sketch_get_quantile_bigint(F.kll_merge_agg_bigint("latency_quantiles"), qs)
                 .alias("percentiles"))
            .orderBy("service"))


def sketch_ranks(rollup: DataFrame, freq: DataFrame, minutes=None, as_of=None, quantiles=REPORT_QUANTILES,
                 rank_error: float = 0.03) -> DataFrame:
    """How good the sketch's answers are: ``service``, ``rows`` and per quantile ``within``, true if the answer is
    a latency that occurs and the ranks it takes come within ``rank_error`` (a share of all rows) of the wanted one.

    The default is about twice what the default sketch promises with 99 % certainty.  Ranks are counted from
    the exact frequencies by sums alone: no order, no window, one row per service against its values.
    """
    answers = latency_percentiles_sketch(rollup, minutes, as_of, quantiles)
    v = [F.col("percentiles")[i] for i in range(len(quantiles))]
    share = lambda cond: F.sum(F.when(cond, F.col("cnt")).otherwise(0)) / F.sum("cnt")
    ranks = (in_window(freq, minutes, as_of).groupBy("service", "latency_ms").agg(F.sum("cnt").alias("cnt"))
             .join(answers, "service").groupBy("service")
             .agg(F.sum("cnt").cast("bigint").alias("rows"),
                  *[share(F.col("latency_ms") < x).alias(f"_lo{i}") for i, x in enumerate(v)],
                  *[share(F.col("latency_ms") <= x).alias(f"_hi{i}") for i, x in enumerate(v)]))
    ok = [(F.col(f"_lo{i}") < F.col(f"_hi{i}")) & F.lit(float(q)).between(F.col(f"_lo{i}") - rank_error, F.col(f"_hi{i}") + rank_error)
          for i, q in enumerate(quantiles)]
    return ranks.select("service", "rows", F.array(*ok).alias("within"))


def service_percentiles(freq: DataFrame, service: str, quantiles=REPORT_QUANTILES) -> DataFrame:
    """Percentiles of one service over the whole rollup (parameter equality filter)."""
    return percentiles_by_rank(freq.where(F.col("service") == F.lit(service)), ["service"], quantiles=quantiles)


def split_percentiles(df: DataFrame, quantiles=REPORT_QUANTILES, col: str = "percentiles",
                      decimals: int | None = None) -> DataFrame:
    """Array column → one double column per level (``p50``, ``p90``, ``p99``), optionally rounded
    (interpolation is ``lo + (hi - lo) * d``; engines differ in the last bits of that product)."""
    names = ["p" + format(q * 100, "g").replace(".", "_") for q in quantiles]
    others = [c for c in df.columns if c != col]
    vals = [F.col(col)[i].cast("double") for i in range(len(names))]
    if decimals is not None:
        vals = [F.round(v, decimals) for v in vals]
    return df.select(*others, *[v.alias(n) for v, n in zip(vals, names)])


def service_totals(rollup: DataFrame) -> DataFrame:
    return (rollup.groupBy("service")
            .agg(F.sum("total_count").cast("bigint").alias("total"),
                 F.sum("error_count").cast("bigint").alias("errors"))
            .orderBy("service"))


def avg_latency(rollup: DataFrame, minutes=None, as_of=None) -> DataFrame:
    """Mean latency per service from the stored sums: ``sum(latency_sum) / sum(total_count)``."""
    return (in_window(rollup, minutes, as_of)
            .groupBy("service")
            .agg((F.sum("latency_sum") / F.sum("total_count")).alias("avg_latency_ms"))
            .orderBy("service"))


def rollup_total(rollup: DataFrame) -> DataFrame:
    return rollup.agg(F.sum("total_count").cast("bigint").alias("total"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def latest_minutes(rollup: DataFrame, n: int = 6, minutes=None, as_of=None) -> DataFrame:
    """Dashboard view: the ``n`` newest minutes of throughput, newest first."""
    return (in_window(rollup, minutes, as_of)
            .groupBy(F.col("minute").alias("time"))
            .agg(F.sum("total_count").cast("bigint").alias("count"))
            .orderBy(F.desc("time"))
            .limit(n))
