"""Order-dependent helpers that stay parallel when one series holds most of the rows.

A window ``partition by series order by ts`` sends a whole series to one task; if one series
holds a third of the data, so does that task.  These helpers cut every series into time slices,
do the ordered work inside each (series, slice), and stitch slices together through a per-slice
summary table whose size is (series × slices), not rows.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F


def _slice(ts: str, slice_unit: str) -> Column:
    return F.date_trunc(slice_unit, F.col(ts))


def running_count(df: DataFrame, series: list[str], order: list[str], ts: str,
                  out: str = "running_count", slice_unit: str = "minute") -> DataFrame:
    """1-based position of each row within its series in ``order`` (row_number), computed as
    position inside its time slice plus the number of rows in earlier slices of the series.
    ``order`` must start with ``ts`` so slices are ordered consistently with rows."""
    sliced = df.withColumn("_slice", _slice(ts, slice_unit))
    per_slice = (sliced.groupBy(*series, "_slice").agg(F.count(F.lit(1)).alias("_n"))
                 .withColumn("_before", F.coalesce(F.sum("_n").over(
                     Window.partitionBy(*series).orderBy("_slice")
                     .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
                 .drop("_n"))
    inside = F.row_number().over(Window.partitionBy(*series, "_slice").orderBy(*order))
    return (sliced.withColumn("_inside", inside)
            .join(per_slice, [*series, "_slice"], "inner")
            .withColumn(out, F.col("_before") + F.col("_inside"))
            .drop("_slice", "_inside", "_before"))


def previous_value(df: DataFrame, series: list[str], ts: str, value: str,
                   out: str = "prev_value", slice_unit: str = "minute") -> DataFrame:
    """Value of the previous sample (by ``ts``) in the same series; null for the first sample.

    Inside a slice this is ``lag``; for the first sample of a slice it is the last value of the
    nearest earlier non-empty slice, found in the (series × slice) summary.  Equal timestamps are
    ordered by value, so a counter sampled twice at one instant does not seem reset.  Null series
    or ``ts`` values form groups of their own; no row is lost."""
    sliced = df.withColumn("_slice", _slice(ts, slice_unit))
    w = Window.partitionBy(*series, "_slice").orderBy(ts, value)
    # One ordered pass per (series, slice): the previous value inside the slice, and whether the
    # row is the slice's last.  The slice summary comes from the same pass; as it is joined back,
    # the pass runs twice.  ``metrics.counter_rate`` needs no rows and works on the summary alone.
    ranked = (sliced.withColumn("_lag", F.lag(F.col(value)).over(w))
              .withColumn("_is_last", F.lead(F.lit(1)).over(w).isNull()))
    edges = (ranked.where("_is_last").select(*series, "_slice", F.col(value).alias("_last"))
             .withColumn("_carry", F.lag("_last").over(Window.partitionBy(*series).orderBy("_slice")))
             .drop("_last"))
    keys = [*series, "_slice"]
    edges = edges.select(*[F.col(c).alias(f"_e{i}") for i, c in enumerate(keys)], "_carry")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_e{i}")) for i, c in enumerate(keys)])
    return (ranked.join(edges, same, "inner")
            .withColumn(out, F.coalesce(F.col("_lag"), F.col("_carry")))
            .drop("_slice", "_lag", "_carry", "_is_last", *[f"_e{i}" for i in range(len(keys))]))


def _same(left: DataFrame, keys: list[str], prefix: str) -> Column:
    return reduce(and_, [left[c].eqNullSafe(F.col(f"{prefix}{i}")) for i, c in enumerate(keys)])


def _renamed(df: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    for i, c in enumerate(keys):
        df = df.withColumnRenamed(c, f"{prefix}{i}")
    return df


def running_totals(df: DataFrame, series: list[str], at: str, sums: list[str], block: int,
                   following: str | None = None, maxima: tuple[str, ...] = ()) -> DataFrame:
    """Replace each column of ``sums`` by its running total in the series up to the row, each of ``maxima`` by
    its running maximum, and add ``following``: ``at`` of the series' next row (null for the last).

    ``at`` is a whole number, distinct within a series.  Rows are ordered inside blocks of ``block``
    units of it; what lies before a block, and the row after it, come from the summary of blocks.
    """
    keys = [*series, "_block"]
    cut = df.withColumn("_block", F.col(at) - F.pmod(F.col(at), F.lit(block)))
    ordered = Window.partitionBy(*series).orderBy("_block")
    ahead = ordered.rowsBetween(Window.unboundedPreceding, -1)
    blocks = (cut.groupBy(*keys).agg(*[F.sum(c).alias(f"_t{i}") for i, c in enumerate(sums)],
                                     *[F.max(c).alias(f"_m{i}") for i, c in enumerate(maxima)], F.min(at).alias("_first"))
              .select(*keys, *[F.coalesce(F.sum(f"_t{i}").over(ahead), F.lit(0)).alias(f"_b{i}") for i in range(len(sums))],
                      *[F.max(f"_m{i}").over(ahead).alias(f"_h{i}") for i in range(len(maxima))],
                      F.lead("_first").over(ordered).alias("_after")))
    inside = Window.partitionBy(*keys).orderBy(at)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({c: F.sum(c).over(upto) for c in sums} | {c: F.max(c).over(upto) for c in maxima}
                            | {"_next": F.lead(at).over(inside)})
    out = local.join(_renamed(blocks, keys, "_k"), _same(local, keys, "_k"))
    out = out.withColumns({c: F.col(c) + F.col(f"_b{i}") for i, c in enumerate(sums)}
                          | {c: F.greatest(c, f"_h{i}") for i, c in enumerate(maxima)})
    if following:
        out = out.withColumn(following, F.coalesce("_next", "_after"))
    return out.drop("_block", "_next", "_after", *[f"_k{i}" for i in range(len(keys))], *[f"_b{i}" for i in range(len(sums))],
                    *[f"_h{i}" for i in range(len(maxima))])


def carried_value(df: DataFrame, series: list[str], order: list[str], ts: str, value: str, out: str,
                  slice_unit: str = "hour") -> DataFrame:
    """Newest non-null ``value`` at or before each row of its series in ``order`` (which starts with
    ``ts``); null before the first.

    Rows are ordered inside time slices; what an earlier slice leaves comes from the summary of one
    row per series and slice."""
    keys = [*series, "_slice"]
    sliced = df.withColumn("_slice", _slice(ts, slice_unit))
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], F.col(value).alias("v"))
    left = (sliced.groupBy(*keys).agg(F.max(F.when(F.col(value).isNotNull(), place))["v"].alias("_v"))
            .select(*keys, F.last("_v", ignorenulls=True).over(
                Window.partitionBy(*series).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)).alias("_carry")))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = sliced.withColumn("_seen", F.last(value, ignorenulls=True).over(inside))
    return (local.join(_renamed(left, keys, "_k"), _same(local, keys, "_k"))
            .withColumn(out, F.coalesce("_seen", "_carry")).drop("_slice", "_seen", "_carry", *[f"_k{i}" for i in range(len(keys))]))
