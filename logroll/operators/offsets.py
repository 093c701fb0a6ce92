"""Offsets and consumer lag as data.

Offsets compare numerically (``LongType``), never as text.  A committed offset is the *next*
offset to read (max consumed + 1); a partition head is the next offset to be written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from logroll.operators.sequence import carried_value


def max_offsets(messages: DataFrame, keys=("topic", "partition")) -> DataFrame:
    """Highest offset per partition, whatever the arrival order, and the offset to commit."""
    return (messages.groupBy(*keys)
            .agg(F.max(F.col("offset").cast("bigint")).alias("max_offset"))
            .withColumn("next_offset", F.col("max_offset") + 1))


def partition_heads(messages: DataFrame, keys=("topic", "partition")) -> DataFrame:
    return messages.groupBy(*keys).agg((F.max(F.col("offset").cast("bigint")) + 1).alias("head"))


def consumer_lag(heads: DataFrame, committed: DataFrame, keys=("topic", "partition")) -> DataFrame:
    """``head - committed`` per partition; partitions without a committed offset are skipped.

    ``committed`` has one row per partition, so the join is small; the planner (AQE) broadcasts
    it once its measured size is under the broadcast threshold and shuffles otherwise."""
    return (heads.join(committed, list(keys), "inner")
            .select(*keys, "head", "committed", (F.col("head") - F.col("committed")).alias("lag")))


def caught_up(heads: DataFrame, committed: DataFrame, keys=("topic", "partition")) -> DataFrame:
    """One row: whether every partition's committed offset equals its head (a partition with no
    commit is *not* caught up), and how many partitions are behind."""
    behind = ~F.coalesce(F.col("committed") == F.col("head"), F.lit(False))
    return (heads.join(committed, list(keys), "left")
            .agg(F.coalesce(F.bool_and(~behind), F.lit(True)).alias("caught_up"),
                 F.sum(behind.cast("int")).cast("bigint").alias("partitions_behind")))


def count_by(df: DataFrame, key: str, out: str = "messages") -> DataFrame:
    """Counter keyed by one label (messages per topic, rejections per reason code, ...)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def lag_series(messages: DataFrame, step: str = "1 hour", keys=("topic", "partition")) -> DataFrame:
    """Lag per partition over time for a consumer that commits once per ``step``, one step
    behind: ``head`` is the partition head at the end of each step, ``lag`` the head minus the
    head of the previous step.  Messages are aggregated per (partition, step) first, so the ordered
    window runs over one row per step, not per message."""
    per = (messages.groupBy(*keys, F.window("timestamp", step).start.alias("time"))
           .agg((F.max(F.col("offset").cast("bigint")) + 1).alias("_head_in")))
    w = Window.partitionBy(*keys).orderBy("time")
    head = F.max("_head_in").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (per.withColumn("head", head)
            .withColumn("lag", F.col("head") - F.coalesce(F.lag("head").over(w), F.lit(0)))
            .drop("_head_in"))


def lag_asof(heads: DataFrame, commits: DataFrame, keys=("topic", "partition"), slice_unit: str = "hour") -> DataFrame:
    """Lag at every head sample: ``head`` minus the newest committed offset at or before it.

    ``heads`` has (keys, ts, head), ``commits`` (keys, ts, committed).  Head samples before the first
    commit of their partition, or of partitions that never commit, have a null ``committed`` and
    ``lag``; a commit older than the first head counts; of commits at one instant the largest does, and
    a commit at a head's own instant is seen by it.  Both kinds of samples are one stream in order of
    time (a union, no range join), cut into time slices so that a busy partition is many tasks.
    """
    keys = list(keys)
    both = (heads.select(*keys, "ts", F.lit(1).alias("_kind"), F.col("head").cast("bigint").alias("head"),
                         F.lit(None).cast("bigint").alias("_committed"))
            .unionByName(commits.select(*keys, "ts", F.lit(0).alias("_kind"), F.lit(None).cast("bigint").alias("head"),
                                        F.col("committed").cast("bigint").alias("_committed"))))
    seen = carried_value(both, keys, ["ts", "_kind", "_committed"], "ts", "_committed", "committed", slice_unit)
    return (seen.where("_kind = 1").drop("_kind", "_committed")
            .withColumn("lag", F.col("head") - F.col("committed")).select(*keys, "ts", "head", "committed", "lag"))
