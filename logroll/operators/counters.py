"""The pipeline's own telemetry as cumulative series, derived from the counts of each batch.

A batch stores what it alone saw (messages by topic, partition and outcome); totals are running sums over the
stored batches.  No process holds a total: a restart does not reset a series, and a batch that is replayed, by
whichever process, replaces its own counts and so leaves every total as it was.

* ``pipeline_messages_consumed_total{topic}``, ``pipeline_messages_dlq_total{reason}`` — counters; the three
  reason codes are there from the first batch on, at zero where nothing was rejected;
* ``pipeline_batch_size_records``, ``pipeline_insert_duration_seconds`` — histograms (``_bucket{le}``, ``_sum``,
  ``_count``); a batch's sink duration is stored with the next batch, once it is known;
* ``pipeline_committed_offset{topic,partition}`` — gauge, the next offset to read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from logroll.operators.sequence import running_totals
from logroll.schemas import BATCH_SIZE_BOUNDS, INSERT_DURATION_BOUNDS, REASON_BAD_JSON, REASON_EMPTY, REASON_SCHEMA

REASONS = [REASON_EMPTY, REASON_BAD_JSON, REASON_SCHEMA]
#: Batches whose samples are ordered in one task; what lies before them comes from one row per block.
BLOCK = 4_096


def _sample(metric: str, label: str | None, tag: Column | None, value: Column) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(metric).alias("metric"), (F.lit(label) if label else none).alias("label"),
                    (tag if tag is not None else none).alias("tag"), value.cast("double").alias("value"))


def _observation(name: str, bounds: list, v: Column) -> list[Column]:
    """What one observation adds to a histogram; nothing where ``v`` is null."""
    seen = F.when(v.isNotNull(), 1.0).otherwise(0.0)
    return ([_sample(f"{name}_bucket", "le", F.lit(format(float(b), "g")), F.when(v <= b, 1.0).otherwise(0.0)) for b in bounds]
            + [_sample(f"{name}_bucket", "le", F.lit("+Inf"), seen), _sample(f"{name}_sum", None, None, F.coalesce(v, F.lit(0.0))),
               _sample(f"{name}_count", None, None, seen)])


def pipeline_samples(counts: DataFrame, block: int = BLOCK) -> DataFrame:
    """Samples ``ts, metric, labels, value, batch_id`` after every batch from the batches' stored counts."""
    of = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0))
    at = F.max("ts").alias("ts")
    by_batch = counts.groupBy("batch_id").agg(
        at, of(F.col("reason_code").isNull()).cast("double").alias("valid"), F.max("insert_seconds").alias("seconds"),
        *[of(F.col("reason_code") == r).alias(r) for r in REASONS])
    added = (by_batch.select("batch_id", "ts", F.inline(F.array(
        *[_sample("pipeline_messages_dlq_total", "reason", F.lit(r), F.col(r)) for r in REASONS],
        *_observation("pipeline_batch_size_records", BATCH_SIZE_BOUNDS, F.col("valid")),
        *_observation("pipeline_insert_duration_seconds", INSERT_DURATION_BOUNDS, F.col("seconds")))))
        .unionByName(counts.groupBy("batch_id", "topic").agg(at, F.sum("n").alias("n")).select(
            "batch_id", "ts", F.inline(F.array(_sample("pipeline_messages_consumed_total", "topic", F.col("topic"), F.col("n")))))))
    totals = running_totals(added, ["metric", "label", "tag"], "batch_id", ["value"], block)
    labels = F.when(F.col("label").isNotNull(), F.create_map("label", "tag")).otherwise(F.create_map().cast("map<string,string>"))
    heads = running_totals(
        counts.groupBy("batch_id", "topic", "partition").agg(at, (F.max("max_offset") + 1).cast("double").alias("value")),
        ["topic", "partition"], "batch_id", [], block, maxima=("value",))
    place = F.create_map(F.lit("topic"), F.col("topic"), F.lit("partition"), F.col("partition").cast("string"))
    return (totals.select("ts", "metric", labels.alias("labels"), "value", "batch_id")
            .unionByName(heads.select("ts", F.lit("pipeline_committed_offset").alias("metric"), place.alias("labels"), "value", "batch_id")))
