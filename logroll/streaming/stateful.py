"""Stateful variants of the stream: tumbling windows in the state store, and redelivered messages.

* ``start_window_state``  per-minute counts kept by Spark's state store, each batch upserting the
  minutes it touched (update mode), instead of partial rows per batch that readers merge.
* ``first_deliveries``    messages as they are delivered for the first time, whatever batch or run a
  copy comes in.

Both keep their state below the checkpoint; for large states set
``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider of Spark.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from logroll.schemas import ERROR_STATUS
from logroll.sources.tables import LogStore

#: Offsets of one partition that share a state: a busy partition is many states, each at most this wide.
OFFSETS_PER_STATE = 65_536


def window_counts(logs: DataFrame, watermark: str | None = None) -> DataFrame:
    """Counts per (minute, service, level) of a stream of log rows.

    Without a watermark no row is ever late and the state keeps every minute; with one (for example
    ``"7 days"``, the life of raw rows) minutes leave the state once it has passed them, and rows
    later than that are dropped by Spark.
    """
    rows = logs.withWatermark("timestamp", watermark) if watermark else logs
    return (rows.groupBy(F.window("timestamp", "1 minute").alias("w"), "service", "level")
            .agg(F.count(F.lit(1)).alias("total_count"),
                 F.sum(F.when(F.col("status_code") >= ERROR_STATUS, 1).otherwise(0)).cast("bigint").alias("error_count"),
                 F.sum("latency_ms").cast("bigint").alias("latency_sum"))
            .select(F.col("w.start").alias("minute"), "service", "level", "total_count", "error_count", "latency_sum"))


def start_window_state(logs: DataFrame, store: LogStore, checkpoint: str, available_now: bool = False,
                       processing_time: str = "1 second", watermark: str | None = None) -> StreamingQuery:
    """Start the stateful rollup of a stream of log rows.

    Update mode emits the new totals of each minute a batch touched; they are stored under the batch
    and the newest version of a key counts (``LogStore.window_state``), so a replayed batch replaces
    its own versions.  The table belongs to this checkpoint: with a new one, start an empty table.
    """
    def upsert(batch: DataFrame, batch_id: int) -> None:
        store.write_window_state(batch, batch_id)

    writer = window_counts(logs, watermark).writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def _ranges(starts: np.ndarray, ends: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted disjoint ranges after the offsets ``new`` (in none of them) are added."""
    starts, ends = np.concatenate([starts, new]), np.concatenate([ends, new])
    order = np.argsort(starts)
    starts, ends = starts[order], ends[order]
    opens = np.concatenate([[True], starts[1:] > ends[:-1] + 1])
    last = np.append(np.flatnonzero(opens)[1:] - 1, len(ends) - 1)
    return starts[opens], ends[last]


def _unseen(key, frames, state):
    starts, ends = (np.array(x, np.int64) for x in (state.get if state.exists else ([], [])))
    for pdf in frames:
        pdf = pdf.drop_duplicates("offset")
        at = pdf["offset"].to_numpy(np.int64)
        i = np.searchsorted(starts, at, side="right") - 1
        seen = np.zeros(len(at), bool)
        seen[i >= 0] = at[i >= 0] <= ends[i[i >= 0]]
        if not seen.all():
            starts, ends = _ranges(starts, ends, at[~seen])
            yield pdf[~seen].drop(columns="_block")
    state.update((starts.tolist(), ends.tolist()))


def first_deliveries(messages: DataFrame) -> DataFrame:
    """Messages (with topic, partition, offset) of a stream, each offset of a partition once.

    The state of a partition is the ranges of offsets seen so far: the high-water mark and the gaps
    below it, so a message that fills a gap still counts and a copy never does, however much later it
    comes.  Ranges are kept per block of offsets; a block that is complete is a single range.
    """
    cut = messages.withColumn("_block", F.floor(F.col("offset") / OFFSETS_PER_STATE))
    return cut.groupBy("topic", "partition", "_block").applyInPandasWithState(
        _unseen, messages.schema, "starts array<long>, ends array<long>", "append", "NoTimeout")
