"""Streaming ingest: raw messages → classified → five idempotent sinks per micro-batch.

    source (Kafka, or files with the same columns)
      └─ foreachBatch(batch, batch_id):
           classify once, persist (filled by the batch's counts)
           ├─ logs            valid rows + lineage          (overwrite partitions of batch_id)
           ├─ logs_1m         partial rollup with sketches   (same)
           ├─ logs_1m_freq    exact latency frequencies      (same)
           ├─ dlq             rejection envelopes            (same)
           └─ pipeline_counts counts of the batch alone     (same; accumulated at read)

Offsets are committed by the checkpoint only after the function returns, so a failure in any sink
replays the batch with the same ``batch_id``; each sink then replaces its own partitions: the
tables converge to exactly-once contents.  There is no watermark: a late row lands in its own
minute's partial rows, never dropped.  An all-rejected batch still commits and the stream moves on.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import time
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.util import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from logroll.operators.classify import classify, dlq_envelopes, rejections, valid_rows
from logroll.operators.rollup import latency_frequencies, rollup_1m
from logroll.schemas import LOG_COLUMNS, LOG_TOPIC, RAW_MESSAGE
from logroll.sources.tables import INGEST_SHIFT, LogStore

LINEAGE = ["topic", "partition", "offset"]

#: Bounds of a micro-batch unless the caller sets others: messages of a topic, files of a folder.
MAX_OFFSETS = 5_000_000
MAX_FILES = 1_000


def file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = MAX_FILES) -> DataFrame:
    """Test double of a topic: Parquet files with the message columns, read as a stream."""
    reader = spark.readStream.schema(RAW_MESSAGE).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str = LOG_TOPIC,
                 starting_offsets: str = "latest", max_offsets_per_trigger: int | None = MAX_OFFSETS,
                 min_offsets_per_trigger: int | None = None, max_trigger_delay: str | None = None,
                 min_partitions: int | None = None) -> DataFrame:
    """Topic subscription.  A new query starts at the latest offset; a restarted one resumes from
    its checkpoint.  ``max_offsets_per_trigger`` bounds a batch (back-pressure; None: no bound); with
    ``min_offsets_per_trigger`` + ``max_trigger_delay`` a batch waits for size or time, whichever
    comes first.  ``min_partitions`` splits offset ranges so a batch uses every core even when the
    topic has few partitions.  Needs the Kafka connector on the classpath (not available offline)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", "true"))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_offsets_per_trigger:
        reader = reader.option("minOffsetsPerTrigger", str(min_offsets_per_trigger))
    if max_trigger_delay:
        reader = reader.option("maxTriggerDelay", max_trigger_delay)
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load().select("key", "value", "topic", "partition", "offset", "timestamp")


def kafka_sink_options(df: DataFrame, bootstrap_servers: str, topic: str):
    """Publish rows whose ``value`` is the JSON text (e.g. dead-letter envelopes) to a topic, with
    all-replica acknowledgement and gzip, as a batch write.  A ``key`` column is published as the
    message key, so messages of one key stay in one partition."""
    key = [F.col("key").cast("binary")] if "key" in df.columns else []
    return (df.select(*key, F.col("value").cast("string").alias("value")).write.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap_servers).option("topic", topic)
            .option("kafka.acks", "all").option("kafka.compression.type", "gzip"))


def batch_counts(classified: DataFrame, insert_seconds: float | None = None) -> DataFrame:
    """One aggregation over the batch: messages and max offset per (topic, partition, reason code).
    Its size is bounded by topics × partitions × reason codes, not by rows.  ``insert_seconds`` is what
    the sinks of the batch before took."""
    return (classified.groupBy("topic", "partition", "reason_code")
            .agg(F.count(F.lit(1)).alias("n"), F.max("offset").alias("max_offset"))
            .select(F.current_timestamp().alias("ts"), "topic", "partition", "reason_code", "n", "max_offset",
                    F.lit(insert_seconds).cast("double").alias("insert_seconds")))


def sink_columns(classified: DataFrame) -> DataFrame:
    """What the sinks read of a classified batch: no message keys, and payloads of rejected messages only."""
    return classified.select(*LINEAGE, "reason", "reason_code",
                             F.when(F.col("reason").isNotNull(), F.col("payload")).alias("payload"), *LOG_COLUMNS)


class InjectedFailure(RuntimeError):
    """Raised by ``IngestJob`` when told to fail after a sink (crash-replay tests)."""


class IngestJob:
    """The ``foreachBatch`` function.

    The classified batch is cached once (filled by the job that writes the batch's counts), then the other
    sinks run as concurrent Spark jobs over it: they are independent, and each replaces only its own
    partitions.  Nothing is accumulated in the driver: totals are running sums over the stored counts.  If any sink fails the batch fails and is replayed whole.
    ``fail_after=(sink, batch_id)`` raises once right after that sink has been written (the other
    concurrent sinks may or may not have landed), to exercise replay."""

    def __init__(self, store: LogStore, sketch_k: int | None = None, fail_after: tuple[str, int] | None = None,
                 parallel: bool = True, dlq_topic: dict | None = None):
        """``dlq_topic={"bootstrap_servers": ..., "topic": ...}`` also publishes each envelope to a
        dead-letter topic (batch write, acks=all, gzip)."""
        self.dlq_topic = dlq_topic
        self._last_duration: float | None = None
        self.ingest_number = 0            # set from the checkpoint when the stream starts
        self.store = store
        self.sketch_k = sketch_k
        self.fail_after = fail_after
        self.parallel = parallel

    def _maybe_fail(self, sink: str, batch_id: int) -> None:
        if self.fail_after and self.fail_after == (sink, batch_id):
            self.fail_after = None
            raise InjectedFailure(f"injected failure after {sink} in batch {batch_id}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_batch, batch_id = batch_id, (self.ingest_number << INGEST_SHIFT) + batch_id
        classified = sink_columns(classify(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        valid = valid_rows(classified, keep=LINEAGE)
        rejected = rejections(classified, keep=LINEAGE)
        pool = ThreadPoolExecutor(max_workers=5) if self.parallel else None

        def submit(fn):
            if pool is None:
                fn()
                return None
            return pool.submit(inheritable_thread_target(spark)(fn))

        try:
            started = time.perf_counter()
            if self._last_duration is None:
                # First batch of this process: a replay keeps what its first run knew of the batch before.
                self._last_duration = self.store.insert_seconds(batch_id)
            # First job: the batch's counts (a few dozen rows: topics × partitions × reasons).  It
            # fills the cache, so the sinks below read classified rows instead of classifying again
            # (on a cluster, concurrent first readers of an uncached partition would each compute
            # it), and the same pass observes whether there is anything for them to write.
            seen, ok = Observation("batch"), F.col("reason_code").isNull()
            self.store.write_counts(batch_counts(classified, self._last_duration).observe(
                seen, F.sum(F.when(ok, F.col("n"))).alias("valid"), F.sum(F.when(~ok, F.col("n"))).alias("rejected")), batch_id)
            n_valid, n_rejected = seen.get["valid"] or 0, seen.get["rejected"] or 0
            self._maybe_fail("pipeline_counts", stream_batch)
            # Rows are rebalanced by their bytes, so each sink writes files of the advisory partition size
            # in as many tasks as the batch needs, one for a small batch.
            writes = {
                "logs_1m": lambda: self.store.write_rollup(rollup_1m(valid, k=self.sketch_k).hint("rebalance"), batch_id),
                "logs_1m_freq": lambda: self.store.write_frequencies(latency_frequencies(valid).hint("rebalance"), batch_id),
                "logs": lambda: self.store.write_logs(valid, batch_id),
                "dlq": lambda: self.store.write_dlq(dlq_envelopes(rejected.hint("rebalance")), batch_id),
            }

            def sink(name, write):
                def go():
                    write()
                    self._maybe_fail(name, stream_batch)   # a failure between sinks: the rest may or may not land
                return go

            # A sink with no rows in this batch has nothing to replace: skip its job (a replay of
            # the batch makes the same decision, since classification is deterministic).
            empty = ({"logs", "logs_1m", "logs_1m_freq"} if n_valid == 0 else set()) | ({"dlq"} if n_rejected == 0 else set())
            futures = [submit(sink(name, write)) for name, write in writes.items() if name not in empty]
            if self.dlq_topic and n_rejected:
                futures.append(submit(lambda: kafka_sink_options(
                    dlq_envelopes(rejected), self.dlq_topic["bootstrap_servers"], self.dlq_topic["topic"]).save()))
            for fut in futures:
                if fut is not None:
                    fut.result()
            self._last_duration = time.perf_counter() - started
        finally:
            if pool is not None:
                pool.shutdown(wait=True)
            classified.unpersist()


def lag_samples(progress: dict) -> list[tuple]:
    """Consumer lag per topic partition from one ``StreamingQueryProgress`` (as a dict): the
    source's latest available offset minus the offset the query has processed up to.  Returns
    ``(metric, labels, value)`` samples; sources without per-partition offsets give none."""
    out = []
    for src in progress.get("sources", []):
        latest, end = src.get("latestOffset"), src.get("endOffset")
        if isinstance(latest, str):
            latest = json.loads(latest)
        if isinstance(end, str):
            end = json.loads(end)
        if not isinstance(latest, dict) or not isinstance(end, dict):
            continue
        for topic, parts in latest.items():
            if not isinstance(parts, dict):
                continue
            for part, head in parts.items():
                done = (end.get(topic) or {}).get(part)
                if done is not None:
                    out.append(("pipeline_consumer_lag_records", {"topic": topic, "partition": str(part)},
                                float(int(head) - int(done))))
    return out


class LagRecorder(StreamingQueryListener):
    """Records the consumer lag of a session's queries (``spark.streams.addListener(LagRecorder(store))``).

    Of each query's progress events, one every ``every_seconds`` gives its samples.  They are kept for a minute
    of event time, at most one row per topic partition and sample, and then written as one file of the day's
    partition, in a thread of its own so that no event waits for it.  The end of a query, or ``close``, writes
    what is kept.  A driver that dies loses at most that minute; lag is a gauge, nothing is derived from its sum.
    """

    def __init__(self, store: LogStore, every_seconds: float = 5.0):
        self.store = store
        self.every = dt.timedelta(seconds=every_seconds)
        self._last: dict[str, dt.datetime] = {}
        self._kept: list[tuple] = []
        self._minute: dt.datetime | None = None
        self._lock = threading.Lock()
        self._writer = ThreadPoolExecutor(max_workers=1)
        self._pending: list = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.observe(json.loads(event.progress.json))

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def observe(self, progress: dict) -> None:
        """Take the samples of one progress event (as a dict)."""
        at = dt.datetime.fromisoformat(progress["timestamp"].replace("Z", "+00:00"))
        query = progress.get("id", "")
        with self._lock:
            if query in self._last and at - self._last[query] < self.every:
                return
            samples = lag_samples(progress)
            if not samples:
                return
            self._last[query] = at
            minute = at.replace(second=0, microsecond=0)
            if self._minute is not None and minute != self._minute:
                self._hand_over()
            self._minute = minute
            self._kept += [(at, *s) for s in samples]

    def _hand_over(self) -> None:
        rows, self._kept = self._kept, []
        if rows:
            self._pending = [f for f in self._pending if not f.done() or f.exception()]
            self._pending.append(self._writer.submit(self.store.append_lag, rows))

    def flush(self) -> None:
        with self._lock:
            self._hand_over()

    def close(self) -> None:
        """Write what is kept and wait for it; raises if a write failed."""
        self.flush()
        pending, self._pending = self._pending, []
        for f in pending:
            f.result()


def start_ingest(source: DataFrame, job: IngestJob, checkpoint: str, available_now: bool = False,
                 processing_time: str = "1 second", name: str | None = None) -> StreamingQuery:
    """Start the pipeline.  Default trigger: a micro-batch every second (flush by time); the
    source's per-trigger cap bounds its size.  ``available_now`` drains what is there and stops
    (replay, backfill, graceful drain)."""
    job.ingest_number = job.store.ingest_number(checkpoint)
    writer = source.writeStream.foreachBatch(job).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()


def drain(query: StreamingQuery) -> None:
    """Graceful stop: process everything already available, then stop."""
    query.processAllAvailable()
    query.stop()
