"""Registered plans for table lifecycle and streaming ingest, with their SQL oracle text.

The streaming plans write the messages derived from ``events`` as files, run the ingest stream
over them (``availableNow``, one file per micro-batch, each file spanning the whole month so every
batch carries late rows), and return what a reader of the tables sees.  Each run uses a new
folder below the shared checkpoint root.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from logroll.operators.classify import classify, valid_rows
from logroll.operators.retention import daily_counts, retain
from logroll.operators.rollup import latency_frequencies, merge_rollup, rollup_1m
from logroll.plans.common import LOG_COLS_SQL, LOGS_SQL, ROLLUP_SQL, events, ntz
from logroll.plans.ingest import _REJECTED
from logroll.plans.reports import as_of, logs
from logroll.schemas import GARBAGE_TEXT, LOG_TOPIC
from logroll.session import scratch_dir
from logroll.sources.events import wire_messages
from logroll.sources.tables import LogStore
from logroll.streaming.ingest import InjectedFailure, IngestJob, file_source, start_ingest
from logroll.streaming.replay import replay_dlq
from logroll.streaming.stateful import first_deliveries, start_window_state

SOURCE_FILES = 4
RECOVERED = ('{"timestamp":"2024-01-15T00:00:00.000Z","level":"WARN","service":"recovered","host":"host-00",'
             '"traceId":"trace-recovered","statusCode":202,"latencyMs":7,"message":"mended"}')
COUNTERS = ["minute", "service", "level", "total_count", "error_count", "latency_sum"]


def q_retention_survivors(spark, sf_dir):
    lg = logs(spark, sf_dir)
    return ntz(retain(lg, as_of(lg)))


def q_daily_partition_counts(spark, sf_dir):
    """Write the log rows as a day-partitioned table, then count per partition from the table."""
    store = LogStore(spark, scratch_dir(spark, "daily"))
    store.write_logs(logs(spark, sf_dir), batch_id=0)
    return daily_counts(store.logs(public=False))


def q_rollup_compacted(spark, sf_dir):
    """Three batches of partial rollups, all days before the newest compacted, then a late batch
    for old days arrives; the reader merges compacted and live rows."""
    store = LogStore(spark, scratch_dir(spark, "compact"))
    lg = logs(spark, sf_dir, ["event_id"])
    for b in range(3):
        part = lg.where(F.col("event_id") % 4 == b)
        store.write_rollup(rollup_1m(part), b)
        store.write_frequencies(latency_frequencies(part), b)
    newest = store.rollup().agg(F.max("minute")).first()[0]
    store.compact(newest)
    late = lg.where(F.col("event_id") % 4 == 3)          # arrives after the compaction
    store.write_rollup(rollup_1m(late), 3)
    store.write_frequencies(latency_frequencies(late), 3)
    return ntz(store.rollup(merged=True).select(*COUNTERS))


def q_rollup_catalog(spark, sf_dir):
    """What SQL users read: the catalog's view over compacted and live rows, after batches, a compaction whose
    folded batches are deleted, a late batch, and a second compaction that is not vacuumed."""
    store, db = LogStore(spark, scratch_dir(spark, "catalog")), f"logs_{uuid.uuid4().hex[:12]}"
    store.create_tables(db)
    lg = logs(spark, sf_dir, ["event_id"])
    newest = lg.agg(F.max("timestamp")).first()[0]
    mid = lg.agg(F.percentile_approx("timestamp", 0.5)).first()[0]
    for b in range(3):
        store.write_rollup(rollup_1m(lg.where(F.col("event_id") % 4 == b)), b)
    store.compact(mid, ("logs_1m",))
    store.write_rollup(rollup_1m(lg.where(F.col("event_id") % 4 == 3)), 3)      # late rows of compacted days too
    store.compact(newest, ("logs_1m",))
    store.vacuum(("logs_1m",), database=db)
    return ntz(merge_rollup(spark.table(f"{db}.logs_1m_all").drop("latency_quantiles")).select(*COUNTERS))


def _drain(spark, base, job, max_files=None, prepare=lambda messages: messages):
    """Run the ingest stream over what is in ``source`` (availableNow) until it stops.  After an
    injected failure, restart from the checkpoint: the failed batch replays with its batch_id."""
    def run():
        start_ingest(prepare(file_source(spark, f"{base}/source", max_files_per_trigger=max_files)), job,
                     f"{base}/checkpoint", available_now=True).awaitTermination()
    try:
        run()
    except Exception as e:  # noqa: BLE001 - the injected failure surfaces as a query exception
        if InjectedFailure.__name__ not in str(e):
            raise
        run()


def _run_stream(spark, sf_dir, fail_after=None, arrivals=None):
    """Feed the messages derived from ``events`` to the ingest stream through a file source.

    By default they are spread round-robin over files (a multiple of four that follows
    ``spark.sql.shuffle.partitions``, so file sizes stay bounded as the data grows) and read in
    four micro-batches, each spanning the whole month.  With ``arrivals`` (row predicates), each
    group of messages is written and drained in turn, so it forms its own micro-batch."""
    base = scratch_dir(spark, "stream")
    rows = events(spark, sf_dir)
    msgs = wire_messages(rows)
    store = LogStore(spark, f"{base}/tables")
    # One job object for the whole run (one "process"): its counters continue across restarts of
    # the query; an injected failure fires once.
    job = IngestJob(store, fail_after=fail_after)
    if arrivals:
        for cond in arrivals:
            msgs.where(cond).write.mode("append").parquet(f"{base}/source")
            _drain(spark, base, job)
        return store
    per_batch = max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "8")) // SOURCE_FILES)
    # The narrow rows are dealt out, and each task makes the messages of its file.
    wire_messages(rows.repartition(per_batch * SOURCE_FILES)).write.parquet(f"{base}/source")
    _drain(spark, base, job, max_files=per_batch)
    return store


def q_stream_rollup(spark, sf_dir):
    store = _run_stream(spark, sf_dir)
    return ntz(store.rollup(merged=True).select(*COUNTERS))


def q_stream_late(spark, sf_dir):
    """The second half of the month arrives first, then the first half: with no watermark every
    late row still lands in its own minute."""
    mid = F.lit("2024-01-16 00:00:00").cast("timestamp")
    store = _run_stream(spark, sf_dir, arrivals=[F.col("timestamp") >= mid, F.col("timestamp") < mid])
    return ntz(store.rollup(merged=True).select(*COUNTERS))


def q_stream_all_rejected(spark, sf_dir):
    """A first micro-batch holding only rejected messages still commits; the next batch follows.
    Result: after each batch, the cumulative messages consumed and valid rows written."""
    bad = F.col("offset") % 100 < 4
    store = _run_stream(spark, sf_dir, arrivals=[bad, ~bad])
    m = store.metrics()
    return (m.groupBy("batch_id")
            .agg(F.max(F.when(F.col("metric") == "pipeline_messages_consumed_total", F.col("value"))).alias("consumed"),
                 F.max(F.when(F.col("metric") == "pipeline_batch_size_records_sum", F.col("value"))).alias("valid")))


def q_stream_replay(spark, sf_dir):
    """Batch 1 fails after its raw rows are written; the restarted query replays it."""
    store = _run_stream(spark, sf_dir, fail_after=("logs_1m", 1))
    return ntz(store.logs())


def q_stream_dlq(spark, sf_dir):
    store = _run_stream(spark, sf_dir, fail_after=("logs", 2))
    return store.dlq().select("partition", "offset", "reason_code", "reason", "payload")


def q_stream_metrics(spark, sf_dir):
    """The pipeline's own counters after the stream: newest value of each series."""
    m = _run_stream(spark, sf_dir).metrics().where(F.col("metric").isin(
        "pipeline_messages_consumed_total", "pipeline_messages_dlq_total", "pipeline_committed_offset",
        "pipeline_batch_size_records_sum"))
    label = F.coalesce(F.col("labels")["reason"], F.col("labels")["partition"], F.col("labels")["topic"], F.lit(""))
    return m.groupBy("metric", label.alias("label")).agg(F.max_by("value", "batch_id").alias("value"))


def q_stream_redelivery(spark, sf_dir):
    """Two thirds of the topic arrive, some messages twice; after a restart the whole topic is delivered
    again, which fills the gaps.  Every message counts once."""
    base = scratch_dir(spark, "redelivery")
    msgs = wire_messages(events(spark, sf_dir))
    job = IngestJob(LogStore(spark, f"{base}/tables"))
    early = msgs.where(F.col("offset") % 3 != 0)
    for arrival in (early.unionByName(early.where(F.col("offset") % 5 == 0)), msgs):
        arrival.write.mode("append").parquet(f"{base}/source")
        _drain(spark, base, job, prepare=first_deliveries)
    return ntz(job.store.logs())


def q_stream_window_state(spark, sf_dir):
    """Counts per minute from the state store: the second half of the month first, then, after a
    restart, the first half."""
    base = scratch_dir(spark, "window-state")
    msgs, store = wire_messages(events(spark, sf_dir)), LogStore(spark, f"{base}/tables")
    mid = F.lit("2024-01-16 00:00:00").cast("timestamp")
    for cond in (F.col("timestamp") >= mid, F.col("timestamp") < mid):
        msgs.where(cond).write.mode("append").parquet(f"{base}/source")
        logs = valid_rows(classify(file_source(spark, f"{base}/source")))
        start_window_state(logs, store, f"{base}/checkpoint", available_now=True).awaitTermination()
    return ntz(store.window_state().select(*COUNTERS))


def q_dlq_replay(spark, sf_dir):
    """The stream's dead letters are replayed with a fix for one kind of payload, twice; raw rows after."""
    store = _run_stream(spark, sf_dir)
    fix = lambda text: F.when(text == GARBAGE_TEXT, F.lit(RECOVERED)).otherwise(text)       # noqa: E731
    replay_dlq(store, fix)
    replay_dlq(store, fix)
    return ntz(store.logs())


def q_dedup_offsets(spark, sf_dir):
    """A backfill that redelivers part of the topic: duplicates by (topic, partition, offset) are
    dropped before classification, so each message counts once."""
    msgs = wire_messages(events(spark, sf_dir))
    redelivered = msgs.unionByName(msgs.where(F.col("offset") % 7 == 0))
    unique = redelivered.dropDuplicates(["topic", "partition", "offset"])
    return ntz(valid_rows(classify(unique)))


_VALID = f"WITH logs AS ({LOGS_SQL}) SELECT {LOG_COLS_SQL} FROM logs WHERE event_id % 100 >= 4"
_VALID_ROLLUP = f"""WITH logs AS (SELECT * FROM ({LOGS_SQL}) WHERE event_id % 100 >= 4), rollup AS ({ROLLUP_SQL})
                    SELECT * FROM rollup"""

SQL = {
    "retention_survivors": f"""WITH logs AS ({LOGS_SQL})
        SELECT {LOG_COLS_SQL} FROM logs
        WHERE date_trunc('second', timestamp) + INTERVAL 7 DAY > (SELECT max(timestamp) FROM logs)""",
    "daily_partition_counts": f"""WITH logs AS ({LOGS_SQL})
        SELECT CAST(timestamp AS DATE) AS event_date, count(*) AS rows FROM logs GROUP BY 1""",
    "rollup_compacted": f"WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL}) SELECT * FROM rollup",
    "rollup_catalog": f"WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL}) SELECT * FROM rollup",
    "stream_rollup": _VALID_ROLLUP,
    "stream_replay": _VALID,
    "stream_late": _VALID_ROLLUP,
    "stream_all_rejected": """
        SELECT CAST(0 AS BIGINT) AS batch_id, CAST(count(*) AS DOUBLE) AS consumed, CAST(0 AS DOUBLE) AS valid
        FROM events WHERE event_id % 100 < 4
        UNION ALL
        SELECT CAST(1 AS BIGINT), CAST(count(*) AS DOUBLE), CAST(count(*) FILTER (WHERE event_id % 100 >= 4) AS DOUBLE)
        FROM events""",
    "stream_dlq": f"SELECT partition, \"offset\", reason_code, reason, payload FROM ({_REJECTED})",
    "stream_metrics": f"""
        SELECT 'pipeline_messages_consumed_total' AS metric, '{LOG_TOPIC}' AS label, CAST(count(*) AS DOUBLE) AS value
        FROM events
        UNION ALL SELECT 'pipeline_messages_dlq_total', reason_code, CAST(count(*) AS DOUBLE) FROM ({_REJECTED})
                  GROUP BY 2
        UNION ALL SELECT 'pipeline_batch_size_records_sum', '', CAST(count(*) AS DOUBLE) FROM events
                  WHERE event_id % 100 >= 4
        UNION ALL SELECT 'pipeline_committed_offset', CAST(user_id % 4 AS VARCHAR), CAST(max(event_id) + 1 AS DOUBLE)
                  FROM events GROUP BY 2""",
    "dedup_offsets": _VALID,
    "stream_redelivery": _VALID,
    "stream_window_state": _VALID_ROLLUP,
    "dlq_replay": f"""{_VALID} UNION ALL
        SELECT TIMESTAMP '2024-01-15 00:00:00', 'WARN', 'recovered', 'host-00', 'trace-recovered', 202, 7, 'mended'
        FROM events WHERE event_id % 100 = 0""",
}

QUERIES = {
    "retention_survivors": q_retention_survivors,
    "daily_partition_counts": q_daily_partition_counts,
    "rollup_compacted": q_rollup_compacted,
    "rollup_catalog": q_rollup_catalog,
    "stream_rollup": q_stream_rollup,
    "stream_replay": q_stream_replay,
    "stream_late": q_stream_late,
    "stream_all_rejected": q_stream_all_rejected,
    "stream_dlq": q_stream_dlq,
    "stream_metrics": q_stream_metrics,
    "dedup_offsets": q_dedup_offsets,
    "stream_redelivery": q_stream_redelivery,
    "stream_window_state": q_stream_window_state,
    "dlq_replay": q_dlq_replay,
}

