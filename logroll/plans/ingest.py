"""Registered ingest plans: raw topic messages (derived from ``events``) → classification, valid
rows, dead-letter envelopes, offsets and lag — with their SQL oracle text.

The oracle never parses JSON: the fixture builds each message's fault from ``event_id``, so the
expected outcome follows from the same arithmetic.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from logroll.operators import offsets as O
from logroll.operators.classify import classify, dlq_envelopes, rejections, valid_rows
from logroll.plans.common import LOG_COLS_SQL, LOGS_SQL, events, ntz
from logroll.schemas import DLQ_TOPIC, GARBAGE_SCHEMA, GARBAGE_TEXT, LOG_TOPIC
from logroll.sources.events import rule_messages, wire_messages

REJECTED_AT = "2024-02-01 00:00:00"     # fixed processing time, so envelopes are reproducible
COMMIT_CUTOFF = "2024-01-20 00:00:00"   # consumer has committed messages before this instant...
UNCOMMITTED_PARTITION = 3               # ...except on this partition, which never committed


def _classified(spark, sf_dir):
    return classify(wire_messages(events(spark, sf_dir)))


def q_classify_counts(spark, sf_dir):
    c = _classified(spark, sf_dir)
    return O.count_by(c.withColumn("outcome", F.coalesce("reason_code", F.lit("VALID"))), "outcome")


def q_classify_rules(spark, sf_dir):
    c = classify(rule_messages(events(spark, sf_dir)))
    return ntz(c.select("offset", "reason_code", "reason", "timestamp", "status_code", "latency_ms"))


def q_valid_rows(spark, sf_dir):
    return ntz(valid_rows(_classified(spark, sf_dir)))


def q_dlq_envelopes(spark, sf_dir):
    rej = rejections(_classified(spark, sf_dir), keep=["partition", "offset"])
    return ntz(dlq_envelopes(rej, REJECTED_AT))


def q_dlq_by_reason(spark, sf_dir):
    return O.count_by(rejections(_classified(spark, sf_dir)), "reason_code", "rejected")


def q_max_offset(spark, sf_dir):
    return O.max_offsets(wire_messages(events(spark, sf_dir)))


def q_consumed_by_topic(spark, sf_dir):
    """Messages per topic across the pipeline: the input topic and the dead-letter topic."""
    msgs = wire_messages(events(spark, sf_dir))
    dlq = dlq_envelopes(rejections(classify(msgs)), REJECTED_AT).select(F.lit(DLQ_TOPIC).alias("topic"))
    return O.count_by(msgs.select("topic").unionByName(dlq), "topic")


def _heads_committed(spark, sf_dir):
    msgs = wire_messages(events(spark, sf_dir))
    heads = O.partition_heads(msgs)
    done = msgs.where((F.col("timestamp") < F.lit(COMMIT_CUTOFF).cast("timestamp"))
                      & (F.col("partition") != UNCOMMITTED_PARTITION))
    committed = O.max_offsets(done).select("topic", "partition", F.col("next_offset").alias("committed"))
    return heads, committed


def q_consumer_lag(spark, sf_dir):
    return O.consumer_lag(*_heads_committed(spark, sf_dir))


def q_caught_up(spark, sf_dir):
    return O.caught_up(*_heads_committed(spark, sf_dir))


_OUTCOME = f"""CASE event_id % 100 WHEN 0 THEN 'INVALID_JSON_STRING_FORMAT' WHEN 1 THEN 'SCHEMA_VIOLATION'
               WHEN 2 THEN 'EMPTY_KAFKA_PAYLOAD' WHEN 3 THEN 'EMPTY_KAFKA_PAYLOAD' ELSE 'VALID' END"""
_MISSING_ALL = ("SCHEMA_VIOLATION: " + ", ".join(
    f"{f}:required" for f in ["timestamp", "level", "service", "host", "traceId", "statusCode",
                              "latencyMs", "message"]))
_REJECTED = f"""
SELECT CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset",
       CASE event_id % 100 WHEN 0 THEN 'INVALID_JSON_STRING_FORMAT' WHEN 1 THEN '{_MISSING_ALL}'
            ELSE 'EMPTY_KAFKA_PAYLOAD' END AS reason,
       CASE event_id % 100 WHEN 0 THEN 'INVALID_JSON_STRING_FORMAT' WHEN 1 THEN 'SCHEMA_VIOLATION'
            ELSE 'EMPTY_KAFKA_PAYLOAD' END AS reason_code,
       CASE event_id % 100 WHEN 0 THEN '{GARBAGE_TEXT}' WHEN 1 THEN '{GARBAGE_SCHEMA}' END AS payload
FROM events WHERE event_id % 100 < 4"""
_RULE = {
    0: "timestamp:datetime", 1: "level:enum", 2: "statusCode:range", 3: "statusCode:range",
    4: "statusCode:int", 5: "latencyMs:nonnegative", 6: "latencyMs:int", 7: "latencyMs:type",
    8: "service:min_length", 9: "host:min_length", 10: "traceId:min_length", 11: "timestamp:required",
    12: "message:required", 13: "message:type", 16: "timestamp:datetime",
    17: "statusCode:int, statusCode:range",
}
_RULE_CASE = "CASE event_id % 20 " + " ".join(
    f"WHEN {k} THEN 'SCHEMA_VIOLATION: {v}'" for k, v in _RULE.items()) + " END"
_HEADS = f"""SELECT '{LOG_TOPIC}' AS topic, CAST(user_id % 4 AS INTEGER) AS partition, max(event_id) + 1 AS head
             FROM events GROUP BY 2"""
_COMMITTED = f"""SELECT '{LOG_TOPIC}' AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
                        max(event_id) + 1 AS committed
                 FROM events WHERE ts < TIMESTAMP '{COMMIT_CUTOFF}' AND user_id % 4 <> {UNCOMMITTED_PARTITION}
                 GROUP BY 2"""

SQL = {
    "classify_counts": f"SELECT {_OUTCOME} AS outcome, count(*) AS messages FROM events GROUP BY 1",
    "classify_rules": f"""
        WITH logs AS ({LOGS_SQL}), r AS (SELECT *, {_RULE_CASE} AS reason FROM logs)
        SELECT event_id AS "offset", split_part(reason, ':', 1) AS reason_code, reason,
               CASE WHEN reason IS NULL THEN
                    CASE WHEN event_id % 20 = 18 THEN date_trunc('minute', timestamp) ELSE timestamp END
               END AS timestamp,
               CASE WHEN reason IS NULL THEN CASE WHEN event_id % 20 = 14 THEN 503 ELSE status_code END
               END AS status_code,
               CASE WHEN reason IS NULL THEN latency_ms END AS latency_ms
        FROM r""",
    "valid_rows": f"WITH logs AS ({LOGS_SQL}) SELECT {LOG_COLS_SQL} FROM logs WHERE event_id % 100 >= 4",
    "dlq_envelopes": f"""
        SELECT partition, "offset", reason_code, TIMESTAMP '{REJECTED_AT}' AS rejected_at, reason, payload,
               CAST(to_json({{'rejectedAt': '{REJECTED_AT.replace(' ', 'T')}.000Z', 'reason': reason,
                              'payload': payload}}) AS VARCHAR) AS value
        FROM ({_REJECTED})""",
    "dlq_by_reason": f"""SELECT reason_code, count(*) AS rejected FROM ({_REJECTED}) GROUP BY 1""",
    "max_offset": f"""SELECT '{LOG_TOPIC}' AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
                             max(event_id) AS max_offset, max(event_id) + 1 AS next_offset
                      FROM events GROUP BY 2""",
    "consumed_by_topic": f"""SELECT '{LOG_TOPIC}' AS topic, count(*) AS messages FROM events
                             UNION ALL
                             SELECT '{DLQ_TOPIC}', count(*) FROM events WHERE event_id % 100 < 4""",
    "consumer_lag": f"""SELECT h.topic, h.partition, head, committed, head - committed AS lag
                        FROM ({_HEADS}) h JOIN ({_COMMITTED}) c ON h.partition = c.partition""",
    "caught_up": f"""SELECT coalesce(bool_and(coalesce(c.committed = h.head, false)), true) AS caught_up,
                            CAST(sum(CASE WHEN coalesce(c.committed = h.head, false) THEN 0 ELSE 1 END) AS BIGINT)
                              AS partitions_behind
                     FROM ({_HEADS}) h LEFT JOIN ({_COMMITTED}) c ON h.partition = c.partition""",
}

QUERIES = {
    "classify_counts": q_classify_counts,
    "classify_rules": q_classify_rules,
    "valid_rows": q_valid_rows,
    "dlq_envelopes": q_dlq_envelopes,
    "dlq_by_reason": q_dlq_by_reason,
    "max_offset": q_max_offset,
    "consumed_by_topic": q_consumed_by_topic,
    "consumer_lag": q_consumer_lag,
    "caught_up": q_caught_up,
}
