"""Table schemas and the fixed values results depend on."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the pipeline being replaced, or results differ).
# ---------------------------------------------------------------------------------------------
LEVELS = ["DEBUG", "INFO", "WARN", "ERROR", "FATAL"]
REASON_EMPTY = "EMPTY_KAFKA_PAYLOAD"
REASON_BAD_JSON = "INVALID_JSON_STRING_FORMAT"
REASON_SCHEMA = "SCHEMA_VIOLATION"
STATUS_MIN, STATUS_MAX = 100, 599
ERROR_STATUS = 500                      # error_count counts status_code >= 500; level is not read
DEFAULT_WINDOW_MINUTES = 15
REPORT_QUANTILES = [0.5, 0.9, 0.99]
TOP_SERVICES = 10
RETENTION_DAYS = 7
LOG_TOPIC = "log-events"
DLQ_TOPIC = "log-events-dlq"
INSERT_DURATION_BOUNDS = [0.05, 0.1, 0.25, 0.5, 1, 2.5, 5]
BATCH_SIZE_BOUNDS = [100, 500, 1000, 2500, 5000, 10000]
MAX_SAFE_INTEGER = 9007199254740991     # 2**53 - 1: largest integer a JSON number holds exactly
# Two garbage payloads used as rejection fixtures.
GARBAGE_TEXT = "<html><body>504 Gateway Time-out</body></html>"
GARBAGE_SCHEMA = '{"note":"an object without any log field"}'
# Wire field names, in order.
WIRE_FIELDS = ["timestamp", "level", "service", "host", "traceId", "statusCode", "latencyMs", "message"]
# ---------------------------------------------------------------------------------------------

LOG_COLUMNS = ["timestamp", "level", "service", "host", "trace_id", "status_code", "latency_ms", "message"]

LOGS = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("level", T.StringType()),
    T.StructField("service", T.StringType()),
    T.StructField("host", T.StringType()),
    T.StructField("trace_id", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("latency_ms", T.LongType()),
    T.StructField("message", T.StringType()),
])

# Message as it arrives from a topic (also the file-source test double).
RAW_MESSAGE = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

ROLLUP_KEY = ["minute", "service", "level"]

METRICS = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("metric", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("value", T.DoubleType()),
])

# DDL of the tables (S7); partition columns last.
TABLE_DDL = {
    "logs": ("timestamp TIMESTAMP, level STRING, service STRING, host STRING, trace_id STRING, "
             "status_code INT, latency_ms BIGINT, message STRING, topic STRING, `partition` INT, "
             "`offset` BIGINT, event_date DATE, batch_id BIGINT", ["event_date", "batch_id"]),
    "logs_1m": ("minute TIMESTAMP, service STRING, level STRING, total_count BIGINT, error_count BIGINT, "
                "latency_sum BIGINT, latency_quantiles BINARY, event_date DATE, batch_id BIGINT",
                ["batch_id"]),
    "logs_1m_freq": ("minute TIMESTAMP, service STRING, level STRING, latency_ms BIGINT, cnt BIGINT, "
                     "event_date DATE, batch_id BIGINT", ["batch_id"]),
    "dlq": ("rejected_at TIMESTAMP, reason STRING, payload STRING, reason_code STRING, topic STRING, "
            "`partition` INT, `offset` BIGINT, batch_id BIGINT", ["batch_id"]),
    "dlq_replayed": ("topic STRING, `partition` INT, `offset` BIGINT, batch_id BIGINT", ["batch_id"]),
    "logs_1m_state": ("minute TIMESTAMP, service STRING, level STRING, total_count BIGINT, error_count BIGINT, "
                      "latency_sum BIGINT, batch_id BIGINT", ["batch_id"]),
    "pipeline_counts": ("ts TIMESTAMP, topic STRING, `partition` INT, reason_code STRING, n BIGINT, max_offset BIGINT, "
                        "insert_seconds DOUBLE, batch_id BIGINT", ["batch_id"]),
    "pipeline_lag": ("ts TIMESTAMP, metric STRING, labels MAP<STRING, STRING>, value DOUBLE, event_date DATE",
                     ["event_date"]),
}

# Merged copies of closed days: the live table's columns, and the batches already inside.
COMPACTABLE = ["logs_1m", "logs_1m_freq"]
TABLE_DDL |= {f"{name}_compacted": (TABLE_DDL[name][0].replace(", event_date DATE, batch_id BIGINT",
                                                               ", through_batch_ids ARRAY<BIGINT>, event_date DATE"),
                                    ["event_date"]) for name in COMPACTABLE}
