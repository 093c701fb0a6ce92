"""Shared pieces of the registered plans and their SQL oracle text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from logroll.session import configure
from logroll.sources.events import read_table


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return read_table(spark, sf_dir, "events")


def ntz(df: DataFrame) -> DataFrame:
    """Timestamps as wall-clock UTC values without zone (the oracle's TIMESTAMP type)."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if isinstance(f.dataType, T.TimestampType) else F.col(f.name)
                       for f in df.schema.fields])


# Log rows derived from ``events`` (same text in Spark and DuckDB).
LOGS_SQL = """
SELECT date_trunc('millisecond', ts) AS timestamp,
       CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARN' ELSE 'INFO' END AS level,
       concat('svc-', CAST(user_id % 4 AS VARCHAR)) AS service,
       concat('host-', lpad(CAST(user_id % 10 + 1 AS VARCHAR), 2, '0')) AS host,
       concat('trace-', CAST(event_id AS VARCHAR)) AS trace_id,
       CAST(CASE event_type WHEN 'error' THEN 500 + event_id % 5 WHEN 'purchase' THEN 404 ELSE 200 END AS INTEGER)
         AS status_code,
       CAST(floor(value * 10) AS BIGINT) AS latency_ms,
       props AS message,
       event_id, user_id
FROM events"""

ROLLUP_SQL = """
SELECT date_trunc('minute', timestamp) AS minute, service, level,
       count(*) AS total_count,
       CAST(sum(CASE WHEN status_code >= 500 THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
       CAST(sum(latency_ms) AS BIGINT) AS latency_sum
FROM logs GROUP BY 1, 2, 3"""

LOG_COLS_SQL = "timestamp, level, service, host, trace_id, status_code, latency_ms, message"
