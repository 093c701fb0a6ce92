"""Registered telemetry plans (dashboard panels as table operators) with their SQL oracle text.

Metric samples are derived from ``events``: a dead-letter counter per reason (``event_type``)
that resets every UTC midnight, per-service latency gauges, latency histograms, and the offsets of
the simulated topic.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from logroll.operators import metrics as M
from logroll.operators.offsets import lag_asof, lag_series
from logroll.plans.common import LOGS_SQL, events, ntz
from logroll.schemas import LOG_TOPIC
from logroll.sources.events import (dlq_counter_samples, latency_bucket_samples, logs_from_events, offset_samples,
                                    wire_messages)

LATENCY_BOUNDS = [50, 100, 250, 500, 1000, 2500, 5000]   # ms
DLQ_PREFIX = "pipeline_messages_dlq"
UNCOMMITTED = 3         # partition of the lag samples that never commits
DECIMALS = 9            # rates: engines add the series' doubles in different orders


def _counter(spark, sf_dir):
    return dlq_counter_samples(events(spark, sf_dir))


def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, DECIMALS) for c in cols})


def q_counter_rate(spark, sf_dir):
    return ntz(_rounded(M.counter_rate(_counter(spark, sf_dir), "1 hour"), "rate"))


def q_dlq_rate(spark, sf_dir):
    return ntz(_rounded(M.counter_rate(_counter(spark, sf_dir), "1 hour", by=["reason"]), "rate"))


def q_metric_total(spark, sf_dir):
    return M.metric_total(_counter(spark, sf_dir), DLQ_PREFIX)


def _latency_buckets(spark, sf_dir):
    lg = logs_from_events(events(spark, sf_dir))
    return M.histogram_buckets(lg, "latency_ms", LATENCY_BOUNDS, group=["service"])


def q_histogram_buckets(spark, sf_dir):
    return _latency_buckets(spark, sf_dir)


def q_histogram_quantile(spark, sf_dir):
    return M.histogram_quantile(_latency_buckets(spark, sf_dir), [0.5, 0.95], ["service"], out=["p50", "p95"])


def q_histogram_rate_quantile(spark, sf_dir):
    """Dashboard panel: p50 and p95 of latency per hour from the rates of cumulative bucket
    counters (scraped hourly)."""
    samples = latency_bucket_samples(events(spark, sf_dir), LATENCY_BOUNDS)
    return ntz(_rounded(M.histogram_rate_quantile(samples, "latency_ms_bucket", [0.5, 0.95], "1 hour",
                                                  out=["p50", "p95"]), "p50", "p95"))


def q_sliding_rate(spark, sf_dir):
    """Rejections per second by reason over the trailing half hour, refreshed every five minutes."""
    return ntz(_rounded(M.sliding_rate(_counter(spark, sf_dir), "30 minutes", "5 minutes", by=["reason"]), "rate"))


def q_sliding_quantile(spark, sf_dir):
    """p50 and p95 of latency over the trailing three hours, refreshed every hour."""
    samples = latency_bucket_samples(events(spark, sf_dir), LATENCY_BOUNDS)
    return ntz(_rounded(M.histogram_rate_quantile(samples, "latency_ms_bucket", [0.5, 0.95], "3 hours",
                                                  out=["p50", "p95"], every="1 hour"), "p50", "p95"))


def q_lag_asof(spark, sf_dir):
    """Lag at every head sample (one per minute and partition) from commits of another rhythm."""
    return ntz(lag_asof(*offset_samples(events(spark, sf_dir), UNCOMMITTED)))


def q_gauge_latest(spark, sf_dir):
    lg = logs_from_events(events(spark, sf_dir), keep=[F.col("ts").cast("timestamp").alias("ts")])
    samples = lg.select("ts", F.lit("latency_ms").alias("metric"),
                        F.create_map(F.lit("service"), F.col("service")).alias("labels"),
                        F.col("latency_ms").cast("double").alias("value"))
    return M.latest(samples.withColumn("service", F.col("labels")["service"]), ["service"])


def q_lag_series(spark, sf_dir):
    return ntz(lag_series(wire_messages(events(spark, sf_dir))))


_SAMPLES = """
WITH s AS (SELECT ts, event_id, event_type AS reason,
                  CAST(row_number() OVER (PARTITION BY event_type, date_trunc('day', ts) ORDER BY ts, event_id)
                       AS DOUBLE) AS value
           FROM events),
u AS (SELECT ts, reason, max(value) AS value FROM s GROUP BY ts, reason),
p AS (SELECT *, lag(value) OVER w AS prev, lag(ts) OVER w AS prev_ts FROM u
      WINDOW w AS (PARTITION BY reason ORDER BY ts)),
i AS (SELECT date_trunc('hour', ts) AS time, reason,
             sum(CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END) * 1e6
             / nullif(CAST(coalesce(sum(epoch_us(ts) - epoch_us(prev_ts)), 0) AS DOUBLE), 0) AS rate
      FROM p GROUP BY 1, 2)"""
_BOUNDS = ", ".join(f"('{M.format_le(float(b))}', {float(b)})" for b in LATENCY_BOUNDS) + ", ('+Inf', 'inf'::DOUBLE)"
_BUCKETS = f"""
WITH logs AS ({LOGS_SQL}), b(le, bound) AS (VALUES {_BOUNDS}),
h AS (SELECT service, le, bound, count(*) FILTER (WHERE latency_ms <= bound) AS count FROM logs, b
      GROUP BY service, le, bound)"""


def _quantile_sql(q: float, name: str, group: str = "service", src: str = "h") -> str:
    return f"""
    (SELECT {group}, CASE WHEN le = '+Inf' THEN top
                     ELSE prev_le + (bound - prev_le) * coalesce(({q} * total - prev_cnt) / nullif(count - prev_cnt, 0), 0)
                     END AS {name}
     FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY bound) AS rn
           FROM (SELECT {group}, le, bound, CAST(count AS DOUBLE) AS count,
                        coalesce(lag(bound) OVER (PARTITION BY {group} ORDER BY bound), 0) AS prev_le,
                        coalesce(lag(CAST(count AS DOUBLE)) OVER (PARTITION BY {group} ORDER BY bound), 0) AS prev_cnt,
                        max(CASE WHEN le = '+Inf' THEN CAST(count AS DOUBLE) END) OVER (PARTITION BY {group}) AS total,
                        max(CASE WHEN le <> '+Inf' THEN bound END) OVER (PARTITION BY {group}) AS top
                 FROM {src}) w
           WHERE total > 0 AND count >= {q} * total) f
     WHERE rn = 1)"""


_RATE_BUCKETS = f"""
WITH logs AS ({LOGS_SQL}), b(le, bound) AS (VALUES {_BOUNDS}),
hb AS (SELECT date_trunc('hour', timestamp) + INTERVAL 1 HOUR AS ts, le, bound,
              count(*) FILTER (WHERE latency_ms <= bound) AS n
       FROM logs, b GROUP BY 1, 2, 3),
c AS (SELECT ts, le, bound, CAST(sum(n) OVER (PARTITION BY le ORDER BY ts ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS value
      FROM hb),
p AS (SELECT *, lag(value) OVER w AS prev, lag(ts) OVER w AS prev_ts FROM c WINDOW w AS (PARTITION BY le ORDER BY ts)),
r AS (SELECT date_trunc('hour', ts) AS time, le, bound,
             sum(CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END) * 1e6
             / nullif(CAST(coalesce(sum(epoch_us(ts) - epoch_us(prev_ts)), 0) AS DOUBLE), 0) AS count
      FROM p GROUP BY 1, 2, 3)"""


_SLIDING = """
x AS (SELECT ts, reason, prev_ts, CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS inc FROM p),
g AS (SELECT unnest(generate_series((SELECT time_bucket(INTERVAL 5 MINUTE, min(ts)) FROM p),
                                    (SELECT max(ts) + INTERVAL 1 HOUR FROM p), INTERVAL 5 MINUTE)) AS time)"""
_SLIDING_BUCKETS = """
x AS (SELECT ts, le, bound, prev_ts, CASE WHEN prev IS NULL THEN 0 WHEN value < prev THEN value ELSE value - prev END AS inc FROM p),
g AS (SELECT unnest(generate_series((SELECT min(ts) FROM p), (SELECT max(ts) + INTERVAL 3 HOUR FROM p), INTERVAL 1 HOUR)) AS time),
h AS (SELECT time, le, bound, sum(inc) * 1e6 / nullif(CAST(coalesce(sum(epoch_us(ts) - epoch_us(prev_ts)), 0) AS DOUBLE), 0) AS count
      FROM g JOIN x ON ts > time - INTERVAL 3 HOUR AND ts <= time GROUP BY 1, 2, 3)"""
_OFFSETS = f"""
WITH m AS (SELECT '{LOG_TOPIC}' AS topic, CAST(user_id % 4 AS INTEGER) AS partition, event_id + 1 AS o, ts FROM events),
heads AS (SELECT topic, partition, date_trunc('minute', ts) + INTERVAL 1 MINUTE AS ts, max(o) AS head FROM m GROUP BY ALL),
commits AS (SELECT topic, partition, time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 13 MINUTE AS ts, max(o) AS committed
            FROM m WHERE partition <> {UNCOMMITTED} GROUP BY ALL)"""


SQL = {
    "sliding_rate": f"""{_SAMPLES}, {_SLIDING}
        SELECT time, reason, round(sum(inc) * 1e6 / nullif(CAST(coalesce(sum(epoch_us(ts) - epoch_us(prev_ts)), 0) AS DOUBLE), 0),
                                   {DECIMALS}) AS rate
        FROM g JOIN x ON ts > time - INTERVAL 30 MINUTE AND ts <= time GROUP BY 1, 2""",
    "lag_asof": f"""{_OFFSETS}
        SELECT h.topic, h.partition, h.ts, head, committed, head - committed AS lag
        FROM heads h ASOF LEFT JOIN commits c ON c.topic = h.topic AND c.partition = h.partition AND c.ts <= h.ts""",
    "counter_rate": f"{_SAMPLES} SELECT time, round(sum(rate), {DECIMALS}) AS rate FROM i GROUP BY 1",
    "dlq_rate": f"{_SAMPLES} SELECT time, reason, round(sum(rate), {DECIMALS}) AS rate FROM i GROUP BY 1, 2",
    "metric_total": f"""{_SAMPLES} SELECT sum(v) AS total FROM (SELECT reason, arg_max(value, ts) AS v FROM s
                        GROUP BY reason)""",
    "histogram_buckets": f"{_BUCKETS} SELECT service, le, count FROM h",
    "histogram_quantile": f"""{_BUCKETS} SELECT a.service, a.p50, b.p95 FROM {_quantile_sql(0.5, 'p50')} a
                              JOIN {_quantile_sql(0.95, 'p95')} b ON a.service = b.service""",
    "histogram_rate_quantile": f"""{_RATE_BUCKETS}
        SELECT t.time, round(a.p50, {DECIMALS}) AS p50, round(b.p95, {DECIMALS}) AS p95
        FROM (SELECT DISTINCT time FROM r) t
        LEFT JOIN {_quantile_sql(0.5, 'p50', 'time', 'r')} a ON a.time = t.time
        LEFT JOIN {_quantile_sql(0.95, 'p95', 'time', 'r')} b ON b.time = t.time""",
    "sliding_quantile": f"""{_RATE_BUCKETS[:_RATE_BUCKETS.index("r AS (SELECT date_trunc")]}{_SLIDING_BUCKETS}
        SELECT t.time, round(a.p50, {DECIMALS}) AS p50, round(b.p95, {DECIMALS}) AS p95
        FROM (SELECT DISTINCT time FROM h) t
        LEFT JOIN {_quantile_sql(0.5, 'p50', 'time', 'h')} a ON a.time = t.time
        LEFT JOIN {_quantile_sql(0.95, 'p95', 'time', 'h')} b ON b.time = t.time""",
    "gauge_latest": f"""SELECT concat('svc-', CAST(user_id % 4 AS VARCHAR)) AS service,
                               arg_max(CAST(floor(value * 10) AS DOUBLE), ts) AS value
                        FROM events GROUP BY 1""",
    "lag_series": f"""
        WITH m AS (SELECT CAST(user_id % 4 AS INTEGER) AS partition, date_trunc('hour', ts) AS time,
                          max(event_id) + 1 AS head_in FROM events GROUP BY 1, 2),
        c AS (SELECT partition, time,
                     max(head_in) OVER (PARTITION BY partition ORDER BY time ROWS UNBOUNDED PRECEDING) AS head
              FROM m)
        SELECT '{LOG_TOPIC}' AS topic, partition, time, head,
               head - coalesce(lag(head) OVER (PARTITION BY partition ORDER BY time), 0) AS lag
        FROM c""",
}

QUERIES = {
    "counter_rate": q_counter_rate,
    "dlq_rate": q_dlq_rate,
    "metric_total": q_metric_total,
    "histogram_buckets": q_histogram_buckets,
    "histogram_quantile": q_histogram_quantile,
    "histogram_rate_quantile": q_histogram_rate_quantile,
    "gauge_latest": q_gauge_latest,
    "lag_series": q_lag_series,
    "sliding_rate": q_sliding_rate,
    "sliding_quantile": q_sliding_quantile,
    "lag_asof": q_lag_asof,
}
