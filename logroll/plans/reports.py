"""Registered report plans: events → logs → rollup → report, with their SQL oracle text.

Every plan reads the whole ``events`` table.  ``as_of`` is the newest log timestamp, taken as a
scalar subquery (no driver round trip), so results are reproducible.  Reports use a trailing
window that spans all data unless the key says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from logroll.functions.text import clock_text, grouped_number
from logroll.functions.timefn import window_start
from logroll.operators import reports as R
from logroll.operators.rollup import latency_frequencies, merge_rollup, rollup_1m
from logroll.plans.common import LOGS_SQL, ROLLUP_SQL, events, ntz
from logroll.sources.events import logs_from_events

ALL_MINUTES = 525_600   # a year: the window spans every row of the test data
DAY_MINUTES = 1_440
SERVICE = "svc-1"
DECIMALS = 6            # percentiles of millisecond latencies, reported to the nanosecond


def logs(spark: SparkSession, sf_dir: str, keep: list[str] | None = None) -> DataFrame:
    return logs_from_events(events(spark, sf_dir), keep)


def as_of(logs_df: DataFrame):
    return logs_df.agg(F.max("timestamp")).scalar()


def _rollup(spark, sf_dir, sketch=False):
    lg = logs(spark, sf_dir)
    return lg, rollup_1m(lg, sketch=sketch)


def q_rollup_1m(spark, sf_dir):
    _, r = _rollup(spark, sf_dir)
    return ntz(r)


def q_rollup_merged(spark, sf_dir):
    """Partials written by three ingest batches (split by ``event_id % 3``), merged at read."""
    lg = logs(spark, sf_dir, ["event_id"]).withColumn("batch_id", F.col("event_id") % 3)
    partial = rollup_1m(lg, sketch=True, extra_keys=["batch_id"])
    return ntz(merge_rollup(partial).drop("latency_quantiles"))


def q_throughput(spark, sf_dir):
    lg, r = _rollup(spark, sf_dir)
    return ntz(R.throughput(r, ALL_MINUTES, as_of(lg)))


def recent_logs(spark, sf_dir, minutes: int) -> tuple[DataFrame, Column]:
    """(log rows of the trailing window, as_of).  A minute in the window has no row before the
    window's start, so the start also bounds ``ts``, where the Parquet scan can skip row groups: it
    is a whole subquery of the column's own type, which the scan gets as a literal."""
    every, ev = logs(spark, sf_dir), events(spark, sf_dir)
    start = every.agg(window_start(F.max("timestamp"), minutes).cast(ev.schema["ts"].dataType)).scalar()
    return logs_from_events(ev.where(F.col("ts") >= start)), as_of(every)


def q_throughput_1d(spark, sf_dir):
    lg, newest = recent_logs(spark, sf_dir, DAY_MINUTES)
    return ntz(R.throughput(rollup_1m(lg, sketch=False), DAY_MINUTES, newest))


def q_errors_by_service(spark, sf_dir):
    lg, r = _rollup(spark, sf_dir)
    return R.errors_by_service(r, ALL_MINUTES, as_of(lg))


def q_top_services(spark, sf_dir):
    lg, r = _rollup(spark, sf_dir)
    return R.top_services(r, ALL_MINUTES, as_of(lg))


def q_latency_percentiles(spark, sf_dir):
    lg = logs(spark, sf_dir)
    return R.split_percentiles(R.latency_percentiles(latency_frequencies(lg), ALL_MINUTES, as_of(lg)), decimals=DECIMALS)


def q_latency_percentiles_1d(spark, sf_dir):
    lg, newest = recent_logs(spark, sf_dir, DAY_MINUTES)
    return R.split_percentiles(R.latency_percentiles(latency_frequencies(lg), DAY_MINUTES, newest), decimals=DECIMALS)


def q_latency_percentiles_sketch(spark, sf_dir):
    """The sketch's percentiles against exact ranks.  Their values vary from run to run (a sketch draws which
    values it keeps), so the rows tell whether each is within its bound."""
    lg, r = _rollup(spark, sf_dir, sketch=True)
    ranks = R.sketch_ranks(r, latency_frequencies(lg), ALL_MINUTES, as_of(lg))
    return ranks.select("service", "rows", *[F.col("within")[i].alias(f"{n}_within") for i, n in enumerate(("p50", "p90", "p99"))])


def q_service_filter(spark, sf_dir):
    return R.split_percentiles(R.service_percentiles(latency_frequencies(logs(spark, sf_dir)), SERVICE),
                               decimals=DECIMALS)


def q_service_totals(spark, sf_dir):
    return R.service_totals(_rollup(spark, sf_dir)[1])


def q_avg_latency(spark, sf_dir):
    lg, r = _rollup(spark, sf_dir)
    return R.avg_latency(r, ALL_MINUTES, as_of(lg))


def q_rollup_total(spark, sf_dir):
    return R.rollup_total(_rollup(spark, sf_dir)[1])


def q_raw_count(spark, sf_dir):
    return R.row_count(logs(spark, sf_dir))


def q_latest_minutes(spark, sf_dir):
    lg, r = _rollup(spark, sf_dir)
    return ntz(R.latest_minutes(r, 6, ALL_MINUTES, as_of(lg)))


def q_latest_minutes_text(spark, sf_dir):
    """The newest minutes as the dashboard writes them; ``place`` keeps their order."""
    lg, r = _rollup(spark, sf_dir)
    newest = R.latest_minutes(r, 6, ALL_MINUTES, as_of(lg))
    place = F.row_number().over(Window.orderBy(F.desc("time"))).cast("bigint")        # six rows
    return newest.select(place.alias("place"), clock_text("time").alias("time"), grouped_number("count").alias("count"))


def q_top_services_text(spark, sf_dir):
    lg, r = _rollup(spark, sf_dir)
    return R.top_services(r, ALL_MINUTES, as_of(lg)).select("service", grouped_number("volume").alias("volume"))


_W = "(SELECT max(timestamp) FROM logs) - INTERVAL {m} MINUTE"
_PCT = ", ".join(f"round(quantile_cont(latency_ms, {q}), {DECIMALS}) AS {n}"
                 for q, n in [(0.5, "p50"), (0.9, "p90"), (0.99, "p99")])

SQL = {
    "rollup_1m": f"WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL}) SELECT * FROM rollup",
    "rollup_merged": f"WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL}) SELECT * FROM rollup",
    "throughput": f"""WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL})
        SELECT minute AS time, CAST(sum(total_count) AS BIGINT) AS count FROM rollup
        WHERE minute >= {_W.format(m=ALL_MINUTES)} GROUP BY minute ORDER BY time""",
    "throughput_1d": f"""WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL})
        SELECT minute AS time, CAST(sum(total_count) AS BIGINT) AS count FROM rollup
        WHERE minute >= {_W.format(m=DAY_MINUTES)} GROUP BY minute ORDER BY time""",
    "errors_by_service": f"""WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL})
        SELECT service, CAST(sum(error_count) AS BIGINT) AS error_count FROM rollup
        WHERE minute >= {_W.format(m=ALL_MINUTES)} GROUP BY service ORDER BY error_count DESC, service""",
    "top_services": f"""WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL})
        SELECT service, CAST(sum(total_count) AS BIGINT) AS volume FROM rollup
        WHERE minute >= {_W.format(m=ALL_MINUTES)} GROUP BY service ORDER BY volume DESC, service LIMIT 10""",
    "latency_percentiles": f"""WITH logs AS ({LOGS_SQL})
        SELECT service, {_PCT} FROM logs
        WHERE date_trunc('minute', timestamp) >= {_W.format(m=ALL_MINUTES)} GROUP BY service""",
    "latency_percentiles_1d": f"""WITH logs AS ({LOGS_SQL})
        SELECT service, {_PCT} FROM logs
        WHERE date_trunc('minute', timestamp) >= {_W.format(m=DAY_MINUTES)} GROUP BY service""",
    "service_filter": f"""WITH logs AS ({LOGS_SQL})
        SELECT service, {_PCT} FROM logs WHERE service = '{SERVICE}' GROUP BY service""",
    "service_totals": f"""WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL})
        SELECT service, CAST(sum(total_count) AS BIGINT) AS total, CAST(sum(error_count) AS BIGINT) AS errors
        FROM rollup GROUP BY service""",
    "avg_latency": f"""WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL})
        SELECT service, CAST(sum(latency_sum) AS DOUBLE) / CAST(sum(total_count) AS DOUBLE) AS avg_latency_ms
        FROM rollup WHERE minute >= {_W.format(m=ALL_MINUTES)} GROUP BY service""",
    "rollup_total": f"""WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL})
        SELECT CAST(sum(total_count) AS BIGINT) AS total FROM rollup""",
    "raw_count": f"WITH logs AS ({LOGS_SQL}) SELECT count(*) AS rows FROM logs",
    "latest_minutes": f"""WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL})
        SELECT minute AS time, CAST(sum(total_count) AS BIGINT) AS count FROM rollup
        WHERE minute >= {_W.format(m=ALL_MINUTES)} GROUP BY minute ORDER BY time DESC LIMIT 6""",
    "latency_percentiles_sketch": f"""WITH logs AS ({LOGS_SQL})
        SELECT service, count(*) AS rows, true AS p50_within, true AS p90_within, true AS p99_within
        FROM logs WHERE date_trunc('minute', timestamp) >= {_W.format(m=ALL_MINUTES)} GROUP BY service""",
    "latest_minutes_text": f"""WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL})
        SELECT row_number() OVER (ORDER BY minute DESC) AS place, strftime(minute, '%-I:%M:%S %p') AS time,
               format('{{:,}}', CAST(sum(total_count) AS BIGINT)) AS count
        FROM rollup WHERE minute >= {_W.format(m=ALL_MINUTES)} GROUP BY minute ORDER BY minute DESC LIMIT 6""",
    "top_services_text": f"""WITH logs AS ({LOGS_SQL}), rollup AS ({ROLLUP_SQL})
        SELECT service, format('{{:,}}', CAST(sum(total_count) AS BIGINT)) AS volume FROM rollup
        WHERE minute >= {_W.format(m=ALL_MINUTES)} GROUP BY service ORDER BY sum(total_count) DESC, service LIMIT 10""",
}

QUERIES = {
    "rollup_1m": q_rollup_1m,
    "rollup_merged": q_rollup_merged,
    "throughput": q_throughput,
    "throughput_1d": q_throughput_1d,
    "errors_by_service": q_errors_by_service,
    "top_services": q_top_services,
    "latency_percentiles": q_latency_percentiles,
    "latency_percentiles_1d": q_latency_percentiles_1d,
    "latency_percentiles_sketch": q_latency_percentiles_sketch,
    "service_filter": q_service_filter,
    "service_totals": q_service_totals,
    "avg_latency": q_avg_latency,
    "rollup_total": q_rollup_total,
    "raw_count": q_raw_count,
    "latest_minutes": q_latest_minutes,
    "latest_minutes_text": q_latest_minutes_text,
    "top_services_text": q_top_services_text,
}
