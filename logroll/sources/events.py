"""Inputs derived from the ``events`` table.

Everything the pipeline consumes in tests and benchmarks is a deterministic projection of
``events`` (event_id, ts, user_id, event_type, value, props), so work grows with that table:

* ``logs_from_events`` — typed log rows, one per event.
* ``wire_messages`` — the same events as raw topic messages (JSON with wire field names), with
  every hundredth message replaced by garbage, a schema violation, null or empty bytes.
* ``rule_messages`` — one rule violation per message, cycling through the event rules.
* ``dlq_counter_samples`` — a per-reason counter that resets daily, as metric samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from logroll.functions.timefn import iso_millis
from logroll.operators.sequence import running_count
from logroll.schemas import GARBAGE_SCHEMA, GARBAGE_TEXT, LOG_TOPIC

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

PARTITIONS = 4  # partitions of the simulated topic


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _fields(events: DataFrame) -> dict[str, Column]:
    et = F.col("event_type")
    eid = F.col("event_id")
    uid = F.col("user_id")
    return {
        "timestamp": F.date_trunc("millisecond", F.col("ts")),
        "level": F.when(et == "error", "ERROR").when(et == "purchase", "WARN").otherwise("INFO"),
        "service": F.concat(F.lit("svc-"), (uid % 4).cast("string")),
        "host": F.concat(F.lit("host-"), F.lpad((uid % 10 + 1).cast("string"), 2, "0")),
        "trace_id": F.concat(F.lit("trace-"), eid.cast("string")),
        "status_code": F.when(et == "error", 500 + eid % 5).when(et == "purchase", 404)
                        .otherwise(200).cast("int"),
        "latency_ms": F.floor(F.col("value") * 10).cast("bigint"),
        "message": F.col("props"),
    }


def logs_from_events(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Typed log rows: ERROR for errors (status 500-504), WARN for purchases (404), else INFO
    (200); service ``svc-<user_id % 4>``; latency ``floor(value * 10)`` ms.  ``keep`` names event
    columns to carry along."""
    return events.select(*[c.alias(n) for n, c in _fields(events).items()], *(keep or []))


def _wire_json(f: dict[str, Column]) -> Column:
    return F.to_json(F.struct(
        iso_millis(f["timestamp"]).alias("timestamp"), f["level"].alias("level"),
        f["service"].alias("service"), f["host"].alias("host"), f["trace_id"].alias("traceId"),
        f["status_code"].alias("statusCode"), f["latency_ms"].alias("latencyMs"),
        f["message"].alias("message")))


def _envelope(events: DataFrame, text: Column, topic: str) -> DataFrame:
    f = _fields(events)
    return events.select(
        f["trace_id"].cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def wire_messages(events: DataFrame, topic: str = LOG_TOPIC) -> DataFrame:
    """Raw messages (key, value, topic, partition, offset, timestamp).  ``event_id % 100``: 0 →
    plain-text garbage, 1 → JSON without the event fields, 2 → null, 3 → zero bytes, else the
    event as JSON.  Partition ``user_id % 4``; offset ``event_id`` (increasing per partition)."""
    k = F.col("event_id") % 100
    text = (F.when(k == 0, F.lit(GARBAGE_TEXT)).when(k == 1, F.lit(GARBAGE_SCHEMA))
            .when(k == 2, F.lit(None).cast("string")).when(k == 3, F.lit(""))
            .otherwise(_wire_json(_fields(events))))
    return _envelope(events, text, topic)


def _member(name: str, value: Column) -> Column:
    """JSON text ``"name":<value>`` for one object member."""
    return F.regexp_extract(F.to_json(F.struct(value.alias(name))), r"^\{(.*)\}$", 1)


def rule_messages(events: DataFrame, topic: str = LOG_TOPIC) -> DataFrame:
    """Messages that each break (or stress) one event rule, chosen by ``event_id % 20``:

    0 timestamp ``Mon Jan 15 08:30:00 2024`` · 1 level ``NOTICE`` · 2 statusCode 99 · 3 statusCode 600 ·
    4 statusCode 301.75 · 5 latencyMs -40 · 6 latencyMs 0.125 · 7 latencyMs ``true`` · 8 service
    ``""`` · 9 host ``""`` · 10 traceId ``""`` · 11 no timestamp · 12 no message · 13 message
    null · 14 statusCode ``503.0`` (valid) · 15 extra key (valid) · 16 timestamp with ``+02:00`` ·
    17 statusCode -5.5 · 18 timestamp without seconds (valid) · 19 level given twice, last valid
    (valid)."""
    f = _fields(events)
    k = F.col("event_id") % 20
    ts_text = iso_millis(f["timestamp"])
    base = {
        "timestamp": _member("timestamp", ts_text),
        "level": _member("level", f["level"]),
        "service": _member("service", f["service"]),
        "host": _member("host", f["host"]),
        "traceId": _member("traceId", f["trace_id"]),
        "statusCode": _member("statusCode", f["status_code"]),
        "latencyMs": _member("latencyMs", f["latency_ms"]),
        "message": _member("message", f["message"]),
    }
    over = {
        "timestamp": (F.when(k == 0, F.lit('"timestamp":"Mon Jan 15 08:30:00 2024"'))
                      .when(k == 11, F.lit(None).cast("string"))
                      .when(k == 16, F.concat(F.lit('"timestamp":"'), F.substring(ts_text, 1, 23),
                                              F.lit('+02:00"')))
                      .when(k == 18, F.concat(F.lit('"timestamp":"'), F.substring(ts_text, 1, 16),
                                              F.lit('Z"')))),
        "level": (F.when(k == 1, F.lit('"level":"NOTICE"'))
                  .when(k == 19, F.concat(F.lit('"level":"NOTICE",'), base["level"]))),
        "service": F.when(k == 8, F.lit('"service":""')),
        "host": F.when(k == 9, F.lit('"host":""')),
        "traceId": F.when(k == 10, F.lit('"traceId":""')),
        "statusCode": (F.when(k == 2, F.lit('"statusCode":99')).when(k == 3, F.lit('"statusCode":600'))
                       .when(k == 4, F.lit('"statusCode":301.75')).when(k == 14, F.lit('"statusCode":503.0'))
                       .when(k == 17, F.lit('"statusCode":-5.5'))),
        "latencyMs": (F.when(k == 5, F.lit('"latencyMs":-40')).when(k == 6, F.lit('"latencyMs":0.125'))
                      .when(k == 7, F.lit('"latencyMs":true'))),
        "message": (F.when(k == 12, F.lit(None).cast("string"))
                    .when(k == 13, F.lit('"message":null'))),
    }
    dropped = {"timestamp": k == 11, "message": k == 12}
    members = []
    for name, text in base.items():
        m = F.coalesce(over[name], text)
        if name in dropped:
            m = F.when(~dropped[name], m)
        members.append(m)
    members.append(F.when(k == 15, F.lit('"region":"eu-west-1"')))
    body = F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))
    return _envelope(events, body, topic)


def dlq_counter_samples(events: DataFrame) -> DataFrame:
    """Metric samples of a dead-letter counter with one series per reason (event_type) that
    resets at each UTC midnight: value = number of that day's events of the type so far."""
    ev = events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    ev = ev.withColumn("_day", F.date_trunc("day", "ts"))
    counted = running_count(ev, ["event_type", "_day"], ["ts", "event_id"], "ts", out="_n")
    return counted.select(
        "ts",
        F.lit("pipeline_messages_dlq_total").alias("metric"),
        F.create_map(F.lit("reason"), F.col("event_type")).alias("labels"),
        F.col("_n").cast("double").alias("value"),
    )


def latency_bucket_samples(events: DataFrame, bounds, metric: str = "latency_ms_bucket") -> DataFrame:
    """Cumulative histogram counters of log latency, scraped at the end of every hour that has
    events: one sample per ``le`` with the number of events so far whose latency is ≤ ``le``.
    Counts are aggregated per hour first; the running sum runs over (hours × buckets) rows."""
    from pyspark.sql import Window
    from logroll.operators.metrics import histogram_buckets

    lg = logs_from_events(events).withColumn("ts", F.date_trunc("hour", "timestamp") + F.expr("INTERVAL 1 HOUR"))
    per_hour = histogram_buckets(lg, "latency_ms", bounds, group=["ts"])
    running = F.sum("count").over(Window.partitionBy("le").orderBy("ts")
                                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return per_hour.select("ts", F.lit(metric).alias("metric"), F.create_map(F.lit("le"), F.col("le")).alias("labels"),
                           running.cast("double").alias("value"))


def offset_samples(events: DataFrame, silent: int) -> tuple[DataFrame, DataFrame]:
    """Head and commit samples of the simulated topic: heads at the end of each minute with messages,
    commits three minutes after each ten minutes with messages; partition ``silent`` never commits."""
    m = wire_messages(events).select("topic", "partition", (F.col("offset") + 1).alias("o"), "timestamp")
    sampled = lambda step, after, out: (                                                   # noqa: E731
        m.groupBy("topic", "partition", F.window("timestamp", step).end.alias("ts")).agg(F.max("o").alias(out))
        .withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {after} MINUTE")))
    return sampled("1 minute", 0, "head"), sampled("10 minutes", 3, "committed").where(F.col("partition") != silent)
