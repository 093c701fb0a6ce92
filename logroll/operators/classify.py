"""Classify raw messages into typed log rows or rejections (one pass, native expressions only).

Each message ends in exactly one of:

* ``EMPTY_KAFKA_PAYLOAD`` — value is null or zero bytes (whitespace is *not* empty); payload null.
* ``INVALID_JSON_STRING_FORMAT`` — not exactly one JSON value; payload is the raw text.
* ``SCHEMA_VIOLATION: <field>:<rule>, ...`` — JSON, but the event rules fail; payload is the raw text.
* valid — ``reason`` is null and the eight typed columns are filled.

Event rules: ``timestamp`` ISO-8601 UTC text ending in ``Z``; ``level`` one of the five levels
(case-sensitive); ``service``, ``host``, ``traceId`` non-empty text; ``statusCode`` an integral
number in 100..599; ``latencyMs`` an integral number ≥ 0; ``message`` text, may be empty.  Every
field is required and JSON null is not a value.  Integral means exactly representable
(``503.0`` passes, ``200.5`` fails, beyond 2**53-1 fails); numbers given as text fail.  Unknown
keys are ignored.  A reason never depends on wall-clock or on other rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, functions as F

from logroll.functions.strict_json import (
    decode_payload, is_number_type, member_texts, member_variants, parse_wrapped, starts_object, strict_ok,
)
from logroll.schemas import (
    LEVELS, LOG_COLUMNS, MAX_SAFE_INTEGER, REASON_BAD_JSON, REASON_EMPTY, REASON_SCHEMA,
    STATUS_MAX, STATUS_MIN,
)

# ISO-8601 UTC: date, 'T', hours:minutes, optional seconds and fraction, then 'Z' as the very last character.
_ISO_UTC = r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2})(:\d{2})?(\.\d+)?Z\z"


def _fail(cond: Column, label: str) -> Column:
    """``label`` unless ``cond`` is true; a null outcome counts as a failure."""
    return F.when(~F.coalesce(cond, F.lit(False)), F.lit(label))


def _timestamp_value(text: Column) -> Column:
    """Parse accepted ISO text to a millisecond timestamp; null when the calendar/time is invalid.

    The regex fixes every position, so normalising is plain slicing: ``HH:MMZ`` gains ``:00`` and
    a fraction longer than microseconds is cut (the value is truncated to milliseconds anyway)."""
    n = F.length(text)
    norm = (F.when(n == 17, F.concat(F.substring(text, 1, 16), F.lit(":00Z")))
            .when(n > 27, F.concat(F.substring(text, 1, 26), F.lit("Z")))
            .otherwise(text))
    return F.date_trunc("millisecond", F.try_to_timestamp(F.when(text.rlike(_ISO_UTC), norm)))


@functools.lru_cache(maxsize=8)
def _stages(value_col: str) -> tuple[list[Column], ...]:
    """The classifier's projections, built once per process: constructing these expressions costs
    driver time, and a stream builds a new plan for every micro-batch."""
    s1 = [decode_payload(F.col(value_col)).alias("payload")]
    s1b = [F.col("payload"), parse_wrapped(F.col("payload")).alias("_w")]
    fields = ("timestamp", "level", "service", "host", "traceId", "statusCode", "latencyMs", "message")
    short = {"timestamp": "_ts_text", "level": "_level", "service": "_service", "host": "_host",
             "traceId": "_trace", "statusCode": "_status", "latencyMs": "_latency", "message": "_message"}
    typed = ["_level", "_service", "_host", "_trace", "_status", "_latency", "_message"]
    number = ("statusCode", "latencyMs")
    # Members are looked up together, as VARIANTs, for their types.  Their values are read as text by a second,
    # plain parse: a typed value out of a VARIANT costs more than the parse of the whole message.
    s2 = [F.col("payload"), F.coalesce(F.length("payload"), F.lit(0)).alias("_len"),
          strict_ok(F.col("_w"), F.col("payload")).alias("_ok"), starts_object(F.col("payload")).alias("_obj"),
          member_variants(F.col("_w"), fields).alias("_v")]

    def right_type(f):
        name = F.schema_of_variant(F.col(f"_v.{f}"))
        return F.coalesce(is_number_type(name) if f in number else name == "STRING", F.lit(False))

    s2b = [F.col(c) for c in ("payload", "_len", "_ok", "_obj")] + [
        F.col(f"_v.{f}").isNotNull().alias(f"_has_{f}") for f in fields] + [
        right_type(f).alias(f"_is_{f}") for f in fields] + [
        F.when(F.col("_ok") & F.col("_obj"), member_texts(F.col("payload"), fields)).alias("_x")]
    flags = [F.col(f"_{k}_{f}") for k in ("has", "is") for f in fields]
    s3 = [F.col(c) for c in ("payload", "_len", "_ok", "_obj")] + flags + [
        (F.col(f"_x.{f}").try_cast("double") if f in number else F.col(f"_x.{f}")).alias(short[f])
        for f in fields if short[f] in typed] + [_timestamp_value(F.col("_x.timestamp")).alias("_ts")]

    def field_rules(f, checks=()):
        """Presence and type first; value rules only apply to a value of the right type."""
        has, right = F.col(f"_has_{f}"), F.col(f"_is_{f}")
        return [
            F.when(~has, F.lit(f"{f}:required")),
            F.when(has & ~right, F.lit(f"{f}:type")),
        ] + [F.when(right, _fail(c, f"{f}:{name}")) for name, c in checks]

    ts_value = F.col("_ts")
    integral = lambda c: (c == F.floor(c)) & (F.abs(c) <= F.lit(MAX_SAFE_INTEGER))
    rules = (
        field_rules("timestamp", [("datetime", ts_value.isNotNull())])
        + field_rules("level", [("enum", F.col("_level").isin(*LEVELS))])
        + field_rules("service", [("min_length", F.length("_service") >= 1)])
        + field_rules("host", [("min_length", F.length("_host") >= 1)])
        + field_rules("traceId", [("min_length", F.length("_trace") >= 1)])
        + field_rules("statusCode", [("int", integral(F.col("_status"))),
                                     ("range", F.col("_status").between(STATUS_MIN, STATUS_MAX))])
        + field_rules("latencyMs", [("int", integral(F.col("_latency"))),
                                    ("nonnegative", F.col("_latency") >= 0)])
        + field_rules("message")
    )
    # concat_ws skips nulls, so only failed rules remain (and the projection stays in codegen).
    violations = F.when(~F.col("_obj"), F.lit("root:object")).otherwise(F.concat_ws(", ", *rules))
    s4 = [F.col(c) for c in ("payload", "_len", "_ok")] + [violations.alias("_violations"), F.col("_ts")] + [
        F.col(c) for c in typed]

    reason = (F.when(F.col("_len") == 0, F.lit(REASON_EMPTY))
              .when(~F.col("_ok"), F.lit(REASON_BAD_JSON))
              .when(F.length("_violations") > 0,
                    F.concat(F.lit(REASON_SCHEMA + ": "), F.col("_violations"))))
    s5 = [F.when(F.col("_len") > 0, F.col("payload")).alias("payload"), reason.alias("_reason"), F.col("_ts")] + [
        F.col(c) for c in typed]

    # The outcome is emitted through a one-row generator.  Filters on it (valid / rejected) then
    # stay above the generator instead of being pushed down and re-evaluating every rule.
    valid = F.col("_reason").isNull()
    outcome = F.struct(
        F.col("payload"),
        F.col("_reason").alias("reason"),
        F.when(valid, F.lit(None)).otherwise(F.split_part("_reason", F.lit(":"), F.lit(1))).alias("reason_code"),
        F.when(valid, F.col("_ts")).alias("timestamp"),
        F.when(valid, F.col("_level")).alias("level"),
        F.when(valid, F.col("_service")).alias("service"),
        F.when(valid, F.col("_host")).alias("host"),
        F.when(valid, F.col("_trace")).alias("trace_id"),
        F.when(valid, F.col("_status").cast("int")).alias("status_code"),
        F.when(valid, F.col("_latency").cast("bigint")).alias("latency_ms"),
        F.when(valid, F.col("_message")).alias("message"),
    )
    s6 = [F.inline(F.array(outcome))]
    return s1, s1b, s2, s2b, s3, s4, s5, s6


def classify(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Add ``payload`` (decoded text), ``reason`` (null when valid), ``reason_code`` and the eight
    log columns (null unless valid).  Other input columns (topic, partition, offset, ...) pass
    through, so lineage survives for idempotent writes."""
    raw.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # The rules as one generated method exceed what the JVM compiles (8,000 bytes of bytecode) and would
    # be interpreted for every message; beyond this limit Spark generates smaller methods instead.
    raw.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    keep = [c for c in raw.columns if c != value_col and c not in LOG_COLUMNS]
    df = raw
    for stage in _stages(value_col):
        df = df.select(*keep, *stage)
    return df


def valid_rows(classified: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The eight public log columns of accepted messages (plus ``keep`` lineage columns)."""
    return classified.where(F.col("reason").isNull()).select(*LOG_COLUMNS, *(keep or []))


def rejections(classified: DataFrame, keep: list[str] | None = None) -> DataFrame:
    return classified.where(F.col("reason").isNotNull()).select("reason", "reason_code", "payload",
                                                                *(keep or []))


def dlq_envelopes(rejected: DataFrame, rejected_at=None) -> DataFrame:
    """Dead-letter envelope per rejection: ``rejected_at``, ``reason``, ``payload`` and ``value``, the
    JSON text ``{"rejectedAt":..., "reason":..., "payload":...}`` with a null payload kept as
    ``null``.  ``rejected_at`` defaults to the processing time."""
    from logroll.functions.timefn import as_timestamp, iso_millis

    at = as_timestamp(rejected_at)
    cols = [c for c in rejected.columns if c not in ("reason", "payload")]
    return rejected.select(
        *cols,
        at.alias("rejected_at"), "reason", "payload",
        F.to_json(F.struct(iso_millis(at).alias("rejectedAt"), F.col("reason"), F.col("payload")),
                  {"ignoreNullFields": "false"}).alias("value"),
    )
