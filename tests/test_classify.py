"""Classifier vectors: event rules, strict JSON, timestamps, rejection envelopes."""

import json

import pytest
from pyspark.sql import functions as F

from logroll.operators.classify import classify, dlq_envelopes, rejections, valid_rows
from logroll.schemas import LOG_COLUMNS

SAMPLE = {"timestamp": "2025-02-28T23:59:59.004Z", "level": "WARN", "service": "tile-cache", "host": "rack9/blade2",
          "traceId": "0", "statusCode": 429, "latencyMs": 0, "message": "quota: 12 of 10 used"}


def run(spark, texts):
    """Classify raw texts (None = null value); returns rows in input order."""
    rows = [(i, None if t is None else t.encode("utf-8") if isinstance(t, str) else t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "offset long, value binary")
    return sorted(classify(df).collect(), key=lambda r: r["offset"])


def with_(**over):
    d = dict(SAMPLE)
    for k, v in over.items():
        if v is ...:
            d.pop(k)
        else:
            d[k] = v
    return json.dumps(d)


def test_valid_sample_maps_to_row(spark):
    (r,) = run(spark, [json.dumps(SAMPLE)])
    got = {c: r[c] for c in LOG_COLUMNS if c != "timestamp"}
    assert got == {"level": "WARN", "service": "tile-cache", "host": "rack9/blade2", "trace_id": "0",
                   "status_code": 429, "latency_ms": 0, "message": "quota: 12 of 10 used"}
    assert r["timestamp"].isoformat().startswith("2025-02-28T23:59:59.004") and r["reason"] is r["reason_code"] is None


def test_valid_rows_has_exactly_eight_columns(spark):
    df = spark.createDataFrame([(0, json.dumps(SAMPLE).encode())], "offset long, value binary")
    assert valid_rows(classify(df)).columns == LOG_COLUMNS


# For each field, values at and just beyond what its rules allow: (value, rule broken or None).
EDGES = {
    "level": [("DEBUG", None), ("FATAL", None), ("warn", "enum"), ("WARN ", "enum"), (3, "type")],
    "service": [("x", None), ("", "min_length"), (["x"], "type"), (None, "type")],
    "host": [(" ", None), ("", "min_length"), (17, "type")],
    "traceId": [("é", None), ("", "min_length"), (False, "type")],
    "statusCode": [(100, None), (599, None), (99, "range"), (600, "range"), (-200, "range"), (302.25, "int"), ("429", "type")],
    "latencyMs": [(2**53 - 1, None), (2**53, "int"), (-3, "nonnegative"), (0.5, "int"), ({}, "type"), (10**19, "int")],
    "message": [("", None), ("x" * 5000, None), (0, "type"), (None, "type")],
    "timestamp": [("2025-03-01T00:00Z", None), ("2025-03-01", "datetime"), ("", "datetime"), ("1740787200", "datetime")],
}


def test_edges_of_every_rule(spark):
    cases = [(f, v, rule) for f, values in EDGES.items() for v, rule in values]
    rows = run(spark, [with_(**{f: v}) for f, v, _ in cases])
    for (field, value, rule), r in zip(cases, rows, strict=True):
        if rule is None:
            assert r["reason"] is None, (field, value, r["reason"])
        else:
            assert r["reason"] == f"SCHEMA_VIOLATION: {field}:{rule}", (field, value, r["reason"])
            assert r["payload"] == with_(**{field: value}) and all(r[c] is None for c in LOG_COLUMNS)


def test_rules_are_listed_in_field_order(spark):
    (r,) = run(spark, [with_(message=1, host="", level="x", statusCode=1000)])
    assert r["reason"] == "SCHEMA_VIOLATION: level:enum, host:min_length, statusCode:range, message:type"


@pytest.mark.parametrize("field", list(SAMPLE))
def test_each_missing_field_rejected(spark, field):
    (r,) = run(spark, [with_(**{field: ...})])
    assert r["reason"] == f"SCHEMA_VIOLATION: {field}:required"


def test_number_forms(spark):
    rows = run(spark, [with_(statusCode=429.0), with_().replace('"statusCode": 429', '"statusCode": 42.9e1'),
                       with_(region="north")])
    assert [r["reason"] for r in rows] == [None, None, None]
    assert [r["status_code"] for r in rows] == [429, 429, 429]


@pytest.mark.parametrize("ts,ok,expect", [
    ("2026-07-31T12:34:56.789Z", True, "2026-07-31T12:34:56.789000"),
    ("2026-07-31T12:34:56Z", True, "2026-07-31T12:34:56"),
    ("2026-07-31T12:34:56.123456789Z", True, "2026-07-31T12:34:56.123000"),
    ("2026-07-31T12:34Z", True, "2026-07-31T12:34:00"),
    ("2026-07-31T12:34:56+02:00", False, None),
    ("2026-07-31T12:34:56", False, None),
    ("2026-02-30T00:00:00Z", False, None),
    ("2026-07-31T24:00:00Z", False, None),
    ("Thu, 31 Jul 2025 09:00:00 GMT", False, None),
])
def test_timestamp_vectors(spark, ts, ok, expect):
    (r,) = run(spark, [with_(timestamp=ts)])
    assert (r["reason"] is None) == ok
    if ok:
        assert r["timestamp"].replace(tzinfo=None).isoformat() == expect


LEGAL_JSON = ['{"a":1}', ' {"a":1}\n', '\r\n{"a":1}\t', '{"a":1} ', "null", "1e400", '{"a":1,"a":2}']
ILLEGAL_JSON = ["  ", '{"a":1} x', '{"a":1}],[2', '{"a":1}},{"b":2', '{"a":1},{"b":2}', "1,2", '{"a":1}}',
                '{"a":1}]', '{"a":1} // c', '"x" "y"', '{"a":1} ', "{'a':1}", '{"a":1,}', '{"a":01}',
                '{"a":NaN}', '{"a":"\t"}', "﻿{\"a\":1}", "plain words, no braces",
                '"abc', '{"a":"', '{"a":1}\\', '1\n,"\\u0000end"', '{"a":1}\n,"\\u0000end"', "[1", "{", '1\n,"\\u0000end",null']


def test_strict_json_legal_is_not_a_json_error(spark):
    for r in run(spark, LEGAL_JSON):
        assert r["reason_code"] == "SCHEMA_VIOLATION", r


def test_strict_json_illegal(spark):
    for r in run(spark, ILLEGAL_JSON):
        assert r["reason"] == "INVALID_JSON_STRING_FORMAT", r
        assert r["payload"] is not None


def test_empty_and_null_payloads(spark):
    rows = run(spark, [None, b"", "   "])
    assert [r["reason"] for r in rows] == ["EMPTY_KAFKA_PAYLOAD", "EMPTY_KAFKA_PAYLOAD", "INVALID_JSON_STRING_FORMAT"]
    assert rows[0]["payload"] is None and rows[1]["payload"] is None and rows[2]["payload"] == "   "


def test_non_object_roots(spark):
    for r in run(spark, ["null", "123", '"str"', "[1]", '{"badField":"missing required root elements"}']):
        assert r["reason"].startswith("SCHEMA_VIOLATION: "), r


def test_duplicate_key_last_wins(spark):
    text = with_()[:-1] + ', "level": "none", "level": "INFO"}'
    (r,) = run(spark, [text])
    assert r["reason"] is None and r["level"] == "INFO"


def test_invalid_utf8_is_replaced(spark):
    bad = b'{"a":"\xff"}'
    (r,) = run(spark, [bad])
    assert "�" in r["payload"]


def test_envelope_json_keeps_null_payload(spark):
    df = spark.createDataFrame([(0, None), (1, b"junk")], "offset long, value binary")
    env = dlq_envelopes(rejections(classify(df), keep=["offset"]), "2026-07-31 00:00:00").orderBy("offset").collect()
    first = json.loads(env[0]["value"])
    assert first == {"rejectedAt": "2026-07-31T00:00:00.000Z", "reason": "EMPTY_KAFKA_PAYLOAD", "payload": None}
    assert json.loads(env[1]["value"])["payload"] == "junk"


def test_rejections_counted_by_reason(spark):
    df = spark.createDataFrame([(0, b"{}"), (1, b"[1]"), (2, None)], "offset long, value binary")
    counts = {r[0]: r[1] for r in rejections(classify(df)).groupBy("reason_code").count().collect()}
    assert counts == {"SCHEMA_VIOLATION": 2, "EMPTY_KAFKA_PAYLOAD": 1}


def test_classifier_is_one_codegen_stage_without_python(spark):
    df = spark.createDataFrame([(0, b"{}")], "offset long, value binary")
    plan = valid_rows(classify(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BatchEvalPython" not in plan
    assert F is not None


def test_timestamp_with_a_trailing_line_end_is_a_violation(spark):
    from logroll.operators.classify import _timestamp_value
    df = spark.createDataFrame([("2026-07-01T01:02:03.789Z",), ("2026-07-01T01:02:03.789Z\n",)], "t string")
    assert [r[0] is None for r in df.select(_timestamp_value(F.col("t"))).collect()] == [False, True]


def test_window_argument_takes_plain_numerals_only():
    from logroll.functions.timefn import window_minutes
    assert [window_minutes(x) for x in ("1_000", "１０", "0x1F", "1e2", " 30 ", "+5", "0b11", "nan")] == [
        15, 15, 31, 100, 30, 5, 3, 15]


def test_json_beyond_the_first_parsers_limits(spark):
    """Numbers and strings of any ordinary size are JSON, and so are 990 levels; faults in such messages are
    still faults, and what nests far deeper ends as one without harm to the task."""
    base = json.dumps(SAMPLE)[:-1]
    deep = lambda n: f'{base}, "x": {"[" * n}{"]" * n}}}'
    long_text = "y" * 20_500_000
    cases = {
        "digits": f'{base}, "x": {"7" * 1201}}}', "fraction": f'{base}, "x": 0.{"7" * 1201}}}', "deep": deep(990),
        "text": json.dumps({**SAMPLE, "message": long_text}),
        "huge status": json.dumps({**SAMPLE, "statusCode": 0}).replace('"statusCode": 0', '"statusCode": ' + "9" * 1201),
        "open": deep(990)[:-2], "trailing": deep(990) + " x", "leading zero": f'{base}, "x": 0{"7" * 1201}}}',
        "two values": deep(990) + "," + deep(990), "two objects": deep(500) + ',{"a":' * 800 + "1" + "}" * 800,
        "deep level": json.dumps({**SAMPLE, "level": 0}).replace('"level": 0', '"level": ' + "[" * 990 + "]" * 990),
        "deep host": json.dumps({**SAMPLE, "host": 0}).replace('"host": 0', '"host": ' + '{"a":' * 990 + "1" + "}" * 990),
        "far too deep": deep(60_000),
    }
    raw = spark.createDataFrame([(n, t.encode()) for n, t in cases.items()], "name string, value binary")
    got = {r["name"]: (r["reason"], r["n"]) for r in classify(raw).select("name", "reason", F.length("message").alias("n")).collect()}
    for name in ("digits", "fraction", "deep"):
        assert got[name] == (None, len(SAMPLE["message"])), name
    assert got["text"] == (None, len(long_text))
    assert got["huge status"][0].startswith("SCHEMA_VIOLATION: statusCode:")
    assert (got["deep level"][0], got["deep host"][0]) == ("SCHEMA_VIOLATION: level:type", "SCHEMA_VIOLATION: host:type")
    for name in ("open", "trailing", "leading zero", "two values", "two objects", "far too deep"):
        assert got[name][0] == "INVALID_JSON_STRING_FORMAT", name


def test_messages_just_beside_the_usual_one(spark):
    """An extra key, the sentinel as a second value, members given twice, other number forms: the rules say how
    these end, and values are the last given."""
    text = json.dumps(SAMPLE)
    cases = {
        "usual": text, "extra": text[:-1] + ', "zone": {"a": [1, null]}}',
        "none": '{"Timestamp": 1}',
        "sentinel": text + ', "\\u0000end"', "sentinel spelled otherwise": text + ',"\\u0000\\u0065nd"',
        "sentinel inside": json.dumps({**SAMPLE, "message": "\0end"}),
        "twice": text[:-1] + ', "message": 5, "service": "last", "message": "m2"}',
        "twice, last wrong": text[:-1] + ', "service": 7}',
        "number texts": json.dumps({**SAMPLE, "statusCode": "200", "latencyMs": "5"}),
        "forms": json.dumps({**SAMPLE, "statusCode": 0}).replace('"statusCode": 0', '"statusCode": 2.03e2'),
        "escapes": json.dumps({**SAMPLE, "message": 'a"\\\né\U0001f600'}),
        "array": f"[{text}]", "single quotes": text.replace('"', "'"),
    }
    raw = spark.createDataFrame([(n, t.encode()) for n, t in cases.items()], "name string, value binary")
    got = {r["name"]: r for r in classify(raw).collect()}
    for name in ("usual", "extra", "sentinel inside", "twice", "forms", "escapes"):
        assert got[name]["reason"] is None, name
    assert (got["twice"]["service"], got["twice"]["message"]) == ("last", "m2")
    assert got["forms"]["status_code"] == 203 and got["sentinel inside"]["message"] == "\0end"
    assert got["escapes"]["message"] == 'a"\\\né\U0001f600'
    assert got["none"]["reason"].startswith("SCHEMA_VIOLATION: timestamp:required, level:required")
    assert got["twice, last wrong"]["reason"] == "SCHEMA_VIOLATION: service:type"
    assert got["number texts"]["reason"] == "SCHEMA_VIOLATION: statusCode:type, latencyMs:type"
    assert got["array"]["reason"] == "SCHEMA_VIOLATION: root:object"
    for name in ("sentinel", "sentinel spelled otherwise", "single quotes"):
        assert got[name]["reason"] == "INVALID_JSON_STRING_FORMAT", name


def test_classification_looks_up_no_path_per_member(spark):
    """A typed value or a missing path out of a VARIANT costs more than the parse of the message: the plan has
    no path per member and looks behind the sentinel only where the text spells it."""
    df = spark.createDataFrame([(0, b"{}")], "offset long, value binary")
    plan = classify(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "$.message" not in plan and "DoubleType" not in plan and plan.count("try_variant_get") <= 3
