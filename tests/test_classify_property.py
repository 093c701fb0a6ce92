"""Property test: the Spark classifier agrees with a small pure-Python validator on random events."""

import datetime as dt
import json
import math
import re

from hypothesis import HealthCheck, given, settings, strategies as st

from logroll.operators.classify import classify

LEVELS = ["DEBUG", "INFO", "WARN", "ERROR", "FATAL"]
FIELDS = ["timestamp", "level", "service", "host", "traceId", "statusCode", "latencyMs", "message"]
ISO = re.compile(r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2})(:\d{2})?(\.\d+)?Z$")


def _reject_constant(name):
    raise ValueError(name)


def expected(text):
    """Reason the pipeline should give (brute force, independent of Spark)."""
    if text is None or text == "":
        return "EMPTY_KAFKA_PAYLOAD"
    try:
        obj = json.loads(text, parse_constant=_reject_constant)
    except ValueError:
        return "INVALID_JSON_STRING_FORMAT"
    if not isinstance(obj, dict):
        return "SCHEMA_VIOLATION: root:object"
    bad = []
    for f in FIELDS:
        if f not in obj:
            bad.append(f"{f}:required")
            continue
        v = obj[f]
        if f in ("statusCode", "latencyMs"):
            if isinstance(v, bool) or not isinstance(v, (int, float)):
                bad.append(f"{f}:type")
                continue
            x = float(v)
            if not (x == math.floor(x) and abs(x) <= 2 ** 53 - 1) if math.isfinite(x) else True:
                bad.append(f"{f}:int")
            if f == "statusCode" and not (100 <= x <= 599):
                bad.append(f"{f}:range")
            if f == "latencyMs" and not x >= 0:
                bad.append(f"{f}:nonnegative")
            continue
        if not isinstance(v, str):
            bad.append(f"{f}:type")
        elif f == "timestamp":
            m = ISO.match(v)
            ok = False
            if m:
                try:
                    dt.datetime.strptime(m.group(1) + (m.group(2) or ":00"), "%Y-%m-%dT%H:%M:%S")
                    ok = True
                except ValueError:
                    ok = False
            if not ok:
                bad.append("timestamp:datetime")
        elif f == "level" and v not in LEVELS:
            bad.append("level:enum")
        elif f in ("service", "host", "traceId") and len(v) < 1:
            bad.append(f"{f}:min_length")
    return None if not bad else "SCHEMA_VIOLATION: " + ", ".join(bad)


values = {
    "timestamp": st.one_of(st.sampled_from(["2026-07-31T12:34:56.789Z", "2026-07-31T12:34Z", "2026-02-30T00:00:00Z",
                                            "2026-07-31T12:34:56+02:00", "2026-07-31 12:34:56Z", "x"]),
                           st.integers(0, 10)),
    "level": st.one_of(st.sampled_from(LEVELS + ["TRACE", "info", ""]), st.none()),
    "service": st.one_of(st.text(max_size=4), st.integers(-3, 3), st.none()),
    "host": st.one_of(st.text(max_size=3), st.booleans()),
    "traceId": st.one_of(st.text(max_size=3), st.lists(st.integers(), max_size=1)),
    "statusCode": st.one_of(st.integers(50, 650), st.floats(99, 600, allow_nan=False), st.text(max_size=3),
                            st.just(503.0)),
    "latencyMs": st.one_of(st.integers(-5, 2 ** 60), st.floats(-2, 1e20, allow_nan=False), st.none()),
    "message": st.one_of(st.text(max_size=5), st.none(), st.integers()),
}
event = st.fixed_dictionaries({}, optional=values)
texts = st.one_of(
    event.map(json.dumps),
    st.tuples(event, st.sampled_from([" ", "\n", " x", "]", "}", ",1"])).map(lambda p: json.dumps(p[0]) + p[1]),
    st.sampled_from(["", "   ", "null", "[1]", "{", '{"a":1} x', "123"]),
)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(texts, min_size=300, max_size=300))
def test_classifier_matches_python_validator(spark, batch):
    rows = [(i, t.encode()) for i, t in enumerate(batch)]
    got = {r["offset"]: r["reason"] for r in
           classify(spark.createDataFrame(rows, "offset long, value binary")).collect()}
    for i, t in enumerate(batch):
        assert got[i] == expected(t), (t, got[i])
