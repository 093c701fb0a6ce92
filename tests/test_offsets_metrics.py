"""Offsets, lag and telemetry operators on small vectors and against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from logroll.operators import metrics as M
from logroll.operators import offsets as O

T0 = dt.datetime(2026, 1, 1, 0, 0, 0)


def test_max_offset_any_order(spark):
    df = spark.createDataFrame([("t", 0, 5), ("t", 1, 99), ("t", 0, 12), ("t", 0, 7)], "topic string, partition int, offset long")
    got = {r["partition"]: (r["max_offset"], r["next_offset"]) for r in O.max_offsets(df).collect()}
    assert got == {0: (12, 13), 1: (99, 100)}


def test_offsets_compare_numerically(spark):
    df = spark.createDataFrame([("t", 0, "9"), ("t", 0, "10")], "topic string, partition int, offset string")
    assert O.max_offsets(df).collect()[0]["max_offset"] == 10


def test_lag_skips_uncommitted_partition(spark):
    heads = spark.createDataFrame([("t", 0, 120), ("t", 1, 50), ("t", 2, 10)], "topic string, partition int, head long")
    committed = spark.createDataFrame([("t", 0, 100), ("t", 1, 50)], "topic string, partition int, committed long")
    got = {r["partition"]: r["lag"] for r in O.consumer_lag(heads, committed).collect()}
    assert got == {0: 20, 1: 0}
    cu = O.caught_up(heads, committed).collect()[0]
    assert cu["caught_up"] is False and cu["partitions_behind"] == 2
    cu = O.caught_up(heads.where("partition = 1"), committed).collect()[0]
    assert cu["caught_up"] is True


def samples(spark, pts, metric="c", labels=None):
    rows = [(T0 + dt.timedelta(seconds=s), metric, labels or {"k": "v"}, float(v)) for s, v in pts]
    return spark.createDataFrame(rows, "ts timestamp, metric string, labels map<string,string>, value double")


def test_counter_rate(spark):
    pts = [(0, 0), (30, 300), (60, 600)]
    for step, n in (("1 hour", 1), ("1 minute", 2), ("45 seconds", 2)):
        assert [r["rate"] for r in M.counter_rate(samples(spark, pts), step).collect()] == [10.0] * n


def test_counter_rate_resets_ties_and_single_samples(spark):
    assert M.counter_rate(samples(spark, [(0, 100), (30, 400), (60, 50)]), "1 hour").first()["rate"] == 350 / 60
    tied = samples(spark, [(0, 7), (5, 9), (5, 8)])
    assert M.counter_rate(tied, "1 minute").first()["rate"] == 2 / 5
    assert M.counter_rate(samples(spark, [(0, 7)]), "1 minute").first()["rate"] is None
    unlabelled = tied.withColumn("labels", F.lit(None).cast("map<string,string>"))
    both = tied.unionByName(unlabelled).unionByName(tied.withColumn("ts", F.lit(None).cast("timestamp")))
    assert M.counter_rate(both, "1 minute").first()["rate"] == 2 * 2 / 5
    by = {r["k"]: r["rate"] for r in M.counter_rate(both, "1 minute", by=["k"]).collect()}
    assert by == {"v": 2 / 5, None: 2 / 5}
    assert M.counter_rate(both.limit(0), "1 minute").count() == 0


def test_counter_rate_equals_row_by_row(spark):
    pts = [(i * 37 % 9000, (i * 37 % 9000) % 1000) for i in range(300)]
    df = samples(spark, pts)
    rows = sorted(set(pts))
    want = {}
    for (s0, v0), (s1, v1) in zip(rows, rows[1:]):
        inc, cov = want.get(s1 // 600, (0.0, 0))
        want[s1 // 600] = (inc + (v1 if v1 < v0 else v1 - v0), cov + s1 - s0)
    got = {int((r["time"] - T0).total_seconds()) // 600: r["rate"] for r in M.counter_rate(df, "10 minutes").collect()}
    assert got == {k: inc / cov for k, (inc, cov) in want.items()}


def test_counter_reset(spark):
    inc = M.counter_increase(samples(spark, [(0, 100), (30, 400), (60, 50)]))
    assert sum(r["increase"] for r in inc.collect()) == 350


def test_counter_increase_across_slices(spark):
    pts = [(i * 1700, i * 10) for i in range(6)]  # spans several hour slices
    inc = M.counter_increase(samples(spark, pts)).orderBy("ts").collect()
    assert [r["increase"] for r in inc] == [0, 10, 10, 10, 10, 10]


def buckets(spark, pairs):
    return spark.createDataFrame([("g", le, float(c)) for le, c in pairs], "g string, le string, count double")


def test_histogram_quantile(spark):
    b = buckets(spark, [("0.05", 0), ("0.1", 50), ("0.25", 100), ("+Inf", 100)])
    assert M.histogram_quantile(b, 0.5, ["g"]).collect()[0]["quantile"] == 0.1
    assert abs(M.histogram_quantile(b, 0.75, ["g"]).collect()[0]["quantile"] - 0.175) < 1e-12


def test_histogram_quantile_in_inf_bucket(spark):
    b = buckets(spark, [("5", 90), ("+Inf", 100)])
    assert M.histogram_quantile(b, 0.95, ["g"]).collect()[0]["quantile"] == 5


def test_histogram_quantile_without_observations(spark):
    idle = buckets(spark, [("5", 0), ("+Inf", 0)])
    both = M.histogram_quantile(idle, [0.5, 0.95], ["g"], out=["p50", "p95"]).collect()
    assert [(r["p50"], r["p95"]) for r in both] == [(None, None)]
    assert M.histogram_quantile(buckets(spark, [("5", 3)]), 0.5, ["g"]).collect()[0]["quantile"] is None


def test_histogram_buckets_cumulative(spark):
    df = spark.createDataFrame([(v,) for v in [0.01, 0.07, 0.3, 7.0]], "v double")
    got = {r["le"]: r["count"] for r in M.histogram_buckets(df, "v", [0.05, 0.1, 0.25, 0.5, 1, 2.5, 5]).collect()}
    assert got == {"0.05": 1, "0.1": 2, "0.25": 2, "0.5": 3, "1": 3, "2.5": 3, "5": 3, "+Inf": 4}


def test_gauge_latest(spark):
    s = samples(spark, [(0, 5), (30, 0)], metric="g")
    assert M.latest(s, ["metric"]).collect()[0]["value"] == 0


def test_metric_total_over_labels(spark):
    a = samples(spark, [(0, 1), (10, 3)], metric="pipeline_messages_dlq_total", labels={"reason": "A"})
    b = samples(spark, [(0, 2)], metric="pipeline_messages_dlq_total", labels={"reason": "B"})
    c = samples(spark, [(0, 100)], metric="other")
    assert M.metric_total(a.unionByName(b).unionByName(c), "pipeline_messages_dlq").collect()[0]["total"] == 5
    assert F is not None


def test_ties_and_null_labels_keep_increases(spark):
    rows = [(T0, "c", None, 7.0), (T0 + dt.timedelta(seconds=5), "c", None, 9.0), (T0 + dt.timedelta(seconds=5), "c", None, 8.0),
            (None, "c", None, 1.0)]
    df = spark.createDataFrame(rows, "ts timestamp, metric string, labels map<string,string>, value double")
    got = M.counter_increase(df).collect()
    assert len(got) == 4
    assert sum(r["increase"] for r in got if r["ts"] is not None and r["value"] > 7) == 2.0


def _samples(spark, rows):
    t0 = dt.datetime(2026, 1, 1)
    return spark.createDataFrame([(t0 + dt.timedelta(seconds=s), "c", {"k": k} if k else None, v) for s, k, v in rows],
                                 "ts timestamp, metric string, labels map<string,string>, value double")


def _brute_sliding(rows, window, every):
    """{(seconds, label): rate} by looking through every window."""
    series = {}
    for s, k, v in rows:
        if s is not None and v is not None:
            series.setdefault(k, {})[s] = max(v, series.get(k, {}).get(s, v))
    out = {}
    for k, at in series.items():
        points, steps = sorted(at.items()), []
        for i, (s, v) in enumerate(points):
            p = points[i - 1] if i else None
            steps.append((s, 0.0 if p is None else v if v < p[1] else v - p[1], 0 if p is None else s - p[0]))
        for t in range(0, points[-1][0] + window + every, every):
            seen = [x for x in steps if t - window < x[0] <= t]
            if seen:
                covered = sum(x[2] for x in seen)
                out[(t, k)] = round(sum(x[1] for x in seen) / covered, 9) if covered else None
    return out


def test_sliding_rate_equals_every_window(spark):
    rnd = random.Random(8)
    rows, value = [], 0.0
    for s in sorted(rnd.sample(range(4000), 160)):
        value = 0.5 if rnd.random() < 0.1 else value + rnd.random() * 9        # resets anywhere, window edges included
        rows.append((s, "a", value))
    rows += [(60, "b", 5.0), (120, "b", 2.0), (120, "b", 1.0), (3000, "b", 9.0), (777, None, 4.0), (840, None, 6.0), (900, "z", 1.0)]
    got = M.sliding_rate(_samples(spark, rows), "5 minutes", "1 minute", by=["k"]).collect()
    t0 = dt.datetime(2026, 1, 1)
    seen = {(int((r["time"].replace(tzinfo=None) - t0).total_seconds()), r["k"]): r["rate"] for r in got}
    want = _brute_sliding(rows, 300, 60)
    assert set(seen) == set(want) and all(
        seen[x] is None if want[x] is None else abs(seen[x] - want[x]) < 1e-8 for x in want)


def test_sliding_rate_has_no_self_join_and_rejects_uneven_windows(spark):
    df = M.sliding_rate(_samples(spark, [(0, "a", 1.0), (30, "a", 4.0)]), "1 minute", "5 seconds")
    assert df.count() == 18 and M.sliding_rate(_samples(spark, []), "1 minute", "5 seconds").count() == 0
    with pytest.raises(ValueError):
        M.sliding_rate(_samples(spark, []), "1 minute", "7 seconds")


def test_lag_asof(spark):
    t = lambda m: dt.datetime(2026, 1, 1, 0, 0) + dt.timedelta(minutes=m)
    heads = spark.createDataFrame([("x", 0, t(10), 100), ("x", 0, t(130), 180), ("x", 0, t(131), 190), ("x", 1, t(5), 7),
                                   ("x", 2, t(9), 40)], "topic string, partition int, ts timestamp, head long")
    commits = spark.createDataFrame([("x", 0, t(1), 90), ("x", 0, t(131), 170), ("x", 0, t(131), 160), ("x", 2, t(10), 41),
                                     ("x", 3, t(1), 5)], "topic string, partition int, ts timestamp, committed long")
    got = {(r["partition"], r["head"]): (r["committed"], r["lag"]) for r in O.lag_asof(heads, commits).collect()}
    # a commit before the first head; one at the head's instant (the largest); partitions without an earlier commit
    assert got == {(0, 100): (90, 10), (0, 180): (90, 90), (0, 190): (170, 20), (1, 7): (None, None), (2, 40): (None, None)}
