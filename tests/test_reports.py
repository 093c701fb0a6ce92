"""Report semantics on the seeded rollup (10 rows) and the window-argument rule."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from logroll.functions.timefn import window_minutes
from logroll.operators import reports as R
from logroll.operators.rollup import latency_frequencies, merge_rollup, rollup_1m
from logroll.schemas import LOGS

SF_SMALL = "/root/testdata/sf0.001"
NOW = dt.datetime(2026, 7, 31, 12, 30, 0)


# (minutes ago, service, status, latency): uneven latencies, a service that only fails sometimes, two minutes.
TRAFFIC = [(1, "search", 200, 310), (1, "search", 404, 80), (2, "search", 200, 120), (2, "search", 499, 95),
           (1, "mail", 502, 2400), (2, "mail", 500, 1800), (2, "mail", 250, 600), (1, "billing", 200, 55)]


@pytest.fixture(scope="module")
def seeded(spark):
    rows = [(NOW - dt.timedelta(minutes=ago, seconds=5 * i), "DEBUG", service, "h", f"id-{i}", status, latency, "")
            for i, (ago, service, status, latency) in enumerate(TRAFFIC)]
    logs = spark.createDataFrame(rows, LOGS)
    return rollup_1m(logs), latency_frequencies(logs)


def test_throughput_per_minute(seeded):
    r, _ = seeded
    got = [x["count"] for x in R.throughput(r, 15, NOW).collect()]
    assert sum(got) == len(TRAFFIC) and len(got) > 1


def test_errors_by_service_lists_zero_error_services(seeded):
    r, _ = seeded
    got = [(x["service"], x["error_count"]) for x in R.errors_by_service(r, 15, NOW).collect()]
    assert got == [("mail", 2), ("billing", 0), ("search", 0)]


def test_top_services(seeded):
    r, _ = seeded
    assert [tuple(x) for x in R.top_services(r, 15, NOW, n=2).collect()] == [("search", 4), ("mail", 3)]


def test_percentiles_interpolate(seeded):
    _, f = seeded
    got = {x["service"]: x["percentiles"] for x in R.latency_percentiles(f, 15, NOW).collect()}
    assert got["billing"] == [55.0, 55.0, 55.0]
    assert got["search"] == pytest.approx([107.5, 253.0, 304.3])
    assert got["mail"] == pytest.approx([1800.0, 2280.0, 2388.0])


def test_percentiles_by_rank_equal_the_builtin(spark):
    """Ties, counts, negative and huge values, null groups, one group with nearly all rows."""
    import random
    rnd = random.Random(3)
    rows = [(rnd.choice(["hot"] * 30 + ["a", None]), rnd.choice([0, 1, -7, rnd.randrange(10**6), 2**62 - rnd.randrange(9)]),
             rnd.randrange(0, 4)) for _ in range(4000)] + [("none", None, 3), ("zero", 5, 0)]
    df = spark.createDataFrame(rows, "service string, v long, n long")
    qs = [0.0, 0.25, 0.5, 0.999, 1.0]
    got = {r[0]: r[1] for r in R.percentiles_by_rank(df, ["service"], "v", "n", qs).collect()}
    want = {r[0]: r[1] for r in df.where("v is not null and n > 0").groupBy("service").agg(
        F.percentile("v", F.array(*map(F.lit, qs)), F.col("n"))).collect()}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], rel=1e-12) for k in want)


def test_sketch_percentiles_are_observed_values(seeded):
    r, _ = seeded
    for x in R.latency_percentiles_sketch(r, 15, NOW).collect():
        assert set(x["percentiles"]) <= {latency for _, s, _, latency in TRAFFIC if s == x["service"]}


def test_window_argument_reaches_the_report(seeded):
    r, _ = seeded
    assert R.row_count(R.in_window(r, 60, NOW)).first()[0] == R.row_count(R.in_window(r, "soon", NOW)).first()[0] > 0


def test_window_excludes_old_buckets_and_keeps_future(spark):
    rows = [(NOW - dt.timedelta(minutes=20), "INFO", "s", "h", "t", 200, 1, "m"),
            (NOW + dt.timedelta(minutes=5), "INFO", "s", "h", "t", 200, 1, "m"),
            (NOW - dt.timedelta(minutes=15, seconds=30), "INFO", "s", "h", "t", 200, 1, "m")]
    r = rollup_1m(spark.createDataFrame(rows, LOGS))
    times = [x["time"] for x in R.throughput(r, 15, NOW).collect()]
    assert times == [(NOW + dt.timedelta(minutes=5)).replace(second=0)]


@pytest.mark.parametrize("arg,expect", [(None, 15), ("abc", 15), (math.nan, 15), (0, 15), (-5, 15), ("", 15),
                                        ("60", 60), (60, 60), (" 30 ", 30), ("1e2", 100)])
def test_window_argument(arg, expect):
    assert window_minutes(arg) == expect


def test_fractional_window_is_an_error():
    with pytest.raises(ValueError):
        window_minutes(1.5)


def test_error_count_reads_status_not_level(spark):
    rows = [(NOW, "ERROR", "s", "h", "t", 200, 1, "m"), (NOW, "INFO", "s", "h", "t", 500, 1, "m")]
    r = merge_rollup(rollup_1m(spark.createDataFrame(rows, LOGS), sketch=False))
    assert sum(x["error_count"] for x in r.collect()) == 1


def test_mean_latency_from_sums(seeded):
    r, _ = seeded
    got = {x["service"]: x["avg_latency_ms"] for x in R.avg_latency(r, 15, NOW).collect()}
    assert got == {"search": 151.25, "mail": 1600.0, "billing": 55.0}


def test_report_scan_prunes_sketch_column(spark, scratch):
    path = scratch("rollup") + "/r"
    rows = [(NOW, "INFO", "s", "h", "t", 200, 1, "m")]
    rollup_1m(spark.createDataFrame(rows, LOGS)).write.parquet(path)
    plan = R.throughput(spark.read.parquet(path), 15, NOW)._jdf.queryExecution().executedPlan().toString()
    assert "latency_quantiles" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert "PushedFilters: [IsNotNull(minute), GreaterThanOrEqual(minute" in plan
    assert F is not None


def test_report_rows_as_json(seeded):
    import json
    from logroll.sources.sinks import json_rows
    r, _ = seeded
    rows = [json.loads(x["value"]) for x in json_rows(R.top_services(r, 15, NOW)).collect()]
    assert rows[0] == {"service": "search", "volume": 4}


def test_rollup_plan_aggregates_before_the_shuffle(spark):
    rows = [(NOW, "INFO", "s", "h", "t", 200, 1, "m")]
    plan = rollup_1m(spark.createDataFrame(rows, LOGS))._jdf.queryExecution().executedPlan().toString()
    # partial aggregation (map side) for the counters and the sketch, before the exchange
    assert "partial_count" in plan and "partial_kll_sketch_agg_bigint" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_window_argument_edge_forms():
    assert window_minutes(True) == 1            # Number(true) is 1
    assert window_minutes("0x10") == 16         # hexadecimal text is a number
    assert window_minutes("inf") == 15          # not a JavaScript number literal
    with pytest.raises(ValueError):
        window_minutes("Infinity")              # a number, but no whole-minute interval


def test_one_day_scan_is_bounded_by_time(spark):
    import re
    from logroll.plans.reports import q_throughput_1d
    if not os.path.isdir(SF_SMALL):
        pytest.skip("test data not present")
    df = q_throughput_1d(spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the whole subquery is compared with the bare column, so the scan gets its value as a literal
    assert re.search(r"DataFilters: \[[^\]]*\(ts#\d+ >= [^\]]*[sS]ubquery", plan), plan


def test_values_as_text(spark):
    from logroll.functions.text import clock_text, grouped_number
    rows = [(0, "2026-07-31 00:05:09"), (999, "2026-07-31 12:00:00"), (-1234567, "2026-07-31 13:59:59"), (None, None)]
    df = spark.createDataFrame(rows, "n bigint, t string").select(grouped_number("n"), clock_text(F.col("t").cast("timestamp")))
    assert [tuple(r) for r in df.collect()] == [("0", "12:05:09 AM"), ("999", "12:00:00 PM"), ("-1,234,567", "1:59:59 PM"), (None, None)]


def test_sketch_ranks_tell_good_from_bad(spark):
    """Answers of the data's own sketch are within the bound; those of another data's sketch are not."""
    one = spark.range(5_000).select(F.lit(NOW).cast("timestamp").alias("timestamp"), F.lit("INFO").alias("level"), F.lit("s").alias("service"),
                                    F.lit(200).alias("status_code"), F.col("id").alias("latency_ms"))
    other = one.withColumn("latency_ms", F.col("latency_ms") * 2)
    within = lambda rollup: R.sketch_ranks(rollup, latency_frequencies(one), 15, NOW).first()
    assert within(rollup_1m(one))["rows"] == 5_000 and within(rollup_1m(one))["within"] == [True] * 3
    assert within(rollup_1m(other))["within"] == [False] * 3
