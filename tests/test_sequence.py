"""Slice-and-stitch ordered helpers equal a plain per-series window (brute force)."""

import datetime as dt
import random

from pyspark.sql import Window, functions as F

from logroll.operators.sequence import carried_value, previous_value, running_count, running_totals


def fixture(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    t0 = dt.datetime(2026, 1, 1)
    rows = [(i, rnd.choice(["hot", "hot", "hot", "a", "b"]), t0 + dt.timedelta(seconds=rnd.randrange(3 * 86400)),
             float(rnd.randrange(1000))) for i in range(n)]
    return spark.createDataFrame(rows, "id long, s string, ts timestamp, v double")


def test_running_count_matches_row_number(spark):
    df = fixture(spark)
    got = dict(running_count(df, ["s"], ["ts", "id"], "ts", out="n").select("id", "n").collect())
    want = dict(df.select("id", F.row_number().over(Window.partitionBy("s").orderBy("ts", "id"))).collect())
    assert got == want


def test_previous_value_matches_lag(spark):
    df = fixture(spark).dropDuplicates(["s", "ts"])
    got = dict(previous_value(df, ["s"], "ts", "v", out="p").select("id", "p").collect())
    want = dict(df.select("id", F.lag("v").over(Window.partitionBy("s").orderBy("ts"))).collect())
    assert got == want and sum(v is None for v in got.values()) == 3


def test_running_totals_match_a_window(spark):
    df = (fixture(spark).groupBy("s", F.unix_seconds("ts").alias("t")).agg(F.sum("v").alias("v"))
          .withColumn("s", F.when(F.col("s") != "b", F.col("s"))))                    # a null series as well
    w = Window.partitionBy("s").orderBy("t")
    got = {(r["s"], r["t"]): (r["v"], r["nxt"]) for r in running_totals(df, ["s"], "t", ["v"], 5000, "nxt").collect()}
    want = {(r["s"], r["t"]): (r["total"], r["nxt"]) for r in
            df.select("s", "t", F.sum("v").over(w).alias("total"), F.lead("t").over(w).alias("nxt")).collect()}
    assert got == want


def test_carried_value_matches_last(spark):
    df = fixture(spark).withColumn("v", F.when(F.col("id") % 7 == 0, F.col("v")))
    w = Window.partitionBy("s").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    got = dict(carried_value(df, ["s"], ["ts", "id"], "ts", "v", "c").select("id", "c").collect())
    want = dict(df.select("id", F.last("v", ignorenulls=True).over(w)).collect())
    assert got == want and any(v is None for v in got.values())
