"""Benchmark: headline operators at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]``.  Prints one JSON line.

Measured (each executed to a no-op sink, so nothing is collected):
  classify         raw messages → classified rows (strict JSON + rules), rows/s reported too
  ingest_stream    file source → foreachBatch with all five sinks, availableNow, rows/s reported
  report_*         the four reports and mean latency, read from the written rollup tables
  raw_*            the same reports computed from the raw ``logs`` table (benefit of the rollup)
  compact          compaction of the rollup; file counts before/after reported
  telemetry_*      counter rate with resets, histogram quantile
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import SparkSession, functions as F

    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("logroll-bench")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(int(cpus)))
             .config("spark.driver.memory", "8g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")

    from logroll.operators import metrics as M
    from logroll.operators import reports as R
    from logroll.operators.classify import classify
    from logroll.operators.rollup import latency_frequencies, rollup_1m
    from logroll.plans.common import events
    from logroll.plans.reports import ALL_MINUTES
    from logroll.session import configure, scratch_dir
    from logroll.sources.events import dlq_counter_samples, logs_from_events, wire_messages
    from logroll.sources.tables import LogStore
    from logroll.streaming.ingest import IngestJob, file_source, start_ingest

    configure(spark)
    times: dict[str, float] = {}
    extra: dict[str, float] = {}

    def run(name, fn):
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    def sink(df):
        return lambda: df.write.format("noop").mode("overwrite").save()

    ev = events(spark, sf_dir)
    n_events = ev.count()
    base = scratch_dir(spark, "bench")

    # Inputs written once (not timed): raw messages as files, the derived logs as a table.
    # Four micro-batches, each split into one input partition per core (as ``minPartitions`` does
    # for a topic source).  Messages arrive in offset (= time) order, as from a live topic; the
    # all-late case (every batch spanning the whole month) is covered by the stream queries.
    batches = 4
    parts = batches * int(cpus)
    wire_messages(ev).repartitionByRange(parts, "offset").write.parquet(f"{base}/source")
    raw = spark.read.parquet(f"{base}/source")
    # Warm-up on a small slice (own folders) so JVM start-up and code generation are not timed.
    warm = f"{base}/warm"
    raw.limit(2000).repartition(2).write.parquet(f"{warm}/source")
    classify(spark.read.parquet(f"{warm}/source")).write.format("noop").mode("overwrite").save()
    start_ingest(file_source(spark, f"{warm}/source", max_files_per_trigger=1), IngestJob(LogStore(spark, f"{warm}/t")),
                 f"{warm}/ckpt", available_now=True).awaitTermination()

    run("classify", sink(classify(raw)))
    extra["classify_rows_per_sec"] = round(n_events / max(times["classify"], 1e-9))

    store = LogStore(spark, f"{base}/tables")
    q = start_ingest(file_source(spark, f"{base}/source", max_files_per_trigger=parts // batches),
                     IngestJob(store), f"{base}/ckpt", available_now=True)
    t0 = time.perf_counter()
    q.awaitTermination()
    times["ingest_stream"] = round(time.perf_counter() - t0, 3)
    extra["ingest_rows_per_sec"] = round(n_events / max(times["ingest_stream"], 1e-9))

    as_of = store.logs().agg(F.max("timestamp")).first()[0]
    rollup, freq = store.rollup(), store.frequencies()
    run("report_throughput", sink(R.throughput(rollup, ALL_MINUTES, as_of)))
    run("report_errors_by_service", sink(R.errors_by_service(rollup, ALL_MINUTES, as_of)))
    run("report_latency_percentiles", sink(R.latency_percentiles(freq, ALL_MINUTES, as_of)))
    run("report_top_services", sink(R.top_services(rollup, ALL_MINUTES, as_of)))
    run("report_latency_sketch", sink(R.latency_percentiles_sketch(rollup, ALL_MINUTES, as_of)))
    run("report_avg_latency", sink(R.avg_latency(rollup, ALL_MINUTES, as_of)))

    logs = store.logs()
    run("raw_throughput", sink(R.throughput(rollup_1m(logs, sketch=False), ALL_MINUTES, as_of)))
    run("raw_latency_percentiles", sink(R.latency_percentiles(latency_frequencies(logs), ALL_MINUTES, as_of)))

    def footprint(name):
        from logroll.sources.tables import _hadoop_fs
        path, fs = _hadoop_fs(spark, store.path(name))
        if not fs.exists(path):
            return 0, 0
        files = fs.listFiles(path, True)
        n = size = 0
        while files.hasNext():
            st = files.next()
            if st.getPath().getName().endswith(".parquet"):
                n += 1
                size += st.getLen()
        return n, size

    extra["rollup_files_live"], extra["rollup_bytes_live"] = footprint("logs_1m")
    # Sketch versus exact percentiles per service (relative error of each level).
    exact = {r["service"]: r["percentiles"] for r in R.latency_percentiles(freq, ALL_MINUTES, as_of).collect()}
    sketch = {r["service"]: r["percentiles"] for r in R.latency_percentiles_sketch(rollup, ALL_MINUTES, as_of).collect()}
    extra["sketch_max_rel_error"] = round(max(abs(s - e) / max(e, 1.0) for svc in exact
                                              for s, e in zip(sketch[svc], exact[svc])), 4)

    run("compact", lambda: store.compact(as_of))
    extra["rollup_files_compacted"], extra["rollup_bytes_compacted"] = footprint("logs_1m_compacted")
    run("report_throughput_compacted", sink(R.throughput(store.rollup(), ALL_MINUTES, as_of)))

    lg = logs_from_events(ev)
    # Metric samples are a stored table in the pipeline (``pipeline_metrics``): write them once.
    dlq_counter_samples(ev).write.parquet(f"{base}/samples")
    samples = spark.read.parquet(f"{base}/samples")
    run("telemetry_counter_rate", sink(M.counter_rate(samples, "1 hour", by=["reason"])))
    run("telemetry_histogram_quantile",
        sink(M.histogram_quantile(M.histogram_buckets(lg, "latency_ms", [50, 100, 250, 500, 1000, 2500, 5000],
                                                      ["service"]), 0.95, ["service"])))

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "events": n_events, "cpus": int(cpus), **extra}))
    spark.stop()


if __name__ == "__main__":
    main()
