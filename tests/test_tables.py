"""Table layout: partition pruning, retention, compaction, catalog verification."""

import datetime as dt

from pyspark.sql import functions as F

from logroll.operators.retention import retain
from logroll.operators.rollup import rollup_1m
from logroll.schemas import LOGS
from logroll.sources.tables import TABLE_NAMES, LogStore

T0 = dt.datetime(2026, 7, 1, 6, 0, 0)


def logs_over_days(spark, days=10, per_day=3):
    rows = [(T0 + dt.timedelta(days=d, hours=h), "INFO", f"s{h % 2}", "h", f"t{d}-{h}", 200 + 300 * (h % 2), 10 * h, "m")
            for d in range(days) for h in range(per_day)]
    return spark.createDataFrame(rows, LOGS)


def test_reader_prunes_day_partitions(spark, scratch):
    store = LogStore(spark, scratch("prune"))
    store.write_logs(logs_over_days(spark), 0)
    df = store.logs(since=T0 + dt.timedelta(days=8))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and "event_date#" in plan
    assert df.count() == 6


def test_retention_filter_and_partition_drop(spark, scratch):
    store = LogStore(spark, scratch("ret"))
    logs = logs_over_days(spark)
    store.write_logs(logs, 0)
    as_of = T0 + dt.timedelta(days=9, hours=1)
    survivors = retain(logs, as_of)
    # rows newer than as_of - 7 days (truncated to seconds) survive
    assert survivors.count() == sum(1 for r in logs.collect()
                                    if r["timestamp"].replace(microsecond=0) + dt.timedelta(days=7) > as_of)
    removed = store.drop_expired(as_of)
    assert removed == [f"event_date=2026-07-0{d}" for d in (1, 2)]
    left = store.logs().count()
    assert left == 8 * 3
    assert retain(store.logs(), as_of).count() == survivors.count()


def test_compaction_keeps_totals_and_late_rows(spark, scratch):
    store = LogStore(spark, scratch("compact"))
    logs = logs_over_days(spark, days=4, per_day=6)
    for b in range(3):
        part = logs.where(F.substring_index("trace_id", "-", -1).cast("int") % 3 == b)
        store.write_rollup(rollup_1m(part), b)
    before = store.rollup(merged=True).agg(F.sum("total_count"), F.sum("latency_sum")).first()
    store.compact(T0 + dt.timedelta(days=3))
    assert store.rollup(merged=True).agg(F.sum("total_count"), F.sum("latency_sum")).first() == before
    # late rows for a compacted day stay live and are merged at read time
    store.write_rollup(rollup_1m(logs.limit(2)), 3)
    assert store.rollup(merged=True).agg(F.sum("total_count")).first()[0] == before[0] + 2
    # second compaction folds them in; vacuum removes covered live partitions; totals unchanged
    store.compact(T0 + dt.timedelta(days=3))
    # batches 0-2 still hold rows of the open day 4; the late batch 3 is fully compacted
    assert store.vacuum() == ["logs_1m/batch_id=3"]
    assert store.rollup(merged=True).agg(F.sum("total_count")).first()[0] == before[0] + 2
    q = store.rollup(merged=True).where("service = 's1'").select(
        F.kll_sketch_get_n_bigint(F.kll_merge_agg_bigint("latency_quantiles"))).first()[0]
    assert q > 0


def test_create_and_verify_tables(spark, scratch):
    store = LogStore(spark, scratch("ddl"))
    store.create_tables("lp_test")
    assert [r[0] for r in store.missing_tables(TABLE_NAMES + ["nope"], "lp_test").collect()] == ["nope"]
    store.write_logs(logs_over_days(spark, days=1), 0)
    store.sync_catalog("lp_test")
    assert spark.table("lp_test.logs").count() == 3
    store.truncate("logs", "lp_test")
    assert spark.table("lp_test.logs").count() == 0


def test_report_reader_lists_only_recent_days(spark, scratch):
    store = LogStore(spark, scratch("recent"))
    logs = logs_over_days(spark)
    store.write_logs(logs, 0)
    store.write_rollup(rollup_1m(logs), 0)
    store.compact(T0 + dt.timedelta(days=9))           # days 1..9 compacted, day 10 live
    since = T0 + dt.timedelta(days=8)
    files = store.rollup(since=since).inputFiles()
    compacted = [f for f in files if "_compacted" in f]
    assert compacted and all("event_date=2026-07-09" in f for f in compacted)
    assert store.rollup(since=since).agg(F.sum("total_count")).first()[0] == 6
    assert store.rollup(since=T0 + dt.timedelta(days=30)).count() == 0
    assert store.logs(since=since).count() == 6
    assert all("event_date=2026-07-09" in f or "event_date=2026-07-10" in f
               for f in store.logs(since=since).inputFiles())


def test_live_rollup_is_one_file_per_batch(spark, scratch):
    store = LogStore(spark, scratch("onefile"))
    store.write_rollup(rollup_1m(logs_over_days(spark)), 7, files=1)
    files = [f for f in store.rollup().inputFiles()]
    assert len(files) == 1 and "batch_id=7" in files[0]


def test_two_checkpoints_share_a_store(spark, scratch):
    """Batch ids of a new checkpoint never meet those of an earlier one, before and after maintenance."""
    from logroll.sources.tables import INGEST_SHIFT
    store = LogStore(spark, scratch("two"))
    first, second = scratch("ck1"), scratch("ck2")
    assert [store.ingest_number(c) for c in (first, second, first)] == [0, 1, 0]
    logs = logs_over_days(spark, days=2, per_day=5)
    total = lambda: store.rollup(merged=True).agg(F.sum("total_count")).first()[0]
    store.write_rollup(rollup_1m(logs), 0)
    store.compact(T0 + dt.timedelta(days=5))
    assert store.vacuum(("logs_1m",)) == ["logs_1m/batch_id=0"]
    assert total() == 10
    store.write_rollup(rollup_1m(logs.limit(3)), 1 << INGEST_SHIFT)          # batch 0 of the other checkpoint
    assert total() == 13
    store.compact(T0 + dt.timedelta(days=5))
    assert total() == 13
    store.write_rollup(rollup_1m(logs.limit(4)), 1)                          # batch 1 of the first, later
    assert total() == 17
    store.compact(T0 + dt.timedelta(days=5))
    assert len(store.vacuum(("logs_1m",))) == 2 and total() == 17


def test_compaction_rewrites_only_days_with_new_batches(spark, scratch):
    store = LogStore(spark, scratch("inc"))
    store.write_rollup(rollup_1m(logs_over_days(spark, days=3)), 0)
    store.compact(T0 + dt.timedelta(days=9), ("logs_1m",))
    files = lambda: {r[0] for r in spark.read.parquet(store.path("logs_1m_compacted"))
                     .select(F.input_file_name()).distinct().collect()}
    before = files()
    store.compact(T0 + dt.timedelta(days=9), ("logs_1m",))
    assert files() == before
    store.write_rollup(rollup_1m(logs_over_days(spark, days=1)), 1)
    store.compact(T0 + dt.timedelta(days=9), ("logs_1m",))
    assert len(before & files()) == 2


def test_readers_of_quiet_tables(spark, scratch):
    store = LogStore(spark, scratch("quiet"))
    assert store.dlq().count() == 0 and store.metrics().count() == 0 and store.rollup().count() == 0
    store.write_rollup(rollup_1m(logs_over_days(spark, days=1)), 0)
    store.compact(T0 + dt.timedelta(days=5))
    store.vacuum()
    assert store.rollup().agg(F.sum("total_count")).first()[0] == 3
    store.truncate("logs_1m", database=None)
    assert store.rollup().count() == 0


def test_view_equals_the_reader_before_and_after_vacuum(spark, scratch):
    """Live, compacted, late and deleted batches: the catalog's view and the reader give the same rows."""
    from logroll.operators.rollup import latency_frequencies
    from logroll.sources.tables import INGEST_SHIFT
    store, db = LogStore(spark, scratch("view")), "lp_view"
    store.create_tables(db)
    logs = logs_over_days(spark, days=5, per_day=4)

    def same():
        store.sync_catalog(db)
        for name, mine in (("logs_1m_all", store.rollup()), ("logs_1m_freq_all", store.frequencies())):
            cols = [c for c in mine.columns if c != "latency_quantiles"]
            rows = sorted(map(tuple, mine.select(*cols).collect()))
            assert sorted(map(tuple, spark.table(f"{db}.{name}").select(*cols).collect())) == rows
        return spark.sql(f"SELECT sum(total_count) FROM {db}.logs_1m_all").first()[0]

    def batch(rows, b):
        store.write_rollup(rollup_1m(rows), b)
        store.write_frequencies(latency_frequencies(rows), b)

    assert same() is None
    batch(logs, 0)
    assert same() == 20
    store.compact(T0 + dt.timedelta(days=3))
    assert same() == 20
    batch(logs.limit(3), 1)                                   # late, for compacted days
    batch(logs.limit(2), 1 << INGEST_SHIFT)                   # another ingest's first batch
    assert same() == 25
    store.compact(T0 + dt.timedelta(days=9))
    assert same() == 25
    assert store.vacuum(database=db) and spark.table(f"{db}.logs_1m").count() == 0
    assert spark.sql(f"SELECT sum(total_count) FROM {db}.logs_1m_all").first()[0] == 25      # no sync by hand
    assert same() == 25
    store.truncate("logs_1m", db)
    assert spark.table(f"{db}.logs_1m_all").count() == 0


def test_catalog_forgets_deleted_days(spark, scratch):
    store, db = LogStore(spark, scratch("forget")), "lp_forget"
    store.create_tables(db)
    store.write_logs(logs_over_days(spark), 0)
    store.sync_catalog(db)
    store.drop_expired(T0 + dt.timedelta(days=9, hours=1))
    store.sync_catalog(db)
    assert spark.sql(f"SHOW PARTITIONS {db}.logs").count() == 8
    assert spark.table(f"{db}.logs").count() == store.logs().count() == 24
