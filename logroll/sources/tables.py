"""Table layout, idempotent writes and pruning readers.

Tables live under one root (shared storage on a cluster):

* ``logs``            raw rows, partitioned by ``event_date`` and ``batch_id``; 7-day retention.
* ``logs_1m``         partial rollup rows, one directory (one file) per micro-batch, partitioned by
  ``batch_id`` with ``event_date`` as a sorted column; no expiry.  Late rows do not multiply
  files: a batch writes one file however many days it touches.
* ``logs_1m_freq``    exact latency frequencies, same layout.
* ``logs_1m_compacted`` merged rollup of closed days, partitioned by ``event_date``; each row
  carries ``through_batch_ids``: live rows of that day up to these batches are already inside.
* ``logs_1m_freq_compacted`` the same for the frequencies.
* ``dlq``             rejections, partitioned by ``batch_id``.
* ``dlq_replayed``    messages that a dead-letter replay has brought in, partitioned by ``batch_id``.
* ``logs_1m_state``   versions of the stateful rollup's totals, partitioned by ``batch_id``.
* ``pipeline_counts`` what each batch alone counted, partitioned by ``batch_id``; totals are running sums.
* ``pipeline_lag``    lag samples of the query listener, one file a minute, partitioned by ``event_date``.

For SQL users the catalog has all of them and the views ``logs_1m_all`` and ``logs_1m_freq_all``: compacted days and
the live rows not yet inside them, as the readers below see them.

Every write replaces exactly the partitions of its ``batch_id`` (dynamic partition overwrite),
so replaying a micro-batch after a failure replaces instead of duplicating.
"""

from __future__ import annotations

import datetime as _dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.util import inheritable_thread_target

from logroll.functions.timefn import as_timestamp
from logroll.operators.counters import pipeline_samples
from logroll.operators.rollup import merge_frequencies, merge_rollup
from logroll.schemas import COMPACTABLE, LOG_COLUMNS, METRICS, RETENTION_DAYS, ROLLUP_KEY, TABLE_DDL

TABLE_NAMES = list(TABLE_DDL)


def _hadoop_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _literal_date(since) -> str | None:
    """``YYYY-MM-DD`` of a literal bound (text, date or datetime); None for a Column or None."""
    if since is None or isinstance(since, Column):
        return None
    if isinstance(since, _dt.datetime):
        return since.date().isoformat()
    if isinstance(since, _dt.date):
        return since.isoformat()
    try:
        return _dt.datetime.fromisoformat(str(since).strip().replace("Z", "+00:00")).date().isoformat()
    except ValueError:
        return None


def _typed(df: DataFrame) -> DataFrame:
    """Partition discovery infers small batch ids as INT; the tables declare BIGINT."""
    return df.withColumn("batch_id", F.col("batch_id").cast("bigint")) if "batch_id" in df.columns else df


#: A stored batch id holds the ingest's number above this many bits, the stream's batch id below.
INGEST_SHIFT = 40


def ingest_of(batch_id: Column) -> Column:
    return F.shiftright(batch_id, INGEST_SHIFT)


def _through(compacted: DataFrame) -> DataFrame:
    """(event_date, _ingest, _through): newest batch of each ingest folded into a compacted day."""
    return (compacted.groupBy("event_date").agg(F.first("through_batch_ids").alias("t"))
            .select("event_date", F.explode("t").alias("_through")).withColumn("_ingest", ingest_of(F.col("_through"))))


class LogStore:
    """Paths, writers and readers of the pipeline's tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # -- DDL ---------------------------------------------------------------------------------
    def create_tables(self, database: str = "log_pipeline") -> None:
        """Register every table in the catalog (``CREATE ... USING parquet PARTITIONED BY``), and a view
        over live and compacted rows of each table that is compacted."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, (cols, parts) in TABLE_DDL.items():
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet "
                           f"PARTITIONED BY ({', '.join(parts)}) LOCATION '{self.path(name)}'")
        for name in COMPACTABLE:
            t = f"{database}.{name}"
            cols = ", ".join(c for c in self.spark.table(t).columns if c != "batch_id")
            # A live row is inside the compacted day if its ingest's newest folded batch is not older.
            self.spark.sql(f"""
                CREATE OR REPLACE VIEW {t}_all AS
                SELECT {cols} FROM {t}_compacted
                UNION ALL
                SELECT {cols} FROM {t} AS live
                LEFT ANTI JOIN (SELECT event_date AS day, explode(batches) AS through
                                FROM (SELECT event_date, first(through_batch_ids) AS batches
                                      FROM {t}_compacted GROUP BY event_date)) AS folded
                ON live.event_date = folded.day AND live.batch_id <= folded.through
                   AND shiftright(live.batch_id, {INGEST_SHIFT}) = shiftright(folded.through, {INGEST_SHIFT})""")

    def sync_catalog(self, database: str = "log_pipeline", tables=None) -> None:
        """Make catalog tables see partitions written by path and forget those deleted (``MSCK REPAIR
        TABLE ... SYNC PARTITIONS``).  Readers in this package read by path and do not need it; run it for SQL
        users after ingest and after compaction.  Compacted tables come first, so that in between a
        reader of the views meets no gap."""
        names = [n for n in TABLE_DDL if tables is None or n in tables]
        for name in sorted(names, key=lambda n: not n.endswith("_compacted")):
            if self.spark.catalog.tableExists(f"{database}.{name}"):
                p, fs = _hadoop_fs(self.spark, self.path(name))
                if not fs.exists(p):
                    fs.mkdirs(p)
                self.spark.sql(f"MSCK REPAIR TABLE {database}.{name} SYNC PARTITIONS")
                self.spark.catalog.refreshTable(f"{database}.{name}")

    def truncate(self, name: str, database: str | None = "log_pipeline") -> None:
        """Remove every row of a table (the tables are external, so the files are deleted), its
        compacted copy included, and the catalog's partitions of both."""
        p, fs = _hadoop_fs(self.spark, self.path(name))
        compacted, _ = _hadoop_fs(self.spark, self.path(name + "_compacted"))
        for old in (p, compacted):
            if fs.exists(old):
                fs.delete(old, True)
        fs.mkdirs(p)
        if database:
            self.sync_catalog(database, (name, name + "_compacted"))

    # -- writers -----------------------------------------------------------------------------
    def _write(self, df: DataFrame, name: str, partition_by: list[str], sort_by: list[str] | None = None):
        if sort_by:
            df = df.sortWithinPartitions(*partition_by, *sort_by)
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by).parquet(self.path(name)))

    def write_logs(self, rows: DataFrame, batch_id: int) -> None:
        """Valid rows (eight columns plus lineage) of one batch.  Rows of a day and service stay together as far
        as their bytes allow (a hot service is split, small ones share a file), and files are sorted by
        (service, level, timestamp), so Parquet min/max statistics skip files and row groups."""
        lineage = [c for c in ("topic", "partition", "offset") if c in rows.columns]
        df = rows.select(*LOG_COLUMNS, *lineage,
                         F.to_date("timestamp").alias("event_date"), F.lit(batch_id).cast("bigint").alias("batch_id"))
        self._write(df.hint("rebalance", "event_date", "service"), "logs", ["event_date", "batch_id"],
                    ["service", "level", "timestamp"])

    def write_rollup(self, partial: DataFrame, batch_id: int, files: int | None = None) -> None:
        """Partial rollup of one batch (one row per key the batch touched), sorted by (event_date,
        minute, service, level) for min/max skipping.  ``files`` caps the file count (the ingest
        job sizes it from the batch's row count, an upper bound of the keys); by default the
        aggregation's own partitions are kept."""
        df = partial.select("*", F.to_date("minute").alias("event_date"),
                            F.lit(batch_id).cast("bigint").alias("batch_id"))
        self._write(df.coalesce(files) if files else df, "logs_1m", ["batch_id"], ["event_date", *ROLLUP_KEY])

    def write_frequencies(self, freq: DataFrame, batch_id: int, files: int | None = None) -> None:
        df = freq.select("*", F.to_date("minute").alias("event_date"),
                         F.lit(batch_id).cast("bigint").alias("batch_id"))
        self._write(df.coalesce(files) if files else df, "logs_1m_freq", ["batch_id"],
                    ["event_date", *ROLLUP_KEY])

    def write_dlq(self, envelopes: DataFrame, batch_id: int) -> None:
        self._write(envelopes.withColumn("batch_id", F.lit(batch_id).cast("bigint")), "dlq", ["batch_id"])

    def write_counts(self, counts: DataFrame, batch_id: int) -> None:
        """What one batch counted: a row per topic, partition and outcome, so one file."""
        self._write(counts.withColumn("batch_id", F.lit(batch_id).cast("bigint")).coalesce(1), "pipeline_counts", ["batch_id"])

    def insert_seconds(self, batch_id: int) -> float | None:
        """The sink duration stored with a batch; None if the batch is new or had none."""
        part, fs = _hadoop_fs(self.spark, f"{self.path('pipeline_counts')}/batch_id={batch_id}")
        if not fs.exists(part):
            return None
        return self.spark.read.schema(TABLE_DDL["pipeline_counts"][0]).parquet(part.toString()).agg(F.max("insert_seconds")).first()[0]

    def append_lag(self, samples: list[tuple]) -> None:
        """One file of lag samples ``(ts, metric, labels, value)`` in the partition of their day."""
        df = self.spark.createDataFrame(samples, METRICS).withColumn("event_date", F.to_date("ts")).coalesce(1)
        df.write.mode("append").partitionBy("event_date").parquet(self.path("pipeline_lag"))

    def write_replayed(self, messages: DataFrame, batch_id: int) -> None:
        self._write(messages.withColumn("batch_id", F.lit(batch_id).cast("bigint")), "dlq_replayed", ["batch_id"])

    def write_window_state(self, counts: DataFrame, batch_id: int) -> None:
        """New totals of the (minute, service, level) keys a batch touched."""
        self._write(counts.withColumn("batch_id", F.lit(batch_id).cast("bigint")), "logs_1m_state", ["batch_id"], ROLLUP_KEY)

    def drop_batch(self, batch_id: int) -> None:
        """Remove what an unfinished write of a batch left in the pipeline's tables."""
        for name in ("logs_1m", "logs_1m_freq", "logs/event_date=*"):
            pattern, fs = _hadoop_fs(self.spark, f"{self.path(name)}/batch_id={batch_id}")
            for found in fs.globStatus(pattern) or ():
                fs.delete(found.getPath(), True)

    # -- readers -----------------------------------------------------------------------------
    def _read(self, name: str, since=None) -> DataFrame:
        """Read a table.  With a literal ``since``, only the day directories from that date on are
        handed to the reader (one listing of the table root), so reports over a recent window do
        not discover every partition of a table that never expires."""
        day = _literal_date(since)
        cols, parts = TABLE_DDL[name]
        by_day = "event_date" in parts
        if not self._has_files(name):                # a quiet stream, or everything vacuumed
            return self.spark.createDataFrame([], cols)
        if day is None or not by_day:
            return _typed(self.spark.read.option("basePath", self.path(name)).parquet(self.path(name)))
        root, fs = _hadoop_fs(self.spark, self.path(name))
        paths = [st.getPath().toString() for st in fs.listStatus(root)
                 if st.isDirectory() and st.getPath().getName().startswith("event_date=")
                 and st.getPath().getName().split("=", 1)[1] >= day]
        if not paths:
            return self.spark.createDataFrame([], cols)
        return _typed(self.spark.read.option("basePath", self.path(name)).parquet(*paths))

    def _has_files(self, name: str) -> bool:
        """Whether the table has any partition directory or file (one listing of its root)."""
        root, fs = _hadoop_fs(self.spark, self.path(name))
        return bool(fs.exists(root)) and any(not st.getPath().getName().startswith(("_", "."))
                                             for st in fs.listStatus(root))

    def exists(self, name: str) -> bool:
        p, fs = _hadoop_fs(self.spark, self.path(name))
        return bool(fs.exists(p))

    def logs(self, since=None, public: bool = True) -> DataFrame:
        """Raw rows, optionally from ``since`` on.  The bound is stated on both ``event_date`` (so
        whole day directories are pruned at planning time) and ``timestamp`` (row filter)."""
        df = self._read("logs", since)
        if since is not None:
            lo = as_timestamp(since)
            df = df.where((F.col("event_date") >= F.to_date(lo)) & (F.col("timestamp") >= lo))
        return df.select(*LOG_COLUMNS) if public else df

    def _live_after_compaction(self, name: str, since=None) -> DataFrame:
        live = self._read(name, since)
        if not self.exists(name + "_compacted"):
            return live.drop("batch_id")
        return self._not_folded(live, _through(self._read(name + "_compacted", since))).drop("batch_id")

    @staticmethod
    def _not_folded(live: DataFrame, done: DataFrame) -> DataFrame:
        """Live rows of batches that the compacted day does not contain yet."""
        # ``done`` has one row per compacted day and ingest (bounded by the days kept, ~40 bytes
        # each), so it is broadcast: a shuffle join would send all of today's rows to one task.
        return (live.withColumn("_ingest", ingest_of(F.col("batch_id")))
                .join(F.broadcast(done), ["event_date", "_ingest"], "left")
                .where(F.col("_through").isNull() | (F.col("batch_id") > F.col("_through")))
                .drop("_through", "_ingest"))

    def _rollup_view(self, name: str, since) -> DataFrame:
        rows = self._live_after_compaction(name, since)
        if self.exists(name + "_compacted"):
            rows = rows.unionByName(self._read(name + "_compacted", since).drop("through_batch_ids"))
        if since is not None:
            # Compacted day directories before the window are never listed; live rows are
            # skipped by the pushed-down event_date predicate (files are sorted by it).
            rows = rows.where(F.col("event_date") >= F.to_date(as_timestamp(since)))
        return rows.drop("event_date")

    def rollup(self, since=None, merged: bool = False) -> DataFrame:
        """Rollup rows: compacted days plus live partials written after the compaction, from the
        day of ``since`` on.  With ``merged`` the partial rows are combined per key (reports do not
        need it: they aggregate anyway)."""
        rows = self._rollup_view("logs_1m", since)
        return merge_rollup(rows) if merged else rows

    def frequencies(self, since=None, merged: bool = False) -> DataFrame:
        rows = self._rollup_view("logs_1m_freq", since)
        return merge_frequencies(rows) if merged else rows

    def dlq(self) -> DataFrame:
        return self._read("dlq")

    def replayed(self) -> DataFrame:
        return self._read("dlq_replayed")

    def window_state(self) -> DataFrame:
        """The newest totals of every key of the stateful rollup."""
        counts = ["total_count", "error_count", "latency_sum"]
        return (self._read("logs_1m_state").groupBy(*ROLLUP_KEY)
                .agg(F.max_by(F.struct(*counts), "batch_id").alias("c")).select(*ROLLUP_KEY, *[f"c.{c}" for c in counts]))

    def compact_window_state(self) -> None:
        """Keep only the newest version of each key, under the newest batch.  Safe at any point while the
        stream is stopped: until the older versions are gone, readers see both and take the newest."""
        newest = self._read("logs_1m_state").agg(F.max("batch_id")).first()[0]
        if newest is None:
            return
        self.write_window_state(self.window_state().checkpoint(eager=True), newest)
        root, fs = _hadoop_fs(self.spark, self.path("logs_1m_state"))
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if name.startswith("batch_id=") and int(name.split("=")[1]) < newest:
                fs.delete(st.getPath(), True)

    def metrics(self) -> DataFrame:
        """Samples of the pipeline's own series: totals after every batch, and the recorded lag
        (without ``batch_id``)."""
        lag = self._read("pipeline_lag").select(*METRICS.names, F.lit(None).cast("bigint").alias("batch_id"))
        return pipeline_samples(self._read("pipeline_counts")).unionByName(lag)

    def ingest_number(self, checkpoint: str) -> int:
        """Number of the ingest that owns ``checkpoint``: allocated once in the store (exclusive
        file creation) and kept in the checkpoint folder.  Batch ids of a new or reset checkpoint
        thus never meet those of an earlier one."""
        mark, fs = _hadoop_fs(self.spark, f"{checkpoint.rstrip('/')}/ingest_number")
        if fs.exists(mark):
            stream = fs.open(mark)
            try:
                return int(stream.readLong())
            finally:
                stream.close()
        n = 0
        while True:
            own, store_fs = _hadoop_fs(self.spark, self.path(f"_ingests/{n}"))
            try:
                if store_fs.createNewFile(own):
                    break
            except Exception:
                if not store_fs.exists(own):
                    raise
            n += 1
        out = fs.create(mark, True)
        out.writeLong(n)
        out.close()
        return n

    # -- maintenance -------------------------------------------------------------------------
    def compact(self, before, tables=("logs_1m", "logs_1m_freq")) -> None:
        """Merge every rollup day earlier than ``before`` (a date or timestamp) into one set of rows
        per key.  Late rows that arrive after compaction stay live and are merged at read time.

        The compacted rows carry ``through_batch_ids`` (the newest batch folded in, of each
        ingest), written in the same files, so readers never see a day counted twice.  Only days
        with batches not folded in yet are read and rewritten.  Totals do not change.  The tables
        are compacted as concurrent jobs."""
        names = [n for n in tables if self.exists(n)]
        with ThreadPoolExecutor(max_workers=max(1, len(names))) as pool:
            for fut in [pool.submit(inheritable_thread_target(self.spark)(self._compact_one), n, before)
                        for n in names]:
                fut.result()

    def _compact_one(self, name: str, before) -> None:
        cutoff = F.to_date(as_timestamp(before))
        live = self._read(name).where(F.col("event_date") < cutoff)
        keys = ["event_date", *ROLLUP_KEY]
        folded = live.select("event_date", "batch_id")
        if self.exists(name + "_compacted"):
            old = self._read(name + "_compacted")
            done = _through(old)
            live = self._not_folded(live, done)
            folded = live.select("event_date", "batch_id")
            days = F.broadcast(folded.select("event_date").distinct())        # one row per day
            live = live.drop("batch_id").unionByName(old.drop("through_batch_ids").join(days, "event_date", "left_semi"))
            folded = folded.union(done.join(days, "event_date", "left_semi").select("event_date", "_through"))
        else:
            live = live.drop("batch_id")
        merged = merge_frequencies(live, keys) if name.endswith("_freq") else merge_rollup(live, keys)
        through = (folded.groupBy("event_date", ingest_of(F.col("batch_id")).alias("i")).agg(F.max("batch_id").alias("b"))
                   .groupBy("event_date").agg(F.sort_array(F.collect_list("b")).alias("through_batch_ids")))
        # The new compacted rows read the old ones: materialise them in the shared checkpoint
        # folder first, so the overwrite does not read the files it replaces.
        out = merged.join(F.broadcast(through), "event_date", "inner").checkpoint(eager=True)  # per day
        self._write(out, name + "_compacted", ["event_date"], ROLLUP_KEY)

    def vacuum(self, tables=("logs_1m", "logs_1m_freq"), database: str | None = None) -> list[str]:
        """Delete live batch directories whose every row is already folded into the compacted table
        (each day the batch touches is compacted through that batch or later).  Safe at any point:
        readers ignore live rows at or below ``through_batch_ids`` anyway.  With ``database`` the catalog learns
        of the compacted days before and of the deleted batches after."""
        if database:
            self.sync_catalog(database, [t + "_compacted" for t in tables])
        removed = []
        for name in tables:
            if not (self.exists(name) and self.exists(name + "_compacted")):
                continue
            through = _through(self._read(name + "_compacted"))
            # One row per live batch (bounded by the batches since the last vacuum).
            done = (self._read(name).withColumn("_ingest", ingest_of(F.col("batch_id")))
                    .join(F.broadcast(through), ["event_date", "_ingest"], "left")
                    .groupBy("batch_id")
                    .agg(F.bool_and(F.coalesce(F.col("batch_id") <= F.col("_through"), F.lit(False))).alias("ok"))
                    .where("ok").collect())
            root, fs = _hadoop_fs(self.spark, self.path(name))
            jvm = self.spark.sparkContext._jvm
            for r in done:
                part = jvm.org.apache.hadoop.fs.Path(root, f"batch_id={r['batch_id']}")
                if fs.delete(part, True):
                    removed.append(f"{name}/batch_id={r['batch_id']}")
        if database:
            self.sync_catalog(database, tables)
        return removed

    def drop_expired(self, as_of=None, days: int = RETENTION_DAYS) -> list[str]:
        """Delete ``logs`` day partitions that lie wholly before the retention cutoff (a day is
        kept while any of it is within ``days`` of ``as_of``).  Rollup tables never expire.
        Returns the removed partition directories."""
        cutoff = self.spark.range(1).select(
            F.to_date(as_timestamp(as_of) - F.make_interval(days=F.lit(days))).cast("string")).first()[0]
        root, fs = _hadoop_fs(self.spark, self.path("logs"))
        removed = []
        if not fs.exists(root):
            return removed
        for status in fs.listStatus(root):
            name = status.getPath().getName()
            if status.isDirectory() and name.startswith("event_date=") and name.split("=", 1)[1] < cutoff:
                fs.delete(status.getPath(), True)
                removed.append(name)
        return removed

    def missing_tables(self, expected=None, database: str = "log_pipeline") -> DataFrame:
        """Expected table names that the catalog does not have (``left_anti`` against SHOW TABLES)."""
        names = self.spark.createDataFrame([(n,) for n in (expected or TABLE_NAMES)], "name string")
        present = self.spark.sql(f"SHOW TABLES IN {database}").select(F.col("tableName").alias("name"))
        return names.join(present, "name", "left_anti")
