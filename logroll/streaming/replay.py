"""Dead-letter replay: stored rejections are read back, mended, classified again, and what is valid
now is appended to the tables, each message once.

A replay writes under a batch id of its own (below all streams' ids) in the order rollup, frequencies,
raw rows, ledger.  The ledger (``dlq_replayed``) names the messages of finished replays; a replay that
died before its ledger is undone and done again by the next one, under the same id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from logroll.operators.classify import classify, valid_rows
from logroll.operators.rollup import latency_frequencies, rollup_1m
from logroll.sources.tables import INGEST_SHIFT, LogStore
from logroll.streaming.ingest import LINEAGE

_FIRST = -(1 << INGEST_SHIFT)            # replays count as one ingest, numbered -1


def open_rejections(store: LogStore) -> DataFrame:
    """Stored rejections that no replay has brought in."""
    return store.dlq().join(store.replayed().select(*LINEAGE), LINEAGE, "left_anti")


def mended(store: LogStore, fix: Callable[[Column], Column] | None = None) -> DataFrame:
    """Valid rows (with lineage) among the open rejections once ``fix`` has been applied to their
    payload; without it, what the present rules accept.  A message rejected more than once counts
    once; empty payloads stay rejected."""
    text = F.col("payload")
    raw = (open_rejections(store).where(text.isNotNull()).dropDuplicates(LINEAGE)
           .select(*LINEAGE, (fix(text) if fix else text).cast("string").cast("binary").alias("value")))
    return valid_rows(classify(raw), keep=LINEAGE)


def replay_dlq(store: LogStore, fix: Callable[[Column], Column] | None = None, sketch_k: int | None = None,
               after: Callable[[str], None] | None = None) -> int:
    """Append what ``mended`` finds to all tables; the number of messages.  Run again, it finds nothing.

    ``after(sink)`` is called when a sink has been written (tests let it fail).
    """
    newest = store.replayed().agg(F.max("batch_id")).first()[0]
    batch_id = _FIRST if newest is None else newest + 1
    store.drop_batch(batch_id)
    rows = mended(store, fix).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = rows.count()
        if n:
            for sink, write in (("logs_1m", lambda: store.write_rollup(rollup_1m(rows, k=sketch_k), batch_id)),
                                ("logs_1m_freq", lambda: store.write_frequencies(latency_frequencies(rows), batch_id)),
                                ("logs", lambda: store.write_logs(rows, batch_id)),
                                ("dlq_replayed", lambda: store.write_replayed(rows.select(*LINEAGE), batch_id))):
                write()
                if after:
                    after(sink)
        return n
    finally:
        rows.unpersist()
