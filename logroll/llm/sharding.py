"""Contiguous shards of near-equal bytes: a global prefix sum from per-partition totals, cut at
equal targets.  DataFrame functions only.

Rows are range-partitioned by (text digest, doc_id), so equal texts are neighbours.  Only one
total per partition is summed globally; inside a partition a running sum follows.  A row goes to
the shard that holds the middle of its byte interval.  Equal texts whose bytes are at most
``snap`` of a shard move together by the middle of their common interval; a larger group (a text
that is a third of all rows) is cut like any other run, so it cannot unbalance a shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from logroll.llm.common import freeze, partitions


def prefix_sums(df: DataFrame, order: list[str], size: str, name: str) -> DataFrame:
    """``df`` (narrow) with ``before`` (sum of ``size`` over all earlier rows) and ``row`` (their
    number) in the order given.  One row per partition meets in the global step."""
    spark = df.sparkSession
    parts = freeze(df.repartitionByRange(max(2, partitions(spark)), *order)
                   .withColumn("pid", F.spark_partition_id()), name)
    totals = parts.groupBy("pid").agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("c"))
    ahead = W.orderBy("pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("pid", F.coalesce(F.sum("b").over(ahead), F.lit(0)).alias("b0"),
                            F.coalesce(F.sum("c").over(ahead), F.lit(0)).alias("c0"))
    own = W.partitionBy("pid").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = (parts.withColumn("b1", F.coalesce(F.sum(size).over(own), F.lit(0)))
             .withColumn("c1", F.coalesce(F.count(F.lit(1)).over(own), F.lit(0))))
    # One row per partition: bounded by the number of partitions, not by the data.
    return (local.join(F.broadcast(offsets), "pid").withColumn("before", F.col("b0") + F.col("b1"))
            .withColumn("row", F.col("c0") + F.col("c1")).drop("pid", "b0", "b1", "c0", "c1"))


def shard_by_bytes(docs: DataFrame, shards: int = 40, overhead: int = 16, snap: float = 0.1) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law), one row per row.

    A null text counts no bytes beside ``overhead``.  Null doc_ids come first among equal texts;
    repeated rows are separate rows with slots of their own.  An empty table gives no rows.
    Other columns are ignored.
    """
    raw = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(raw) + F.lit(overhead)).cast("long").alias("size"),
                       F.crc32(raw).alias("text_crc32"), F.md5(raw).alias("digest"))
    placed = freeze(prefix_sums(rows, ["digest", "doc_id"], "size", "shard-rows"), "shard-placed")
    total = placed.agg(F.sum("size")).first()[0] or 0
    target = total / shards
    groups = (placed.groupBy("digest").agg(F.min("before").alias("g0"), F.sum("size").alias("g"),
                                          F.count(F.lit(1)).alias("n"))
              .where((F.col("n") > 1) & (F.col("g") <= F.lit(snap * target))).select("digest", "g0", "g"))
    middle = F.coalesce(F.col("g0") + F.col("g") / 2, F.col("before") + F.col("size") / 2)
    cut = freeze(placed.join(groups, "digest", "left").withColumn("shard", F.least(
        F.lit(shards - 1), F.floor(middle / F.lit(max(target, 1e-9)))).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "row"), "shard-cut")
    first = cut.groupBy("shard").agg(F.min("row").alias("r0"))
    return cut.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.col("r0")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
