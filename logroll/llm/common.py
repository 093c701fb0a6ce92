"""Shared pieces: table readers, lineage cuts, size-checked broadcasts, connected components."""

from __future__ import annotations

import ctypes
import gc
import os

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession, functions as F

from logroll.session import configure, scratch_dir

#: A side is broadcast only when it has at most this many (narrow) rows.
BROADCAST_ROWS = 200_000
#: What a Python worker is handed at once: whole texts and blocks of vectors are far wider than the
#: numbers the default of 10,000 rows is made for.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "4m"}
#: Spark's white space of the word contract: blank and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> SparkSession:
    """Session options, and the package's folder on the workers' import path (for runs from a
    source tree; harmless where the package is installed)."""
    configure(spark)
    for name, value in ARROW_BATCH.items():
        spark.conf.set(name, value)
    env = spark.sparkContext.environment
    if _ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, env.get("PYTHONPATH", "")) if x)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def freeze(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it again.

    Cuts the lineage (a lost executor re-reads files instead of recomputing the job so far) and
    fixes partition ids and sampled range bounds; parquet keeps column pruning.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{name}") + "/t"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint behind a row count; larger sides keep the shuffle join.

    Only for frozen tables of a few narrow columns: the count reads file footers.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def release() -> None:
    """Hands back what a finished task held: Python workers live on for later stages, and the C
    allocator keeps freed vocabularies and buffers unless it is asked."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


def trim_jvm(spark: SparkSession) -> str | None:
    """Asks the driver's JVM to hand freed native memory back to the system; what it says, None if it cannot.

    Compiling plans and serving hundreds of threads takes and frees memory outside the heap, which the C
    allocator keeps: more than the live heap after some hundred jobs.
    """
    sc = spark.sparkContext
    java, new = sc._jvm.java, sc._gateway.new_array
    try:
        # The bean's own class is not open to callers, so its method is taken from the public interface.
        kinds, args = new(java.lang.Class, 4), new(java.lang.Object, 4)
        names = ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")
        for i, name in enumerate(names):
            kinds[i] = java.lang.Class.forName(name)
        args[0] = sc._jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        args[1], args[2], args[3] = "systemTrimNativeHeap", new(java.lang.Object, 0), new(java.lang.String, 0)
        invoke = java.lang.Class.forName("javax.management.MBeanServerConnection").getMethod("invoke", kinds)
        return invoke.invoke(java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:               # not this JVM or not this C library
        return None


def tidy_driver(spark: SparkSession) -> None:
    """Frees what the plans of earlier jobs left in the driver and hands it back to the system: many
    short jobs fill the heap up to its limit and it is not given back unless it is collected, nor is
    what their compilation took outside the heap."""
    release()
    spark.sparkContext._jvm.System.gc()
    trim_jvm(spark)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of ``df`` (file sizes for a scan)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bucket_count(df: DataFrame, bytes_per_bucket: int = 4 << 20, factor: int = 2) -> int:
    """Groups for block-wise work: proportional to the input, never fewer than the shuffle width."""
    return max(factor * partitions(df.sparkSession), plan_bytes(df) // bytes_per_bucket)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over undirected ``edges(a, b)``.

    Alternating large-star and small-star steps, each a min aggregation (combined map-side, so a
    hub costs one row per task) and a join Spark may split on skew.  The edge table is frozen per
    round; nothing but two numbers per round reaches the driver.  Nodes without an edge to
    another node are not listed.
    """
    tidy_driver(edges.sparkSession)
    e = freeze(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .distinct(), "cc0")
    seen = None
    for i in range(max_rounds):
        state = e.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if state[0] == 0 or tuple(state) == seen:
            break
        seen = tuple(state)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        least2 = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least2, "u")
        e = freeze(near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                   .union(least2.select("u", F.col("m").alias("v"))).where("u != v").distinct(), f"cc{i + 1}")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = e.groupBy("u").agg(F.min("v").alias("component"))
    return stars.select(F.col("u").alias("node"), "component").union(
        e.select("v", "v").distinct().join(stars.select(F.col("u").alias("v0")), F.col("v0") == e["v"], "left_anti")
        .toDF("node", "component"))
