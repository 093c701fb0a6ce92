"""Session set-up and shared scratch space.

``configure`` sets only runtime SQL options the library depends on for correct results; cluster
sizing (executors, memory, shuffle partitions) is left to whoever launches the job.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Options the results depend on.  Duplicate keys: the last one wins, as with a JavaScript
# JSON.parse; without this flag Spark's parse_json rejects the message instead.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Options that only change the physical plan.  AQE re-plans joins from runtime sizes (a side is
# broadcast only after its real size is measured), coalesces small shuffle partitions and splits
# skewed ones.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in {**REQUIRED_CONF, **PLAN_CONF}.items():
        spark.conf.set(key, value)
    return spark


def get_session(master: str | None = None, app: str = "logroll",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's options.  ``master`` is only for local runs."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**REQUIRED_CONF, **PLAN_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return configure(spark)


def _checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach, so tables, stream
    checkpoints and lineage cuts go there.  Unset, it is an error on a cluster; a local session gets
    a fresh folder under the system temp directory.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        sc = None
    if root and sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)            # so DataFrame.checkpoint() writes there too
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if sc is not None and sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="logroll-")
        for set_dir in (lambda: spark.conf.set("spark.checkpoint.dir", root),
                        lambda: spark.sparkContext.setCheckpointDir(root)):
            try:
                set_dir()
            except Exception:  # a core option may be read-only in this session
                pass
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared checkpoint root, for one run of one job."""
    root = _checkpoint_root(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).mkdirs(hadoop)
    return path
