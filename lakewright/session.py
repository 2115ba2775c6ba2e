"""Session defaults and the shared scratch location.

Every job that cuts lineage (landing a source, the control log, a streaming
checkpoint) writes below ``spark.checkpoint.dir``. On a cluster that setting
must point at shared storage; we only fill it in ourselves for local runs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every lakewright job relies on.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",          # D13: zone-less -> UTC instant
    "spark.sql.ansi.enabled": "true",             # casts throw; we use try_* everywhere
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(master: str = "local[*]", app_name: str = "lakewright",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  fair: bool = False) -> SparkSession:
    """Create (or fetch) a session with lakewright's defaults.

    ``fair`` turns on the FAIR scheduler so tables / workbooks refreshed from several
    driver threads share the cluster (each thread runs in its own pool).
    The UI stays off; nothing here opens a port beyond Spark's own.
    """
    b = SparkSession.builder.master(master).appName(app_name)
    b = b.config("spark.ui.enabled", "false")
    if fair:
        b = b.config("spark.scheduler.mode", "FAIR")
    for k, v in SESSION_DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL settings lakewright needs on an existing session."""
    for k, v in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave it
            pass


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for landed data, suite control logs and stream checkpoints.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset and
    the master is local (tests, laptops) do we create one; on a cluster an unset
    value is an error, since a machine-local folder would not survive the loss
    of an executor or be visible to the others.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="lakewright-scratch-")
        try:
            spark.conf.set("spark.checkpoint.dir", root)
        except Exception:
            pass
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the scratch root (local path or any Hadoop URI); ``unique`` appends a fresh id."""
    segs = [scratch_root(spark), "lakewright", *[p.strip("/") for p in parts]]
    if unique:
        segs.append(uuid.uuid4().hex)
    return "/".join(segs)


def remove_path(spark: SparkSession, uri: str) -> None:
    """Delete a folder (any Hadoop URI) recursively; a missing folder is fine."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


def in_pool(spark: SparkSession, name: str):
    """Run the calling thread's Spark jobs in scheduler pool ``name`` (FAIR mode)."""
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
