"""Session helpers: tuning for the jobs, checkpoint directory, size-checked broadcast."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime-settable options every job relies on: AQE re-plans joins and splits
# skewed shuffle partitions (a hot vendor or payment document must not land in
# one task), and coalesces the many small post-shuffle partitions.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # A selective payment selection prunes the invoice-payment scan before the shuffle join.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}

# Dimension tables broadcast only below this many rows (checked, not assumed).
BROADCAST_ROW_LIMIT = 200_000


def tune(spark: SparkSession) -> SparkSession:
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "remitflow") -> SparkSession:
    """Session for tests and the local bench (single JVM, UI off)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("REMITFLOW_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RUNTIME_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only on a local master (tests) is a scratch folder created when nothing is configured: on a cluster
    it would be another folder on every machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="remitflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def new_scratch_path(spark: SparkSession, name: str) -> str:
    """As ``scratch_path``, another one each time; deleted when the process ends."""
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    remember_folder(path)
    return path


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only if it provably has at most ``limit`` rows.

    The check reads at most ``limit + 1`` rows.  Beyond the bound the frame is
    returned unchanged and the planner (AQE) picks a shuffle join instead.
    """
    n = df.limit(limit + 1).count()
    return F.broadcast(df) if n <= limit else df


_written: set[str] = set()


def remember_folder(path: str) -> None:
    """A folder of this process's own, to be deleted at its end if nothing has deleted it before."""
    if not _written:
        atexit.register(_delete_written)
    _written.add(path)


def _delete_written() -> None:
    jvm = SparkContext._jvm
    if jvm is None:
        return
    try:
        conf = jvm.org.apache.hadoop.conf.Configuration()
        for path in _written:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)
    except Exception:  # the JVM is gone already: the checkpoint folder's own clean-up is left
        pass


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor recomputes from the written files, not from
    the source scans) and gives every consumer the same snapshot.  The folder goes with
    ``drop_snapshot``, or else when the process ends.
    """
    path = new_scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_snapshot(df: DataFrame) -> None:
    """Delete the folder(s) a ``materialize``d frame reads from (after its consumers have run)."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(folder)
        p.getFileSystem(conf).delete(p, True)
