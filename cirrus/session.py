"""SparkSession helpers.

All timestamps in this engine are zone-less wall-clock values read as UTC, so
the session time zone must be UTC.  ``build_session`` is for tests, the bench
and local runs; on a cluster the caller owns the session and only
``use_utc`` is applied.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, app: str = "cirrus", shuffle_partitions: int | None = None) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    master = master or f"local[{cpus}]"
    parts = shuffle_partitions or int(cpus)
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # fall back from whole-stage codegen when a generated method would be
        # too large for the JIT (HotSpot's limit), instead of running it
        # interpreted: 2.5x on the wide normaliser projection
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        # checkpoint files go when nothing refers to them any more
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("CIRRUS_DRIVER_MEMORY", "16g"))
        # the state of windows may outgrow an executor's memory
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    use_utc(spark)
    checkpoint_root(spark)
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only when it is unset and Spark runs in local
    mode (tests, local runs) is a scratch folder created and recorded; on a
    cluster an unset value is an error, as a machine-local folder would not
    survive the loss of an executor or the driver.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a shared folder (streaming checkpoints and lineage cuts live there)")
        root = tempfile.mkdtemp(prefix="cirrus-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
        spark.sparkContext.setCheckpointDir(root)
    return root


def checkpoint_path(spark: SparkSession, name: str) -> str:
    return checkpoint_root(spark).rstrip("/") + "/" + name


_SCRATCH: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder's path under the checkpoint root, removed when the
    application ends."""
    path = checkpoint_path(spark, f"cirrus-scratch/{name}-{uuid.uuid4().hex}")
    if not _SCRATCH:
        atexit.register(_remove_scratch)
    _SCRATCH.append((spark, path))
    return path


def _remove_scratch() -> None:
    for spark, path in _SCRATCH:
        try:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # noqa: BLE001  the session is gone: nothing to remove with
            return


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, whose functions Python workers import
    (once an application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(root):  # else it came in an archive, by --py-files
        at = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="cirrus-py-"), "cirrus"), "zip", os.path.dirname(root), "cirrus")
        sc.addPyFile(at)
    _SHIPPED.add(sc.applicationId)
