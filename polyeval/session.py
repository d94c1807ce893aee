"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package. Everything else is left
# to the cluster's defaults -- in particular the broadcast threshold: only the
# fixed registry tables are broadcast explicitly; any other broadcast is the
# planner's decision from measured sizes (AQE) under Spark's default limit.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches for the scorer / LCS / METEOR UDFs: bounded memory per
    # Python worker whatever the partition size (segments can be long texts).
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
}


def _local_heap() -> str:
    """Local-mode JVM heap: 60% of physical memory, at most 16 GB."""
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    return f"{max(1, min(16, int(total * 0.6 / 2**30)))}g"


def build_session(master: str | None = None, app: str = "polyeval",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session. ``master`` is only set for local runs;
    on a cluster the submitter decides."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        b = b.config("spark.ui.enabled", "false")
        b = b.config("spark.driver.memory", os.environ.get("POLYEVAL_DRIVER_MEM", _local_heap()))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Adaptive execution joins shuffle partitions by bytes until there is one a core; a step that
    # computes much for each byte then ends with idle cores. Three a core, where there are as many.
    if "spark.sql.adaptive.coalescePartitions.minPartitionNum" not in (extra or {}):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionNum", str(3 * spark.sparkContext.defaultParallelism))
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make ``polyeval`` importable in the Python workers (Arrow UDFs import
    it), whatever their working directory: a zip of the package is added
    with ``addPyFile`` once per SparkContext. The zip is only staged on the
    driver; Spark's file server hands it to every executor (no executor reads
    a driver folder). Deployments that pass the package with ``--py-files``
    get it twice, which is harmless."""
    sc = spark.sparkContext
    if getattr(sc, "_polyeval_shipped", False):
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    z = os.path.join(tempfile.mkdtemp(prefix="polyeval-py-"), "polyeval.zip")
    with zipfile.ZipFile(z, "w", zipfile.ZIP_DEFLATED) as f:
        for d, _dirs, files in os.walk(pkg):
            for fn in files:
                if fn.endswith(".py"):
                    full = os.path.join(d, fn)
                    f.write(full, os.path.relpath(full, root))
    sc.addPyFile(z)
    sc._polyeval_shipped = True


#: Bytes of one Arrow batch: what a Python worker holds at once, however long the texts and
#: however large the partition (Spark's own default lets 64 MB pile up, in several copies).
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches than Spark's default (a session's smaller setting is kept)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key, "64m"))
    if now <= 0 or now > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


_LOCAL_CHECKPOINT: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set by whoever runs the job (a folder every
    executor can reach). Only a local session without one gets a fresh
    folder under /tmp, which is what tests use.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder")
        key = id(spark.sparkContext)
        d = _LOCAL_CHECKPOINT.get(key)
        if d is None:
            d = _LOCAL_CHECKPOINT[key] = tempfile.mkdtemp(prefix="polyeval-ckpt-")
            try:
                spark.conf.set("spark.checkpoint.dir", d)
            except Exception:  # noqa: BLE001 - some deployments refuse core confs at run time
                pass
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written
    intermediate tables (lineage cuts that survive executor loss)."""
    import uuid
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
