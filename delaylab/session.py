"""Session helpers for tests, the bench and the driver entry points.

The library never creates a session of its own; these helpers exist for callers that need one
(tests, ``bench.py``) and for the one setting the library reads from a session: the shared
checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE coalesces small shuffle partitions, splits skewed join
# partitions and turns a shuffle join into a broadcast join when the runtime size allows.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "delaylab",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (the cluster passes its own settings)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("DELAYLAB_DRIVER_MEMORY", "8g")))
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The JVM SparkContext, or None for sessions without one (e.g. Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001
        return None


def is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    return sc is not None and sc.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder named by the session (``spark.checkpoint.dir``), if any."""
    sc = _context(spark)
    if sc is None:
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the session's checkpoint folder. Only a local-mode session (tests, the bench) with
    none set gets a scratch folder of its own; a cluster must name a shared one."""
    existing = checkpoint_dir(spark)
    if existing:
        return existing
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    scratch = os.environ.get("DELAYLAB_SCRATCH", "/tmp")
    local = tempfile.mkdtemp(prefix="delaylab-ckpt-", dir=scratch)
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    import uuid

    return f"{base.rstrip('/')}/delaylab-{name}-{uuid.uuid4().hex[:12]}"


def recommended_conf(input_bytes: float, total_cores: int,
                     target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Settings for a cluster run over ``input_bytes`` of input with ``total_cores`` cores.

    Scan splits of ``target_partition_bytes`` keep each task's input bounded; the initial
    shuffle partition count covers the input at that size (at least 2 per core) and AQE
    coalesces it down to the advisory size at runtime, so small shuffles (per-key tables,
    aggregates) do not leave thousands of empty tasks. Skew-join splitting stays on.
    """
    parts = max(2 * total_cores, int(input_bytes // target_partition_bytes) + 1)
    return {
        **{k: v for k, v in SCALE_CONF.items() if not k.startswith("spark.ui.show")},
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
