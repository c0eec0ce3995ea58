"""Session construction and the shared folder for lineage cuts.

Cluster jobs must not write to a machine-local temp folder: anything that
has to outlive a task (checkpoints, staged tables) goes under the folder the
cluster names in ``spark.checkpoint.dir``.  Tests and local runs set their
own only when the session has none.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "8g",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "orderlens", extra: dict | None = None) -> SparkSession:
    """Return the active session, or build one with the library defaults.

    ``master``/``shuffle_partitions`` only matter when no session exists yet;
    on a cluster the submitter's settings win.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir``.  Only a local session (tests) gets a
    fresh folder under the system temp dir when it is unset; a cluster without
    the setting is refused, since its executors don't share that disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_FALLBACK.get(id(spark.sparkContext))
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="orderlens-ckpt-")
        _LOCAL_FALLBACK[id(spark.sparkContext)] = d
        try:
            spark.conf.set("spark.checkpoint.dir", d)
        except Exception:  # noqa: BLE001 -- core confs may be read-only at runtime
            pass
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


_LOCAL_FALLBACK: dict = {}


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for a written intermediate table."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def stage_table(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` as a parquet table under the shared folder and read it
    back: lineage is cut, the copy survives executor loss, and later readers
    get column pruning and predicate pushdown on it."""
    spark = spark or df.sparkSession
    path = staging_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cluster_conf(total_cores: int, shared_checkpoint_dir: str) -> dict:
    """Suggested settings for a large cluster run (pass as ``extra`` to
    :func:`get_spark` or to spark-submit).

    * shuffle partitions: about 3 x total cores as the initial number; AQE
      coalesces them toward ~256 MB per partition and splits skewed ones;
    * scan splits of 256 MB so a task's input fits executor memory;
    * skew join: a partition 5x the median and over 512 MB is split;
    * broadcast joins only under 64 MB at runtime (the library's own
      broadcasts are bounded by construction);
    * checkpoints and staged tables on shared storage (never local disk).
    """
    parts = max(200, 3 * int(total_cores))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.checkpoint.dir": shared_checkpoint_dir,
        "spark.sql.session.timeZone": "UTC",
    }
