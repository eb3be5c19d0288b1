"""Session settings and shared-storage locations.

Everything here is plain Spark configuration.  The values are chosen for a
large cluster (AQE on, skew-join splitting on, broadcast only below a size
threshold that Spark checks itself) and still work on ``local[N]``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the library relies on.  ``autoBroadcastJoinThreshold`` is
# the size check behind every broadcast: Catalyst (static estimate) and AQE
# (measured shuffle size) only broadcast a join side below it and fall back to
# a sort-merge join otherwise.  No code path calls ``broadcast()`` on data
# whose size is unbounded.  Zstandard files are about two thirds of Snappy's, so the
# static estimate, which goes by file sizes, takes them by half as much more.
ENGINE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.fileCompressionFactor": "1.5",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "partsflow", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine settings applied."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**ENGINE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_engine_conf(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (idempotent)."""
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)


def shared_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` as the cluster names it.  Where it is
    unset, a local session (one machine, as in tests) gets a folder of its own;
    on a cluster that is an error, as executors don't share local folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="partsflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh directory name under the shared root."""
    return f"{shared_root(spark)}/partsflow/{label}-{uuid.uuid4().hex[:12]}"
