"""Session settings the library relies on, and its shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Instants are compared and truncated to dates in UTC everywhere.
REQUIRED = {"spark.sql.session.timeZone": "UTC"}

# Runtime re-planning: shuffle partitions are coalesced, and a partition that a
# hot key inflates is split, also where the split costs one more shuffle. Coalescing
# starts from many partitions, so that what one task holds does not grow with the
# input. The files of a shuffle go when the action that made them ends; a DataFrame
# that is collected once more makes them anew. Stored tables are read in splits of
# the size of these partitions.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
RUNTIME = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.files.maxPartitionBytes": "32m",
    SHUFFLE_CLEANUP: "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made elsewhere."""
    for key, value in {**REQUIRED, **RUNTIME}.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session that names none (as in tests) gets a machine-local
    folder; on a cluster its executors would not see each other's files.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tributary-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tributary/{label}-{uuid.uuid4().hex}"
