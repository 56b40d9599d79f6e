"""Session helpers: the Spark settings the library relies on, and the shared
checkpoint folder.

The library never overrides a setting the cluster already made; it only fills
in what is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are designed around. AQE re-plans joins from runtime
# sizes (broadcast only below the threshold, sort-merge beyond it), splits
# skewed join partitions and coalesces small shuffle partitions. The static,
# estimate-based broadcast is off: an estimate can be far too small (an
# exploded grid is estimated at its input's size), while AQE decides on the
# measured size of a finished stage. Sides with a proven bound (the literal
# rate table) carry an explicit broadcast hint instead.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
}


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gridlake"
) -> SparkSession:
    """A local session for tests and the bench (the UI stays off)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in RECOMMENDED.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_recommended(spark: SparkSession) -> None:
    """Fill in the recommended settings that the session has not set."""
    for k, v in RECOMMENDED.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared folder and is used as is. Where it
    is unset, a scratch folder is created on a local master only: on any other
    the executors would not see it, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="gridlake-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
