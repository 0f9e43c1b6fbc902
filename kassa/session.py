"""Session settings the jobs rely on.

The jobs never depend on the session time zone: every instant is carried as
``timestamp_ntz`` holding UTC wall-clock time, and every local day is derived
with an explicit zone (see :mod:`kassa.functions.timeutil`).  The settings
below are the runtime ones that matter for plan quality at scale.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings applied to a session handed to us.  They only switch on
# adaptive planning; sizes (shuffle partitions, broadcast threshold) are left
# to the cluster's own configuration.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def get_session(master: str = "local[8]", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests, the bench and local runs."""
    spark = (
        SparkSession.builder.master(master)
        .appName("kassa")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, taking it from the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; we only pick
    our own when none is set and the master is local (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints"
        )
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="kassa-ckpt-"))
    return sc.getCheckpointDir()
