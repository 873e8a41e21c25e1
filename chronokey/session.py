"""SparkSession settings the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every chronokey job needs: epoch arithmetic is done in UTC, AQE
# re-plans joins/partition counts from runtime sizes.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state: large keyed state stays off-heap in RocksDB.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, app: str = "chronokey", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster pass ``master=None`` and let spark-submit decide. Local runs
    (tests, bench) pass ``local[N]``; there the UI is switched off.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = (
            builder.master(master)
            .config("spark.ui.enabled", "false")
            .config("spark.sql.shuffle.partitions", str(conf.pop("shuffle_partitions", 8)))
        )
    for k, v in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and stream outputs.

    Uses ``spark.checkpoint.dir`` when the cluster sets it. Only when it is
    unset (local tests) a private temporary folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on this cluster")
        configured = tempfile.mkdtemp(prefix="chronokey-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
