"""Session helpers: recommended settings and the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: What streams with timers need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "labelloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and skew handling on; sizes are left to the cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; a session without one uses its warehouse, which is shared too."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    sc.setCheckpointDir(named or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
