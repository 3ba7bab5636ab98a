"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every operator here is written for.  The two skew settings let Spark split a
# hot key of a join even where the split costs one more exchange downstream.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Keyed stream state that spills to disk; the stateful streams need this provider.
STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# A join of streams keeps its four maps in one store a partition, and a commit writes only what changed.
STATE_CONF = {
    "spark.sql.streaming.join.stateFormatVersion": "3",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that already exists."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    spark.conf.set(STATE_STORE_CONF, ROCKSDB_PROVIDER)
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "pvspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


_local_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach; the cluster names it in ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a fresh temporary folder.
    """
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="pvspark-")
    return _local_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute a small result once and keep it in the shared folder, cut from its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
