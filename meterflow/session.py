"""Session settings and the shared scratch location."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every plan relies on. UTC is needed for right results, the rest for speed.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "meterflow", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """This application's folder below the one all executors can reach, ``spark.checkpoint.dir``.

    Everything an application leaves there is in one folder named by its id, to be removed as a
    whole; checkpoints are removed by Spark when they are no longer referenced, if the cluster
    sets ``spark.cleaner.referenceTracking.cleanCheckpoints``. Without a named folder only a local
    master gets a temporary one: on a cluster other machines could not read it.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        # Local runs clean up after themselves.
        atexit.register(shutil.rmtree, local := tempfile.mkdtemp(prefix="meterflow-"), True)
        context.setCheckpointDir(local)
        named = context.getCheckpointDir()
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return f"{named.rstrip('/')}/{context.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
