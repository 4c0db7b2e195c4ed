"""Session construction and shared-folder helpers.

On a cluster the session is given and left as it is; ``local_session`` makes
one for tests and the bench.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

# Settings of a local session.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "eventide.spreadTexts": "true",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "eventide") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.sql.streaming.forceDeleteTempCheckpointLocation", "true")
    )
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="eventide-ckpt-"))
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder named by ``spark.checkpoint.dir``
    (or by ``setCheckpointDir``).  Writers create it; without a shared folder
    this raises instead of falling back to a folder of one machine."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("no shared folder: set spark.checkpoint.dir to a folder that driver and executors share")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/eventide/{purpose}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df, spark: SparkSession | None = None):
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    spark = spark or df.sparkSession
    shared_dir(spark, "lineage")  # makes sure a checkpoint dir is registered
    return df.checkpoint(eager=True)


def retire(spark: SparkSession, path: str) -> None:
    """Remove an old version of a state table from the shared folder (nothing
    happens where there is none)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
