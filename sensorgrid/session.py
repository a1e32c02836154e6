"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that hold for batch and streaming at any size. Shuffle parallelism is
# left to the cluster's own configuration: AQE coalesces batch shuffles, and a
# stream fixes its state partitions at its first checkpoint.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # HotSpot does not compile methods above this many bytes; a stage that would
    # exceed it runs operator by operator instead of interpreted as a whole.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "sensorgrid", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the engine's settings; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Root of the folder every executor can reach (``spark.checkpoint.dir``).

    Only a local session may go without the setting; there a new temporary
    folder is taken and remembered in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="sensorgrid-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it lies."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def settle(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of steps that have ended.

    It does so when the driver collects garbage, which one that mostly waits seldom does
    by itself. A listener holds the last event it was told, and so the query that has
    ended with it, until another one comes: that of a query without shuffle files.
    """
    gc.collect()
    spark.range(1, numPartitions=1).collect()
    with contextlib.suppress(Py4JError):  # what is not told by then goes with a later step
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    spark.sparkContext._jvm.System.gc()
