"""Session settings and the shared work folder."""

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Set once when the session is built. Skew splitting is forced because the fact joins end in
# a write or in an aggregate on another key, so the extra exchange it may add is cheaper than
# one task that holds a hot key.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def shuffle_partitions(input_bytes):
    """Partitions to start a shuffle with; adaptive execution merges those that stay small."""
    return min(max(200, -(-input_bytes // (256 << 20))), 50_000)


def build_session(app="freightflow", conf=None, input_bytes=None):
    """A session with the settings this library is tuned for; `conf` overrides them.

    Give the size of the input where it is known: 200 shuffle partitions do not hold 100 TB.
    """
    settings = dict(CLUSTER_CONF)
    if input_bytes:
        key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        settings[key] = str(shuffle_partitions(input_bytes))
    builder = SparkSession.builder.appName(app)
    for key, value in {**settings, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@functools.cache
def _local_base():
    base = tempfile.mkdtemp(prefix="freightflow-")
    atexit.register(shutil.rmtree, base, ignore_errors=True)
    return base


def work_folder(spark, name):
    """A new folder below `spark.checkpoint.dir`, which every executor can reach.

    Only a local master may do without that setting; it then gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = _local_base()
    return f"{base}/freightflow/{name}-{uuid.uuid4().hex}"
