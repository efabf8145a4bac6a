"""Session settings the operators rely on."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

# Event-time operators are defined in UTC; AQE splits skewed joins and coalesces small partitions.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even when an aggregate on the same key follows it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Stream state on disk with changes only in the checkpoint; stateful processors need this store.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# A task holds what it reads many times over: sorted, hashed and uncompressed, once for each operator of its stage. With
# larger parts than these, tasks grow with the input until they reach Spark's defaults; a session may set smaller ones.
MOST_BYTES = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 64 << 20,
}


def size_in_bytes(text: str) -> int:
    """Spark's notation of sizes (``64m``, ``128MB``, ``1024``) as a number."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)(?:i?b)?\s*", text.lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def build_session(app: str = "finlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session somebody else built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    for key, most in MOST_BYTES.items():
        if size_in_bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    return spark


def checkpoint_path(spark: SparkSession, name: str) -> str:
    """Folder for one query's checkpoint, below the shared folder the cluster names."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("spark.checkpoint.dir is not set; name a folder every executor can reach")
    return f"{root.rstrip('/')}/finlake/{name}"
