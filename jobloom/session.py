"""Session profiles and the shared scratch folder."""

from __future__ import annotations

import importlib.util
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every profile shares.
COMMON = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even where the result then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "52428800",
    "spark.sql.parquet.compression.codec": "snappy",
    # Python's JSON reader lets the last of two equal keys win.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A replayed batch replaces only its own partition of a sink.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

LOCAL = {
    "spark.ui.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "8g",
}

CLUSTER = {
    # Executors come and go with the load; shuffle data is tracked so that they can.
    "spark.dynamicAllocation.enabled": "true",
    "spark.dynamicAllocation.shuffleTracking.enabled": "true",
    # A micro-batch comes every second, so an executor is worth keeping between batches.
    "spark.dynamicAllocation.executorIdleTimeout": "120s",
    # Shuffle and cached blocks move off an executor that is about to leave.
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    # Start wide; AQE coalesces what turns out small.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Stores other than Amazon's need no DNS name for each bucket.
    "spark.hadoop.fs.s3a.path.style.access": "true",
}

# What the format's documentation asks a session to set.
DELTA = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def session_settings(
    profile: str = "local",
    *,
    executor_cores: int = 1,
    max_executors: int | None = None,
    warehouse: str | None = None,
    metastore: str | None = None,
    s3_endpoint: str | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    """The settings of a profile ("local" or "cluster") as a plain dict.

    S3 credentials are left to the provider chain of the cluster.
    """
    if profile not in ("local", "cluster"):
        raise ValueError(f"unknown profile: {profile}")
    if executor_cores < 1:
        raise ValueError("executor_cores must be >= 1")
    conf = dict(COMMON)
    if profile == "local":
        conf |= LOCAL
    else:
        conf |= CLUSTER
        conf["spark.executor.cores"] = str(executor_cores)
        if max_executors:
            conf["spark.dynamicAllocation.maxExecutors"] = str(max_executors)
        if metastore:
            conf["spark.hive.metastore.uris"] = metastore
            conf["spark.sql.catalogImplementation"] = "hive"
        if s3_endpoint:
            conf["spark.hadoop.fs.s3a.endpoint"] = s3_endpoint
    if importlib.util.find_spec("delta"):
        conf |= DELTA
    if warehouse:
        conf["spark.sql.warehouse.dir"] = warehouse.rstrip("/") + "/"
    return conf | (extra or {})


def build_session(app_name: str, profile: str = "local", *, cores: int | str = "*",
                  **settings) -> SparkSession:
    """One long-lived session; users are kept apart by namespace, not by session."""
    if not app_name or not app_name.strip():
        raise ValueError("app_name is required")
    builder = SparkSession.builder.appName(app_name.strip())
    if profile == "local":
        builder = builder.master(f"local[{cores}]")
    for key, value in session_settings(profile, **settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_runtime_settings(spark: SparkSession) -> SparkSession:
    """Apply the shared settings that results depend on to a session made elsewhere."""
    for key in ("spark.sql.session.timeZone", "spark.sql.variant.allowDuplicateKeys",
                "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(key, COMMON[key])
    return spark


_local_root: str | None = None
_below: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder for `name` below the cluster's shared checkpoint folder, or below the innermost
    open scratch folder.

    Only a local master may fall back to a folder of this machine.
    """
    global _local_root
    root = _below[-1] if _below else spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        if _local_root is None:
            _local_root = "file://" + tempfile.mkdtemp(prefix="jobloom-")
        root = _local_root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[str]:
    """A shared folder below which the shared folders asked for meanwhile lie, so that all of them can
    be removed at once."""
    _below.append(shared_dir(spark, name))
    try:
        yield _below[-1]
    finally:
        _below.pop()
