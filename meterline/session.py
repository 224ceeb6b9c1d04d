"""Session construction and the few session settings the engine relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every run needs.  Trip timestamps are wall-clock values without a
# zone; they are read in UTC so durations and calendar keys never depend on the
# machine's zone or on daylight-saving jumps.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings recommended for scale; applied by build_session, never forced on a
# session someone else built.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_MB = 1024 * 1024

# Profile for a large cluster reading ~100 TB of trip files.  Scan splits of
# 512 MB keep the map side near 200k tasks; the dedup shuffle (the only one
# that moves whole rows) starts at 65,536 partitions, about 1 GB of valid rows
# each when half of 100 TB survives the filters, and AQE merges partitions
# toward 512 MB and splits skewed ones.  The dedup's sort-based aggregate
# spills, so a large partition costs disk, not memory.  Decommissioning moves
# shuffle blocks off executors that are going away.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(512 * _MB),
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "65536",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(512 * _MB),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * _MB),
    "spark.sql.autoBroadcastJoinThreshold": str(64 * _MB),
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "meterline",
                  shuffle_partitions: int = 8, extra: dict | None = None,
                  profile: str = "local") -> SparkSession:
    """``profile="cluster"`` adds ``CLUSTER_CONF`` (and ignores
    ``shuffle_partitions``: AQE sizes partitions from the data)."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = {**RECOMMENDED_CONF, **REQUIRED_CONF,
            "spark.sql.shuffle.partitions": str(shuffle_partitions)}
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
        conf["spark.sql.shuffle.partitions"] = CLUSTER_CONF[
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum"]
    elif profile != "local":
        raise ValueError(f"unknown profile: {profile}")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required settings to an existing session."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a private folder of its
    own (tests); a cluster session without it is an error, because a
    machine-local folder would not survive the loss of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
        # "local-cluster[...]" has executors of its own.
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="meterline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at ``path``, in any store Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def partition_values(spark: SparkSession, path: str, name: str) -> list[str]:
    """The values v of the folders ``<path>/<name>=v``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path, f"{name}=*")
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return sorted(f.getPath().getName().partition("=")[2] for f in found or [])


def newest_partition(spark: SparkSession, path: str, name: str) -> int:
    """The greatest of ``partition_values``, as numbers; -1 without any."""
    return max(map(int, partition_values(spark, path, name)), default=-1)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/meterline-{label}-{uuid.uuid4().hex}"
