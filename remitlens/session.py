"""Spark session construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every job relies on: AQE re-plans joins/partition counts at
# runtime (and splits skewed join partitions), the session zone is pinned so
# timestamp arithmetic is reproducible, and partition overwrite is dynamic so
# re-loading one slice never wipes the others.
_BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Streaming state on disk, looked up by key; its changes are what a checkpoint writes.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Checkpoint files (lineage cuts) are removed once their RDD is unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(cpus: int | str | None = None, shuffle_partitions: int | None = None,
              app: str = "remitlens", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the provided session."""
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(_BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    conf["spark.driver.memory"] = "16g"
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read here
    (an unset value is an error there). When it is unset on a local master
    (unit tests on one machine) a private folder is created and registered, so
    lineage cuts and intermediate tables still work.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            # A machine-local folder would break lineage cuts on a cluster.
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        root = tempfile.mkdtemp(prefix="remitlens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_SCRATCH: list[str] = []  # the scratch paths given out, in order


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint folder."""
    _SCRATCH.append(f"{checkpoint_root(spark)}/remitlens/{name}-{uuid.uuid4().hex[:12]}")
    return _SCRATCH[-1]


def scratch_since(mark: int = 0) -> tuple[list[str], int]:
    """(the scratch paths given out since ``mark``, the mark of now)."""
    return _SCRATCH[mark:], len(_SCRATCH)


def remove_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder on the file system that Spark reaches it by; False if there was none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def materialize(df):
    """Compute ``df`` once and cut its lineage: a reliable checkpoint in the
    shared checkpoint folder (survives executor loss; never localCheckpoint).
    Used where a small intermediate is read several times in one plan."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


ROWS_PER_RANGE = 1_000_000


def range_count(rows) -> int:
    """Number of key ranges for rows that are stored already: the session's
    shuffle partitions, or more when a range would exceed ``ROWS_PER_RANGE``."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows.count() // ROWS_PER_RANGE))
