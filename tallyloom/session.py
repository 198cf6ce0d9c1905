"""Session settings and the shared working folder."""

from __future__ import annotations

import atexit
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import cache
from uuid import uuid4

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

# Runtime settings every report relies on for skewed keys and for picking join strategies by measured size.
ADAPTIVE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot voucher or counterparty even where that costs one more shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Where every shuffled partition of one side is measured below this, hash it instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"


def tune(spark: SparkSession, shuffle_bytes: int | None = None, target_bytes: int = 256 << 20) -> SparkSession:
    """Switch on adaptive execution; with ``shuffle_bytes`` also size the initial number of shuffle partitions.

    Adaptive execution merges small shuffle partitions but splits only skewed join inputs, so a large job should
    start with enough partitions: the widest shuffle divided by ``target_bytes``.
    """
    for key, value in ADAPTIVE_SETTINGS.items():
        spark.conf.set(key, value)
    if shuffle_bytes is not None:
        wanted = max(1, -(-shuffle_bytes // target_bytes))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(wanted))
    return spark


# What Spark assumes of a source whose size it doesn't know, and the most partitions to start with.
UNKNOWN_BYTES = 1 << 62
MOST_PARTITIONS = 200_000


def scanned_bytes(df: DataFrame) -> int:
    """What the plan's scans are estimated to read, sources of unknown size left out.

    The estimate of the whole plan is of no use here, as that of a join multiplies its sides.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(size for size in sizes if size < UNKNOWN_BYTES)


@contextmanager
def sized_shuffles(df: DataFrame, target_bytes: int = 256 << 20) -> Iterator[int]:
    """Inside, shuffles start with enough partitions for all that ``df`` scans; afterwards the setting is what it was."""
    conf, key = df.sparkSession.conf, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = conf.get(key, None)
    usual = int(before or conf.get("spark.sql.shuffle.partitions"))
    wanted = max(usual, min(MOST_PARTITIONS, -(-scanned_bytes(df) // target_bytes)))
    conf.set(key, str(wanted))
    try:
        yield wanted
    finally:
        if before is None:
            conf.unset(key)
        else:
            conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder; a cluster session without it is refused.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    # "local-cluster[...]" has executors of its own, so a folder of the driver's machine won't do there either.
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tallyloom-")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system Spark keeps it; one that isn't there is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))


def run_folder(spark: SparkSession, name: str = "tallyloom") -> str:
    """A new folder in the shared one for the tables of one run. It goes when Python ends, if the session still stands."""
    path = f"{shared_folder(spark)}/{name}/{uuid4().hex}"

    def clean() -> None:
        with suppress(Py4JError, OSError):  # the JVM may have gone first
            if spark.sparkContext._jsc is not None:
                remove_folder(spark, path)

    atexit.register(clean)
    return path
