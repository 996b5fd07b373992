"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import math
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Settings the workload relies on. Most are defaults in current Spark, stated against cluster
# profiles that turn them off. The advisory size is the default: reviews take five times their shuffled bytes in
# memory, the grain's hash table six times, and a task should hold them without a spill. The years of a table
# are written at once, up to so many, instead of sorting each task's rows by year first.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "64",
}
#: For sessions of a lake's own: shuffle files go when the query that wrote them ends, not when the driver next collects garbage, so
#: that a job of several writes needs the disk of one shuffle at a time.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
READ_BYTES = "spark.sql.files.maxPartitionBytes"
PARTITION_BYTES = 128 * 1024 * 1024


def create_session(
    app_name: str = "reviewmill",
    settings: dict[str, str] | None = None,
    partitions: int | None = None,
) -> SparkSession:
    """Session with the settings above, and with the given ones on top.

    partitions: how many partitions shuffles start with, see :func:`partitions_for`.
    """
    started = {INITIAL_PARTITIONS: str(partitions)} if partitions else {}
    merged = {**SETTINGS, **started, **(settings or {})}
    return SparkSession.builder.appName(app_name).config(map=merged).getOrCreate()


def own_session(
    spark: SparkSession, partitions: int | None = None, growth: float | None = None
) -> SparkSession:
    """A session of its own on the same application: the caller's settings, those above, and its
    own starting number of partitions. The caller's session stays as it is.

    growth: as in :func:`partitions_for`. A task that reads files then takes no more of them than turns
    into one shuffle partition, so that what it sorts before the shuffle needs no spill.
    """
    session = spark.newSession()
    kept = {**spark.conf.getAll, **SETTINGS, SHUFFLES_GO: "true"}
    if partitions:
        kept[INITIAL_PARTITIONS] = str(partitions)
    if growth:
        kept[READ_BYTES] = str(min(int(PARTITION_BYTES / growth), _bytes(spark, spark.conf.get(READ_BYTES))))
    for name, value in kept.items():
        if name.startswith("spark.sql.") and session.conf.isModifiable(name):
            session.conf.set(name, value)
    return session


def narrow_session(spark: SparkSession) -> SparkSession:
    """A session of its own for counts by keys of a few bytes: a shuffle partition of fewer bytes has as
    many rows as one of wide rows, and so its hash table fits in memory.
    """
    session = own_session(spark)
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(PARTITION_BYTES // 8))
    return session


def _bytes(spark: SparkSession, size: str) -> int:
    """A size setting such as 128MB as a number."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def partitions_for(input_bytes: int, growth: float = 1.0, partition_bytes: int = PARTITION_BYTES) -> int:
    """How many partitions shuffles of this much input should start with.

    Adaptive execution merges partitions that turn out small but can't split those of an aggregation
    or a window, so the number has to grow with the input. growth: bytes in a shuffle for
    each stored byte, above 1 for compressed feeds (about 6 for gzip'd review text).
    """
    return max(1, math.ceil(input_bytes * growth / partition_bytes))


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach.

    Lies below the shared folder the cluster names in ``spark.checkpoint.dir``. Only a local
    master, where driver and executors are one machine, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        shared = _local_folder()
    return f"{shared.rstrip('/')}/reviewmill/{purpose}-{uuid.uuid4().hex}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="reviewmill-")
