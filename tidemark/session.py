"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that hold at any data size: partitions are planned small and merged
# at run time, skewed join partitions are split, and a shuffled join only builds
# a hash table when every build partition is measured to be small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64MB",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
}


# One shuffle partition is planned per this many bytes of the largest table; those
# that turn out small are merged at run time, those too large spill.
BYTES_PER_PARTITION = 256 * 2**20


def planned_partitions(largest_table_bytes: int) -> int:
    """How many shuffle partitions to start from for tables of this size."""
    return max(200, -(-largest_table_bytes // BYTES_PER_PARTITION))


def get_spark(
    app: str = "tidemark", master: str | None = None, largest_table_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``__`` for dots.

    Spark merges small shuffle partitions but never adds any, so the size of the
    largest table should be given when it is known.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if largest_table_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(planned_partitions(largest_table_bytes)))
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or ``spark.tidemark.dir`` where that is unset."""
    named = (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
             or spark.conf.get("spark.tidemark.dir", None))
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return named.rstrip("/")


def new_workdir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared one; never reused, so no run reads another's files."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


# What a query has shuffled is removed as it ends, and not when the driver happens to collect its garbage. For steps that are
# written and read again: frames made under this setting should run once.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, changed: dict[str, str]) -> Iterator[None]:
    """Session settings for as long as the block runs."""
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
