"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Deduplication keeps one state row per claim id: hold that state on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "claimwright", *, hive: bool = False, warehouse: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with the pipeline's defaults; `conf` wins over them. Cluster size and shuffle
    partitions are left to the cluster's own configuration."""
    builder = SparkSession.builder.appName(app_name)
    settings = dict(DEFAULTS)
    if warehouse:
        settings["spark.sql.warehouse.dir"] = warehouse
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`; a folder of the
    warehouse, which is shared as well, where that is not set."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Compressed input per shuffle partition. Rows grow several times when decoded and sorted, so this keeps a
# partition within an executor core's share of memory.
BYTES_PER_PARTITION = 128 * 1024 * 1024


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Raise `spark.sql.shuffle.partitions` to fit the input, never lower it; returns the setting.

    Adaptive execution merges partitions that turn out small, but it cannot split what was cut too coarsely."""
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = -(-input_bytes // BYTES_PER_PARTITION)
    if needed > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(needed))
    return max(needed, current)


# Compressed order tables per shuffle partition where claims are made of them: columns of a few bits become rows of some
# 400 bytes, about thirty times the files, and deduplication sorts them on both sides of its shuffle.
ORDER_BYTES_PER_PARTITION = 16 * 1024 * 1024


@contextmanager
def settings(spark: SparkSession, **values: object) -> Iterator[None]:
    """Session settings, named with `__` for a dot, that hold while the block runs."""
    names = {name.replace("__", "."): str(value) for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int, per_partition: int = ORDER_BYTES_PER_PARTITION) -> Iterator[int]:
    """At least one shuffle partition for each `per_partition` bytes of input while the block runs, so that what a task
    sorts stays in memory; the session's setting is never lowered and holds again afterwards."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    partitions = max(int(before), -(-input_bytes // per_partition))
    spark.conf.set(name, str(partitions))
    try:
        yield partitions
    finally:
        spark.conf.set(name, before)
