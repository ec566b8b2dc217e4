"""Shared storage for steps that cut lineage, and small Spark helpers."""

from __future__ import annotations

import gc
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from ..storage import new_path, remove, shared_dir, staged  # noqa: F401


def width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def release(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of data frames that are no longer referenced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def arrow_bytes(spark: SparkSession, limit: int) -> Iterator[None]:
    """Tables written inside hand rows to Python in batches of about `limit` bytes, however large the rows are."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(name, None)
    spark.conf.set(name, str(limit))
    try:
        yield
    finally:
        spark.conf.unset(name) if was is None else spark.conf.set(name, was)
