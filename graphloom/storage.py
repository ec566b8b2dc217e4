"""Tables that cut lineage: written to storage that every executor reaches."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession


@dataclass
class _Run:
    """The run that is going on: its folder, how often each name was used in it, and the tables that the session knows of it."""

    folder: str
    used: Counter = field(default_factory=Counter)
    tables: list[str] = field(default_factory=list)


_run: ContextVar[_Run | None] = ContextVar("run", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir.

    Where none is named, a temporary one serves a local master, whose executors share the driver's disk; on a
    cluster they wouldn't, so there it raises.
    """
    have = spark.sparkContext.getCheckpointDir()
    if have:
        return have
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the folder of the run that is going on, or else in the shared folder."""
    run = _run.get()
    return f"{run.folder if run else shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession, run: str, keep: bool = False) -> Iterator[str]:
    """Inside, all tables are made in one folder named after the run.

    It is deleted at the end, and if what is done inside fails or is cancelled; with `keep` a failed run's folder stays, to be
    resumed.  Where the driver is lost it stays too: a run of the same name goes on from it or replaces it.
    """
    now = _Run(f"{shared_dir(spark)}/runs/{run}")
    token, done = _run.set(now), False
    try:
        yield now.folder
        done = True
    finally:
        _run.reset(token)
        for table in now.tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        if done or not keep:
            remove(spark, now.folder)


def resumable_path(name: str) -> str | None:
    """The path that the n-th use of a name has in the run that is going on, whichever driver runs it; None outside runs."""
    run = _run.get()
    if not run:
        return None
    run.used[name] += 1
    return f"{run.folder}/{name}-{run.used[name]}"


def _known(table: str) -> str:
    if run := _run.get():
        run.tables.append(table)
    return table


def staged(df: DataFrame, name: str = "stage", partition_by: list[str] | None = None) -> DataFrame:
    """df written as Parquet in the shared folder and read back: executors can be lost afterwards."""
    path = new_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, path: str, **measures: Column) -> tuple[DataFrame, dict]:
    """df written to a path and read back, with aggregates that were taken while it was written (no further job)."""
    seen = Observation()
    watched = df.observe(seen, *[c.alias(k) for k, c in measures.items()]) if measures else df
    watched.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get if measures else {}


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def put_json(spark: SparkSession, path: str, value: object) -> None:
    """Writes a small value as a file that is there whole or not at all: under another name first, then renamed.

    The rename is atomic on HDFS and local disks; stores that copy instead make the file visible when it is complete, too.
    """
    p, fs = _file_system(spark, path)
    t, _ = _file_system(spark, f"{path}-{uuid.uuid4().hex}.tmp")
    out = fs.create(t, True)
    out.write(bytearray(json.dumps(value).encode()))
    out.close()
    if not fs.rename(t, p):
        raise RuntimeError(f"{path} can't be written")


def move(spark: SparkSession, path: str, to: str) -> None:
    """Renames a folder; what was there before goes."""
    p, fs = _file_system(spark, path)
    t, _ = _file_system(spark, to)
    fs.delete(t, True)
    fs.mkdirs(t.getParent())
    if not fs.rename(p, t):
        raise RuntimeError(f"{path} can't be moved to {to}")


def get_json(spark: SparkSession, path: str) -> object | None:
    """What put_json wrote; None if there is no such file."""
    p, fs = _file_system(spark, path)
    try:
        stream = fs.open(p)
    except Py4JJavaError as e:
        if "FileNotFoundException" in str(e.java_exception):
            return None
        raise
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none if it isn't there."""
    p, fs = _file_system(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def bucketed(df: DataFrame, path: str, table: str, buckets: int, by: list[str], order: list[str]) -> DataFrame:
    """df written as an external table of that many buckets, one file each, sorted; read back, it needs no shuffle by these columns."""
    spark = df.sparkSession
    rows = df.repartition(buckets, *by)
    spark.sql(f"DROP TABLE IF EXISTS {table}")  # one of a run that was lost; files of external tables stay
    rows.write.bucketBy(buckets, *by).sortBy(*order).option("path", path).option("compression", "zstd").format("parquet").saveAsTable(_known(table))
    return spark.table(table)


def bucketed_at(spark: SparkSession, path: str, table: str, schema: str, buckets: int, by: list[str], order: list[str]) -> DataFrame:
    """A table that `bucketed` wrote, in this session or another."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING parquet CLUSTERED BY ({', '.join(by)}) SORTED BY ({', '.join(order)}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(_known(table))


def remove(spark: SparkSession, path: str) -> bool:
    """Deletes a folder through Hadoop's file system; False if it wasn't there."""
    p, fs = _file_system(spark, path)
    return fs.exists(p) and fs.delete(p, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings as given, inside."""
    was = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def static_plans(spark: SparkSession, partitions: int, compiled: bool) -> Iterator[None]:
    """Plans run as they were planned, as one job, over that many shuffle partitions; where few rows are known to come, interpreted.

    For chains of many shuffles whose sizes are known and whose partitions are even by construction.
    """
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(partitions), "spark.sql.codegen.wholeStage": str(compiled).lower()}
    with settings(spark, names):
        yield
