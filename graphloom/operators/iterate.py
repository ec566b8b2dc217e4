"""Iteration: supersteps of several hops that end in a written table, and edges kept dealt by their source between them."""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..model import Adjacency
from ..storage import bucketed, bucketed_at, get_json, listed, new_path, put_json, remove, resumable_path, static_plans, written

HUB = 100_000  # a source with more edges is dealt over several partitions, once that is more than a share of 1 / SHARES of one
SHARES = 16
PART_EDGES = 25_000  # fewer edges don't fill a partition: small graphs are dealt over fewer than the session's number
FULL_EDGES = 250_000  # this many fill one well: more partitions than cores only once each of them gets that many, as a shuffle has as many blocks as its partitions squared
MOST_EDGES = 2_000_000  # more don't fit beside the state of their vertices: large graphs are dealt over more than the session's number
CHAIN = 5  # steps of fixed-count iterations planned as one job
MOST_HOPS, CHAIN_ROWS = 10, 1_000_000  # hops of a traversal planned as one job, as long as they are expected to reach no more rows


class Supersteps:
    """Writes each superstep's rows to the shared folder: plans stay short, and lost executors cost one superstep at most.

    In a run (see run_folder) each superstep ends in a manifest: the tables that make the state, and the values with which
    the loop goes on.  A new driver that starts the run again under its name finds the last one and goes on from there; a manifest of
    other parameters is thrown away.  What is superseded is deleted only once a manifest no longer names it.

    With `buckets` tables are bucketed by id, so that joins by id leave them where they are.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int | None = None, **parameters: object):
        self.spark = spark
        self.buckets = buckets
        path = resumable_path(name)
        self.resumable = path is not None
        self.folder = path or new_path(spark, name)
        self.parameters = {k: str(v) for k, v in parameters.items()}
        self.paths: list[str] = []
        self.values: dict = {}
        self.stale: list[str] = []
        self.schema = None
        self.made = 0
        if self.resumable:
            self._resume()

    def _resume(self) -> None:
        found = listed(self.spark, self.folder)
        manifests = [x for x in found if x.startswith("manifest-") and x.endswith(".json")]
        last = get_json(self.spark, f"{self.folder}/{manifests[-1]}") if manifests else None
        if not last or last["parameters"] != self.parameters:
            remove(self.spark, self.folder)
            return
        self.values, self.made, self.schema = last["values"], last["made"], StructType.fromJson(last["schema"])
        self.paths = [f"{self.folder}/{x}" for x in last["tables"]]
        for x in {*found} - {*last["tables"], *manifests}:  # begun, never committed
            self._remove(f"{self.folder}/{x}")

    def commit(self, **values: object) -> None:
        """The superstep is over: the loop can be taken up from here with these values."""
        self.values = values
        if self.resumable:
            tables = [p.rsplit("/", 1)[1] for p in self.paths]
            put_json(self.spark, f"{self.folder}/manifest-{self.made:06d}.json", {"parameters": self.parameters, "tables": tables, "values": values, "made": self.made, "schema": json.loads(self.schema.json())})
        for path in self.stale:
            self._remove(path)
        self.stale = []

    def _name(self, path: str) -> str:
        return f"superstep_{hashlib.md5(path.encode()).hexdigest()}"

    def _remove(self, path: str) -> None:
        if self.buckets:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(path)}")
        remove(self.spark, path)

    def _read(self, path: str) -> DataFrame:
        if self.buckets:
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in self.schema)
            return bucketed_at(self.spark, path, self._name(path), columns, self.buckets, ["id"], ["id"])
        return self.spark.read.schema(self.schema).parquet(path)

    def write(self, df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
        """df as a new table, and the measures taken while it was written."""
        path = f"{self.folder}/{self.made}"
        self.schema = self.schema or df.schema
        if self.buckets:
            seen = Observation()
            watched = df.observe(seen, *[c.alias(k) for k, c in measures.items()]) if measures else df
            out = bucketed(watched, path, self._name(path), self.buckets, ["id"], ["id"])
            seen = seen.get if measures else {}
        else:
            out, seen = written(df, path, **measures)
        self.paths.append(path)
        self.made += 1
        return out, seen

    def table(self, i: int = -1) -> DataFrame:
        """One of the tables that are there, by default the last."""
        return self._read(self.paths[i])

    def tables(self) -> list[DataFrame]:
        return [self._read(p) for p in self.paths]

    def all(self) -> DataFrame:
        """Rows of all tables that are there."""
        return self.spark.read.schema(self.schema).parquet(*self.paths)

    def replace(self, df: DataFrame, keep: int = 0, **measures: Column) -> tuple[DataFrame, dict]:
        """df, made from the tables that are there less the last `keep`, in their place; they go with the next commit."""
        cut = len(self.paths) - keep
        old, rest = self.paths[:cut], self.paths[cut:]
        self.paths = []
        out, seen = self.write(df, **measures)
        self.paths += rest
        self.stale += old
        return out, seen

    def but_last(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*self.paths[:-1])


def partitions_for(spark: SparkSession, rows: int) -> int:
    """The session's number, but fewer where they wouldn't be filled, and more where their rows, and so the state that is hashed beside them, would grow too large.

    Up to the number of cores PART_EDGES rows are enough for one, from there on it takes FULL_EDGES.
    """
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // MOST_EDGES))
    filled = min(-(-rows // PART_EDGES), max(spark.sparkContext.defaultParallelism, -(-rows // FULL_EDGES)))
    return max(1, min(most, filled))


@dataclass
class Dealt:
    """Edges dealt by the vertex that messages leave, and kept; hubs' edges lie under several salts."""

    edges: DataFrame
    key: str
    hubs: DataFrame | None
    parts: int
    measures: dict
    sparse: bool = False

    def meeting(self, sent: DataFrame) -> DataFrame:
        """What is sent (id, ...), before it is summed by id and more: where the ids have few edges, moved to its id's partition, once for all sums by id.

        Elsewhere it stays where it is, so that what one partition sends to a hub, or to an id of many edges, is summed before it moves.
        """
        return sent.repartition(self.parts, "id") if self.sparse else sent

    def sends(self, state: DataFrame) -> DataFrame:
        """state (id, ...), a row or two per id, joined with the edges of its ids.

        The state is hashed per partition, the edges only stream past it; without hubs a state dealt by id doesn't move.  A partition has no more
        vertices with edges than edges, so what is hashed is bounded as these are (partitions_for).
        """
        if self.hubs is None:
            return state.hint("shuffle_hash").join(self.edges, F.col("id") == F.col(self.key))
        # one row per hub, fewer than SHARES * partitions * 2 by the limit that makes a hub
        spread = state.join(F.broadcast(self.hubs), "id", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))).drop("salts")
        return spread.hint("shuffle_hash").join(self.edges, (F.col("id") == F.col(self.key)) & (F.col("_salt") == F.col("salt")))


def salts_of(rows: DataFrame, key: str, total: int, parts: int, hub: int, path: str) -> DataFrame | None:
    """(id, salts) of the vertices with more than a partition's fair share of rows, as a table; None if there are none."""
    limit = max(hub, math.ceil(total / (SHARES * parts)))
    if total <= limit:
        return None
    degrees = rows.groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n")).where(F.col("n") > limit)
    hubs, _ = written(degrees.select("id", F.ceil(F.col("n") / limit).cast("int").alias("salts")), path)
    return None if hubs.isEmpty() else hubs


def salted(rows: DataFrame, key: str, hubs: DataFrame) -> DataFrame:
    """rows with salt: of a hub's rows one of its salts each, else 0."""
    other = [c for c in rows.columns if c != key]
    salt = F.pmod(F.xxhash64(*other), F.coalesce("_salts", F.lit(1))).cast("int")
    return rows.join(F.broadcast(hubs.select(F.col("id").alias("_hub"), F.col("salts").alias("_salts"))), F.col(key) == F.col("_hub"), "left").withColumn("salt", salt).drop("_hub", "_salts")


@contextmanager
def placed(df: DataFrame, at: Adjacency, **measures: Column) -> Iterator[Dealt]:
    """Rows of a loaded adjacency, which lie dealt by src in its buckets: they are kept as they are read, neither written nor shuffled."""
    spark = df.sparkSession
    with static_plans(spark, at.buckets, compiled=at.size > CHAIN_ROWS):
        kept = df.persist()
        try:
            yield Dealt(kept, "src", at.hubs, at.buckets, kept.agg(*[c.alias(k) for k, c in measures.items()]).first().asDict() if measures else {}, at.sparse)
        finally:
            kept.unpersist()


@contextmanager
def dealt(df: DataFrame, key: str = "src", hub: int = HUB, **measures: Column) -> Iterator[Dealt]:
    """df written once, then dealt by `key` and kept in memory or on local disk; lost parts are read again.

    No partition gets a hub's edges alone: what leaves a vertex of more than `limit` edges is dealt by salt too.
    Inside, plans are static and over as many partitions as the edges.
    """
    spark = df.sparkSession
    path = new_path(spark, "dealt")
    rows, seen = written(df, path, _n=F.count("*"), **measures)
    parts = partitions_for(spark, seen["_n"])
    hubs, by = salts_of(rows, key, seen["_n"], parts, hub, f"{path}-hubs"), [key]
    if hubs is not None:
        rows, by = salted(rows, key, hubs), [key, "salt"]
    kept = rows.repartition(parts, *by).persist()
    try:
        with static_plans(spark, parts, compiled=seen["_n"] > CHAIN_ROWS):
            yield Dealt(kept, key, hubs, parts, seen)
    finally:
        kept.unpersist()
        remove(spark, path)
        remove(spark, f"{path}-hubs")


def hops_for(rows: int, before: int, hops: int) -> int:
    """Hops of the next superstep: as many as keep the rows under CHAIN_ROWS, if they grow as they did in the last one."""
    growth = max(1.1, rows / max(before, 1)) ** (1 / hops)
    return max(1, min(MOST_HOPS, int(math.log(max(CHAIN_ROWS / max(rows, 1), 1)) / math.log(growth))))
