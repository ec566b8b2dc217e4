"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cluster import staged

LOCAL_EDGES = 200_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component) that connect what a-b connect."""
    ids, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[: len(a)], flat[len(a) :]
    label = np.arange(len(ids))
    while len(u):
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        while True:
            up = new[new]
            if (up == new).all():
                break
            new = up
        label = new[label]
        live = label[u] != label[v]
        u, v = u[live], v[live]
    away = label != np.arange(len(ids))
    return ids[away], ids[label[away]]


def _local(batches):
    """Replaces the edges that a task holds by a forest, a bounded number at a time."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    kept, n = [], 0

    def flush():
        a = np.concatenate([x for x, _ in kept])
        b = np.concatenate([y for _, y in kept])
        return forest(a, b)

    for batch in batches:
        kept.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)))
        n += batch.num_rows
        if n > LOCAL_EDGES:
            a, b = flush()
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)
            kept, n = [], 0
    if n:
        a, b = flush()
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=schema)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id that a link names; component is the smallest id reachable.

    edges: two long columns, in either direction, repeated or self links allowed;
    rows with a null are no link.  No links: no rows.  Nothing is brought to the
    driver but two numbers a round; each round ends in a table in the shared folder.
    """
    a, b = edges.columns[:2]
    e = (
        edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
        .where("a <> b")
        .mapInArrow(_local, "a long, b long")
    )
    e = staged(e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    for _ in range(max_rounds):
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = both.join(low, "u").where("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        both = large.join(low, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("x"))
        e = staged(both.select(F.col("x.a").alias("a"), F.col("x.m").alias("b")).where("a <> b").distinct(), "links")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(e.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
