"""Supersteps: hubs' edges are dealt evenly, chains of any length give the same, superseded tables go."""

import math
import os
import random
import statistics
import threading
import time

import pytest
from pyspark.sql import functions as F

from graphloom.engine import Engine, ExecutionError
from graphloom.functions import metrics as M
from graphloom.model import Graph, GraphError
from graphloom.operators import algorithms as A
from graphloom.operators import iterate

from .test_golden import make, values


@pytest.fixture(scope="module")
def star(spark):
    """A vertex with half of all edges."""
    r = random.Random(4)
    edges = [(0, 1 + i % 4000, 1.0 + i % 7) for i in range(20_000)] + [(r.randrange(1, 4000), r.randrange(4000), r.random()) for _ in range(20_000)]
    return make(spark, edges, range(4001))


def test_hub_edges_are_even(spark, star, monkeypatch):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        state = star.vertices.withColumn("rank", F.lit(1.0))
        monkeypatch.setattr(iterate, "PART_EDGES", 1000)
        with iterate.dealt(star.edges, "src", hub=50) as ways:
            assert ways.hubs is not None and ways.hubs.count() <= 2 * iterate.SHARES * 8
            sizes = [r["n"] for r in ways.edges.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
            assert len(sizes) == 8 and sum(sizes) == 40_000 and max(sizes) <= 2 * statistics.median(sizes)
            sent = ways.sends(state)
            tasks = [r["n"] for r in sent.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
            assert sum(tasks) == 40_000 and max(tasks) <= 2 * statistics.median(tasks)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)


def test_algorithms_with_hubs(star):
    g = star
    for f, name in ((A.pagerank, "rank"), (A.cdlp, "label"), (lambda g, **k: A.bfs(g, 0, **k), "level"), (lambda g, **k: A.sssp(g, 0, **k), "distance")):
        plain, dealt = values(f(g), name), values(f(g, hub=50), name)
        assert plain.keys() == dealt.keys()
        for i, x in plain.items():
            assert x == dealt[i] or math.isclose(x, dealt[i], rel_tol=1e-12), (name, i)


@pytest.mark.parametrize("hops,merge", [(1, 1), (3, 2)])
def test_traversals_in_short_supersteps(spark, monkeypatch, hops, merge):
    edges = [(i, i + 1, 1.0 + i % 3) for i in range(40)] + [(0, 20, 3.0), (5, 39, 500.0)]
    g = make(spark, edges, range(45))
    want = values(A.bfs(g, 0), "level"), values(A.sssp(g, 0), "distance")
    monkeypatch.setattr(iterate, "MOST_HOPS", hops)
    monkeypatch.setattr(A, "MERGE", merge)
    assert (values(A.bfs(g, 0), "level"), values(A.sssp(g, 0), "distance")) == want
    assert want[0][39] == 6 and want[0][40] == 7 and want[0][41] is None


def test_superseded_tables_are_deleted(spark):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    before = set(os.listdir(folder))
    g = make(spark, [(i, i + 1, 1.0) for i in range(30)], range(31))
    A.wcc(g).count()
    (made,) = set(os.listdir(folder)) - before
    assert len(os.listdir(f"{folder}/{made}")) == 1
    A.cdlp(g, iterations=12).count()
    made = {x for x in set(os.listdir(folder)) - before if x.startswith("cdlp")}
    assert len(os.listdir(f"{folder}/{made.pop()}")) == 1
    assert not {x for x in os.listdir(folder) if x.startswith("dealt")}
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4" and spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_trace_of_run(spark, tmp_path):
    engine = Engine(spark, str(tmp_path / "home"))
    engine.add_graph("mini", make(spark, [(1, 2, 1.0)], [1, 2]))
    run = engine.run("bfs", "mini", root=1, output=str(tmp_path / "out"))
    log = spark.createDataFrame([(x,) for x in run.lines], "line string")
    ops = {r.mission: r for r in M.operations(M.trace_records(log)).collect()}
    assert set(ops) == {"Job", "LoadGraph", "ProcessGraph", "OffloadGraph"}
    assert all(o.parent == M.PARENTS[m] and ops["Job"].start_ms <= o.start_ms <= o.end_ms <= ops["Job"].end_ms for m, o in ops.items())
    assert M.breakdown(M.operations(M.trace_records(log))).first().processing_ms == ops["ProcessGraph"].duration_ms
    assert engine.finalize(run)["processing_time"] * 1000 == ops["ProcessGraph"].duration_ms
    assert {M.trace_text(dict.fromkeys(M.TRACE_FIELDS, "a b:c"))} == {r.x for r in spark.range(1).select(M.trace_line({k: F.lit("a b:c") for k in M.TRACE_FIELDS}).alias("x")).collect()}


def test_load_validates(spark, tmp_path):
    engine = Engine(spark, str(tmp_path / "home"))
    with pytest.raises(GraphError):
        engine.add_graph("bad", make(spark, [(1, 7, 1.0)], [1, 2]))
    assert not (tmp_path / "home" / "bad").exists()
    with pytest.raises(ExecutionError):
        engine.run("wcc", "bad")


def test_cancel_a_running_job(spark, tmp_path):
    engine = Engine(spark, str(tmp_path / "home"))
    slow = spark.range(8).repartition(4).select(F.expr("id").alias("src"), F.expr("if(reflect('java.lang.Thread', 'sleep', 60000L) is null, id, id)").alias("dst"))
    seen = []

    def run():
        try:
            engine.run("wcc", Graph(spark.range(8), slow), job_id="slow")
        except ExecutionError as e:
            seen.append(e)

    t = threading.Thread(target=run)
    begin = time.time()
    t.start()
    while not spark.sparkContext.statusTracker().getJobIdsForGroup("slow") and time.time() < begin + 30:
        time.sleep(0.2)
    engine.terminate("slow")
    t.join(50)
    assert seen and time.time() < begin + 55
    assert "slow" not in os.listdir(f"{spark.sparkContext.getCheckpointDir().removeprefix('file:')}/runs")
