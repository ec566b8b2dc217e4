"""Files, engine and log metrics."""

from decimal import Decimal

import pytest

from graphloom.engine import Engine, ExecutionError
from graphloom.functions import metrics as M
from graphloom.model import GraphError
from graphloom.sources import files


@pytest.fixture()
def text_graph(tmp_path):
    (tmp_path / "vertex.csv").write_text("1\n2\n3\n4\n")
    (tmp_path / "edge.csv").write_text("1 2 0.5\n2 3 1.5\n")
    return str(tmp_path / "vertex.csv"), str(tmp_path / "edge.csv")


def test_engine(spark, tmp_path, text_graph):
    engine = Engine(spark, str(tmp_path / "home"), str(tmp_path / "logs" / "run.log"))
    engine.verify_setup()
    engine.startup()
    g = engine.load_graph("mini", *text_graph, directed=False, weighted=True)
    assert g.edges.count() == 4 and g.weighted
    out = str(tmp_path / "out")
    run = engine.run("sssp", "mini", output=out, root=1)
    lines = sorted(r.value for r in spark.read.text(out).collect())
    assert lines == ["1 0.000000000000000e+00", "2 5.000000000000000e-01", "3 2.000000000000000e+00", "4 infinity"]
    seconds = engine.finalize(run)["processing_time"]
    assert seconds > 0 and M.processing_time(M.read_logs(spark, str(tmp_path / "logs"))) == seconds
    assert engine.run("wcc", "mini", runs=2).result.count() == 4
    for bad in (lambda: engine.run("apsp", "mini"), lambda: engine.run("wcc", "other"), lambda: engine.run("bfs", "mini", root=9)):
        with pytest.raises(ExecutionError):
            bad()
    with pytest.raises(TypeError):
        engine.run("wcc", "mini", root=1)
    engine.terminate("no-such-job")
    assert engine.delete_graph("mini") and not (tmp_path / "home" / "mini").exists()


def test_sources(spark, tmp_path, text_graph):
    g = files.read_text_graph(spark, *text_graph, directed=True, weighted=False)
    assert {(r.src, r.dst) for r in g.edges.collect()} == {(1, 2), (2, 3)} and not g.weighted
    (tmp_path / "bad.csv").write_text("1 2 x\n")
    with pytest.raises(Exception):
        files.read_edges(spark, str(tmp_path / "bad.csv"), weighted=True).collect()
    with pytest.raises(GraphError):
        files.delete_converted(spark, str(tmp_path / "abc"), "mini")
    assert not files.write_result(g.vertices, "id", None) and not files.write_result(g.vertices, "id", "")


def logs(spark, *lines):
    return spark.createDataFrame([("a", i, x) for i, x in enumerate(lines)], "file string, line_number int, line string")


def test_processing_time(spark):
    rows = logs(spark, f"{M.STARTS}1", "x", f"info {M.STARTS}1000", f"{M.ENDS}2001", f"{M.ENDS}2501")
    assert M.processing_time(rows) == Decimal("1.501")
    with pytest.raises(M.MissingTimesError):
        M.processing_time(logs(spark, f"{M.STARTS}1"))
    with pytest.raises(M.MissingTimesError):
        M.processing_seconds(["nothing"])


def test_trace(spark):
    rows = logs(spark, "TRACE - A:1 B:x[COLON]y[SPACE]z C:1:2 D A:2", "no record")
    record = M.trace_records(rows).first().record
    assert record == {"-": "", "A": "2", "B": "x:y z", "C": "", "D": ""}
    lines = [
        f"TRACE - OperationUuid:{m} MissionType:{m} InfoName:{k} InfoValue:{v}"
        for m, s, e in (("Job", 0, 1000), ("LoadGraph", 0, 300), ("ProcessGraph", 300, 901), ("OffloadGraph", 901, 950))
        for k, v in (("StartTime", s), ("EndTime", e))
    ]
    ops = M.operations(M.trace_records(logs(spark, *lines)))
    assert M.breakdown(ops).first().asDict() == {"processing_ms": 601, "io_ms": 300, "overhead_ms": 99}
    assert M.top_operation(ops).first().duration_ms == 1000
    assert M.enriched({"processing_time": Decimal(9), "unit": "s"}, ops)["processing_time"] == Decimal("0.601")
