"""Job models, log files in parts, one clock, configuration."""

import itertools

import pytest

from graphloom import engine as engine_module
from graphloom.engine import Engine, ExecutionError
from graphloom.functions import metrics as M
from graphloom.storage import settings

from .test_golden import make

OPS = "run string, operation string, mission string, start_ms long, end_ms long"
DEEP = (
    M.Mission("A", derived=("start", "end"), filled=True),
    M.Mission("B", "A", derived=("start", "end")),
    M.Mission("C", "B", derived=("end",)),
    M.Mission("D", "C", derived=("start",)),
    M.Mission("E", "D"),
)


def test_levels():
    assert M.levels(DEEP) == {"A": 0, "B": 1, "C": 2, "D": 3, "E": 4}
    assert M.levels(M.JOB_MODEL)["ProcessGraph"] == 2 and M.PARENTS["OffloadGraph"] == "Job"
    for bad in ((M.Mission("A"), M.Mission("A")), (M.Mission("A", "X"),), (M.Mission("A", "B"), M.Mission("B", "A"))):
        with pytest.raises(M.ModelError):
            M.levels(bad)


def test_derived_times(spark):
    rows = [("r", "b", "B", 900, 900), ("r", "c", "C", 10, 11), ("r", "d", "D", 500, 40), ("r", "e1", "E", 20, 30), ("r", "e2", "E", 15, 35), ("r", "x", "Unknown", 0, 9999)]
    rows += [("s", "b1", "B", 5, 6), ("s", "b2", "B", 7, 8), ("s", "c", "C", 1, 2)]  # two parents of one child, no D
    rows += [("t", "a", "A", 3, 4), ("t", "e", "E", 1, 2)]  # own times stay without linked children
    got = {(r.run, r.operation): (r.level, r.parents, r.start_ms, r.end_ms, r.duration_ms) for r in M.modelled(spark.createDataFrame(rows, OPS), DEEP, ["run"]).collect()}
    assert got == {
        ("r", "r-A"): (0, None, 10, 40, 30), ("r", "b"): (1, 1, 10, 40, 30), ("r", "c"): (2, 1, 10, 40, 30), ("r", "d"): (3, 1, 15, 40, 25), ("r", "e1"): (4, 1, 20, 30, 10), ("r", "e2"): (4, 1, 15, 35, 20),
        ("s", "s-A"): (0, None, 5, 8, 3), ("s", "b1"): (1, 1, 5, 6, 1), ("s", "b2"): (1, 1, 7, 8, 1), ("s", "c"): (2, 2, 1, 2, 1),
        ("t", "a"): (0, None, 3, 4, 1), ("t", "e"): (4, 0, 1, 2, 1),
    }
    ops = M.modelled(spark.createDataFrame(rows[:6], OPS), DEEP, ["run"])
    assert M.linked(ops).count() == 6
    with pytest.raises(M.ModelError, match="C has 2 operations B"):
        M.linked(M.modelled(spark.createDataFrame(rows[6:9], OPS), DEEP, ["run"]))
    assert not M.modelled(spark.createDataFrame([], OPS), DEEP, ["run"]).collect()


def test_one_file_by_several_tasks(spark, tmp_path):
    lines = [f"line {i} " + "é" * (i % 50) for i in range(3000)]
    lines[7], lines[1500], lines[1501], lines[2999], lines[8] = f"{M.STARTS}5", f"{M.STARTS}1000", "", f"{M.ENDS}2500", f"{M.ENDS}1"
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.log").write_bytes("\r\n".join(lines).encode())
    (tmp_path / "sub" / "b.log").write_text("other\n")
    (tmp_path / "empty.log").write_text("")
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "8000", "spark.sql.files.openCostInBytes": "1"}):
        logs = M.read_logs(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path / "a.log")).rdd.getNumPartitions() > 5
        got = sorted((r.file.rsplit("/", 1)[1], r.line_number, r.line) for r in logs.collect())
        assert got == [*(("a.log", i, x) for i, x in enumerate(lines, 1)), ("b.log", 1, "other")]
        assert str(M.processing_time(logs)) == "1.500"


def test_log_and_trace_tell_one_time(spark, tmp_path, monkeypatch):
    """However the clock moves between two readings, the log's marks and the trace agree."""
    ticks = itertools.accumulate(itertools.cycle([3, 1, 8, 2, 13]), initial=1000)
    monkeypatch.setattr(engine_module, "_now", lambda: next(ticks))
    engine = Engine(spark, str(tmp_path / "home"))
    for runs in (1, 3):
        run = engine.run("wcc", make(spark, [(1, 2, 1.0)], [1, 2]), runs=runs)
        ops = {r.mission: r for r in run.operations().collect()}
        assert M.processing_seconds(run.lines) * 1000 == ops["ProcessGraph"].duration_ms == run.metrics()["processing_time"] * 1000
        assert (ops["TopActor"].start_ms, ops["TopActor"].end_ms) == (ops["Job"].start_ms, ops["Job"].end_ms) and ops["OffloadGraph"].parents == 1


def test_configuration(spark, tmp_path):
    was = spark.conf.get("spark.sql.shuffle.partitions")
    file = tmp_path / "graph.properties"
    try:
        file.write_text(f"# settings\n! more\n\ngraphloom.home = {tmp_path}/home\ngraphloom.num-machines: 2\ngraphloom.num-threads 3\nother.home = /x\n")
        engine = Engine.configured(spark, str(file))
        assert engine.home == f"{tmp_path}/home" and spark.conf.get("spark.sql.shuffle.partitions") == "6"
        spark.conf.set("spark.sql.shuffle.partitions", was)
        file.write_text("")
        assert Engine.configured(spark, str(file)).home.endswith("/graphs") and spark.conf.get("spark.sql.shuffle.partitions") == was
        for text in ("graphloom.num-threads=many", "graphloom.num-machines=0"):
            file.write_text(text)
            with pytest.raises(ExecutionError):
                Engine.configured(spark, str(file))
        with pytest.raises(ExecutionError):
            Engine.configured(spark, str(tmp_path / "none.properties"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
