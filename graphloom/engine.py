"""Lifecycle: load a graph, run algorithms on it, write results, measure, delete."""

from __future__ import annotations

import logging
import re
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import metrics as M
from .model import Graph
from .operators import algorithms as A
from .sources.files import convert, delete_converted, read_converted, read_text_graph, write_result
from .storage import move, remove, run_folder, shared_dir, written

log = logging.getLogger(__name__)


def _now() -> int:
    return int(time.time() * 1000)


class ExecutionError(RuntimeError):
    """A run that can't be carried out or failed."""


@dataclass(frozen=True)
class Algorithm:
    """What runs, its result column, and its parameters: name to (default, check)."""

    run: Callable[..., DataFrame]
    value: str
    parameters: dict[str, tuple[object, type]] = field(default_factory=dict)


ALGORITHMS = {
    "bfs": Algorithm(A.bfs, "level", {"root": (0, int)}),
    "pr": Algorithm(A.pagerank, "rank", {"damping": (0.85, float), "iterations": (10, int)}),
    "wcc": Algorithm(A.wcc, "component"),
    "cdlp": Algorithm(A.cdlp, "label", {"iterations": (10, int), "isolated": ("own", str)}),
    "lcc": Algorithm(A.lcc, "lcc"),
    "sssp": Algorithm(A.sssp, "distance", {"root": (0, int)}),
}


@dataclass(frozen=True)
class Run:
    """A finished run: the result, its value column and the lines of its log."""

    job_id: str
    algorithm: str
    result: DataFrame
    value: str
    lines: list[str]

    def metrics(self) -> dict[str, object]:
        """Processing time in seconds: that of the log's marks, or of its trace where it has one."""
        spark = self.result.sparkSession
        log = spark.createDataFrame([(x,) for x in self.lines], "line string")
        return M.enriched({"processing_time": M.processing_seconds(self.lines), "unit": "s"}, M.operations(M.trace_records(log)))


    def operations(self) -> DataFrame:
        """The run's operations in the engine's job model; ModelError if they don't fit it."""
        log = self.result.sparkSession.createDataFrame([(x,) for x in self.lines], "line string")
        return M.linked(M.modelled(M.operations(M.trace_records(log)).withColumn("run", F.lit(self.job_id)), by=["run"]))


class Engine:
    """Loads, runs and deletes graphs in one Spark session; converted graphs lie in `home`/<name>."""

    def __init__(self, spark: SparkSession, home: str | None = None, log_file: str | None = None):
        self.spark = spark
        self.home = home or f"{shared_dir(spark)}/graphs"
        self.loaded: dict[str, Graph] = {}
        self._handler: logging.Handler | None = None
        self._log_file = log_file

    name = "graphloom"
    job_model = M.JOB_MODEL

    @classmethod
    def configured(cls, spark: SparkSession, properties: str) -> "Engine":
        """An engine set up by a properties file: home, log-file, num-machines and num-threads (1 each), all under `graphloom.`.

        The product of machines and threads, if either is given, becomes the session's number of shuffle partitions.  A file that can't be
        read, and numbers that are none, abort with ExecutionError.
        """
        try:
            lines = [x.strip() for x in Path(properties).read_text().splitlines()]
            pairs = [re.split(r"\s*[=:]\s*|\s+", x, maxsplit=1) for x in lines if x and x[0] not in "#!"]
            said = {k.removeprefix("graphloom."): (v[0] if v else "") for k, *v in pairs if k.startswith("graphloom.")}
            machines, threads = int(said.get("num-machines", 1)), int(said.get("num-threads", 1))
            if min(machines, threads) < 1:
                raise ValueError("machines and threads are 1 at least")
        except (OSError, ValueError) as e:
            raise ExecutionError(f"the configuration {properties} can't be read: {e}") from e
        if {"num-machines", "num-threads"} & set(said):
            spark.conf.set("spark.sql.shuffle.partitions", machines * threads)
        return cls(spark, said.get("home") or None, said.get("log-file") or None)

    def verify_setup(self) -> None:
        """Raises if the session is gone."""
        self.spark.sql("SELECT 1").collect()

    def startup(self) -> None:
        """From here on, run logs also go to the log file."""
        if self._log_file and not self._handler:
            Path(self._log_file).parent.mkdir(parents=True, exist_ok=True)
            self._handler = logging.FileHandler(self._log_file)
            log.addHandler(self._handler)
            log.setLevel(logging.INFO)

    def load_graph(self, name: str, vertices: str, edges: str, directed: bool = True, weighted: bool = False) -> Graph:
        """Reads text files, checks them (GraphError) and converts them once; later runs read the converted form."""
        return self.add_graph(name, read_text_graph(self.spark, vertices, edges, directed, weighted, name))

    def add_graph(self, name: str, graph: Graph) -> Graph:
        converted = convert(graph, f"{self.home}/{name}")
        try:
            converted.validate()
        except Exception:
            delete_converted(self.spark, f"{self.home}/{name}", name)
            raise
        self.loaded[name] = converted
        return converted

    def delete_graph(self, name: str) -> bool:
        """Deletes the converted form."""
        self.loaded.pop(name, None)
        return delete_converted(self.spark, f"{self.home}/{name}", name)

    def prepare(self, name: str) -> None:
        """Nothing is left to prepare for a loaded graph; an unknown one raises."""
        if name not in self.loaded:
            raise ExecutionError(f"graph {name!r} isn't loaded")

    def run(self, algorithm: str, graph: str | Graph, output: str | None = None, runs: int = 1, job_id: str | None = None, resume: bool = False, **parameters) -> Run:
        """Runs an algorithm to its end; with several runs the time logged is their mean.

        Unknown algorithms raise ExecutionError, unknown parameters TypeError; what goes wrong in a run, its
        cancelling included, is raised as ExecutionError.  The result is written to `output` unless that is empty.
        The log tells begin and end of processing, and traces the job, its loading, processing and writing.

        All that a run writes lies in one folder, which goes when it ends, fails or is cancelled; only the result moves to
        `home`/results/<job_id>.  With `resume` a failed run's folder stays, and a run that is started again under its job_id, by the same
        driver or a new one, goes on from the last superstep that was finished.
        """
        if algorithm not in ALGORITHMS:
            raise ExecutionError(f"unknown algorithm {algorithm!r}")
        spec = ALGORITHMS[algorithm]
        if unknown := set(parameters) - set(spec.parameters):
            raise TypeError(f"{algorithm} takes no {', '.join(sorted(unknown))}")
        values = {k: kind(parameters.get(k, default)) for k, (default, kind) in spec.parameters.items()}
        if isinstance(graph, str):
            self.prepare(graph)
        job_id = job_id or uuid.uuid4().hex
        lines: list[str] = []
        runs = max(1, runs)
        self.spark.sparkContext.setJobGroup(job_id, f"{algorithm} on {graph if isinstance(graph, str) else graph.name}", interruptOnCancel=True)
        try:
            with self._span(lines, job_id, "Job"):
                with self._span(lines, job_id, "LoadGraph"):
                    if isinstance(graph, str):
                        graph = read_converted(self.spark, f"{self.home}/{graph}", self.loaded[graph].directed, graph)
                with run_folder(self.spark, job_id, keep=resume) as folder:
                    with self._span(lines, job_id, "ProcessGraph", runs, (M.STARTS, M.ENDS)):
                        for k in range(runs):
                            with run_folder(self.spark, f"{job_id}/{k}", keep=resume):
                                written(spec.run(graph, **values), f"{folder}/result-{k}")
                    with self._span(lines, job_id, "OffloadGraph"):
                        move(self.spark, f"{folder}/result-{runs - 1}", f"{self.home}/results/{job_id}")
                        result = self.spark.read.parquet(f"{self.home}/results/{job_id}")
                        write_result(result, spec.value, output)
        except Exception as e:
            raise ExecutionError(f"{algorithm} failed: {e}") from e
        finally:
            self.spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return Run(job_id, algorithm, result, spec.value, lines)

    def _say(self, lines: list[str], line: str) -> None:
        lines.append(line)
        log.info(line)

    @contextmanager
    def _span(self, lines: list[str], job_id: str, mission: str, runs: int = 1, marks: tuple[str, str] | None = None) -> Iterator[None]:
        """Trace records, and marks if wanted, of an operation's begin and end, all out of two readings of the clock; of several runs the end is that of one of mean length."""
        start = _now()
        if marks:
            self._say(lines, f"{marks[0]}{start}")
        yield
        end = start + round((_now() - start) / runs)
        if marks:
            self._say(lines, f"{marks[1]}{end}")
        for info, at in (("StartTime", start), ("EndTime", end)):
            self._say(lines, M.trace_text(dict(zip(M.TRACE_FIELDS, (f"{job_id}-{mission}", self.name, "driver", mission, job_id, info, at, at)))))

    def finalize(self, run: Run) -> dict[str, object]:
        """The run's metrics; the log file is closed."""
        if self._handler:
            log.removeHandler(self._handler)
            self._handler.close()
            self._handler = None
        return run.metrics()

    def delete_result(self, run: Run) -> bool:
        """Deletes a run's result."""
        return remove(self.spark, f"{self.home}/results/{run.job_id}")

    def terminate(self, job_id: str) -> None:
        """Cancels a run's jobs; the run then fails and takes its folder with it."""
        self.spark.sparkContext.cancelJobGroup(job_id)
