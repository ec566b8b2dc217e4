"""Processing times and trace records out of log lines."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# How runs mark begin and end in their logs.
STARTS, ENDS = "Processing starts at: ", "Processing ends at: "
MARKER = "TRACE"
TRACE_FIELDS = ("OperationUuid", "ActorType", "ActorId", "MissionType", "MissionId", "InfoName", "InfoValue", "Timestamp")


class MissingTimesError(ValueError):
    """A log without a begin or an end."""


class ModelError(ValueError):
    """A hierarchy of operations that can't be one, or operations that don't fit it."""


@dataclass(frozen=True)
class Mission:
    """A kind of operation in a job model: its parent, which of its times come from its children, and whether a run that logs none gets one."""

    name: str
    parent: str | None = None
    derived: tuple[str, ...] = ()  # of "start" and "end"
    filled: bool = False


#: what a run of the engine consists of
JOB_MODEL = (
    Mission("TopActor", derived=("start", "end"), filled=True),
    Mission("Job", "TopActor"),
    Mission("LoadGraph", "Job"),
    Mission("ProcessGraph", "Job"),
    Mission("OffloadGraph", "Job"),
)
PARENTS = {m.name: m.parent for m in JOB_MODEL if m.parent}


def levels(model: tuple[Mission, ...]) -> dict[str, int]:
    """Each mission's distance from its root; ModelError for repeated names, unknown parents and circles."""
    parents = {m.name: m.parent for m in model}
    if len(parents) < len(model):
        raise ModelError("a mission is declared twice")
    out = {}
    for name in parents:
        way = [name]
        while (up := parents[way[-1]]) is not None:
            if up not in parents or up in way:
                raise ModelError(f"{way[-1]} has no parent {up!r} above it")
            way.append(up)
        out[name] = len(way) - 1
    return out


def processing_seconds(lines: list[str]) -> Decimal:
    """Seconds from the last begin to the last end in a run's own lines, three decimals, rounded up."""
    found = {}
    for line in lines:
        for mark in (STARTS, ENDS):
            if mark in line:
                found[mark] = int(line.split()[-1])
    if len(found) < 2:
        raise MissingTimesError("the log lacks a begin or an end")
    return (Decimal(found[ENDS] - found[STARTS]) / 1000).quantize(Decimal("0.001"), ROUND_CEILING)


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_number, line) of all files under a path, in parts, so that several tasks share a large file.

    Lines of a part keep their order; their numbers come from the parts before, of which there is one row each.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("part"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    parts = lines.groupBy("file", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("part")) - F.col("n")
    parts = parts.select("file", "part", (before - F.col("first") + 1).alias("shift"))
    return lines.join(parts, ["file", "part"]).select("file", (F.col("at") + F.col("shift")).alias("line_number"), "line")


def processing_times(logs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """processing_time as decimal(18,3) seconds, of all lines or by columns; the last mark in (file, line_number) order counts.

    Where a begin or an end is missing the time is null; see processing_time for the check.
    """
    last = F.element_at(F.split(F.rtrim("line"), r"\s+"), -1).cast("long")
    mark = F.struct("file", "line_number")
    both = logs.where(F.col("line").contains(STARTS) | F.col("line").contains(ENDS))
    begin, end = (F.max_by(F.when(F.col("line").contains(m), last), F.when(F.col("line").contains(m), mark)) for m in (STARTS, ENDS))
    times = both.groupBy(*(by or [])).agg(begin.alias("start_ms"), end.alias("end_ms"))
    return times.withColumn("processing_time", ((F.col("end_ms") - F.col("start_ms")).cast("decimal(18,0)") / 1000).cast("decimal(18,3)"))


def processing_time(logs: DataFrame) -> Decimal:
    """The processing time of one run's logs; MissingTimesError if there is none."""
    row = processing_times(logs).first()
    if row is None or row.processing_time is None:
        raise MissingTimesError("the logs lack a begin or an end")
    return row.processing_time


def _escaped(x: Column) -> Column:
    return F.replace(F.replace(x, F.lit(":"), F.lit("[COLON]")), F.lit(" "), F.lit("[SPACE]"))


def trace_line(values: dict[str, Column], marker: str = MARKER) -> Column:
    """`<marker> - Name:Value ...` with colons and spaces of values written as [COLON] and [SPACE]."""
    parts = [F.concat(F.lit(f"{k}:"), _escaped(values[k].cast("string"))) for k in TRACE_FIELDS]
    return F.concat_ws(" ", F.lit(f"{marker} -"), *parts)


def trace_text(values: dict[str, object], marker: str = MARKER) -> str:
    """The line that trace_line writes, of plain values."""
    return " ".join([f"{marker} -", *(f"{k}:{str(values[k]).replace(':', '[COLON]').replace(' ', '[SPACE]')}" for k in TRACE_FIELDS)])


def trace_lines(logs: DataFrame, marker: str = MARKER) -> DataFrame:
    return logs.where(F.col("line").contains(marker))


def trace_records(logs: DataFrame, marker: str = MARKER) -> DataFrame:
    """Trace lines with record: map of names to values.

    What follows the marker is split at white space, each part at colons; a part of other than two
    pieces has the value ''.  Of a repeated name the last value counts.
    """
    text = F.substring_index("line", f"{marker} ", -1)
    parts = F.filter(F.split(F.trim(text), r"\s+"), lambda p: p != "")
    plain = lambda x: F.replace(F.replace(x, F.lit("[COLON]"), F.lit(":")), F.lit("[SPACE]"), F.lit(" "))

    def pair(p: Column) -> Column:
        pieces = F.split(p, ":")
        return F.struct(plain(pieces[0]).alias("key"), F.when(F.size(pieces) == 2, plain(pieces[1])).otherwise("").alias("value"))

    def merge(pairs: Column) -> Column:
        last = F.transform(pairs, lambda p, i: F.struct(p["key"].alias("key"), p["value"].alias("value"), i.alias("i")))
        return F.map_from_entries(F.transform(F.filter(last, lambda p: ~F.exists(last, lambda q: (q["key"] == p["key"]) & (q["i"] > p["i"]))), lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value"))))

    return trace_lines(logs, marker).withColumn("record", merge(F.transform(parts, pair)))


def operations(records: DataFrame) -> DataFrame:
    """(operation, mission, parent, start_ms, end_ms, duration_ms) from records of StartTime and EndTime."""
    field = lambda k: F.col("record")[k]
    value = field("InfoValue").cast("long")
    times = records.groupBy(field("OperationUuid").alias("operation"), field("MissionType").alias("mission")).agg(
        F.max(F.when(field("InfoName") == "StartTime", value)).alias("start_ms"), F.max(F.when(field("InfoName") == "EndTime", value)).alias("end_ms")
    )
    parents = F.create_map(*[F.lit(x) for kv in PARENTS.items() for x in kv])
    return times.withColumn("parent", F.try_element_at(parents, "mission")).withColumn("duration_ms", F.col("end_ms") - F.col("start_ms"))


def modelled(ops: DataFrame, model: tuple[Mission, ...] = JOB_MODEL, by: list[str] | None = None) -> DataFrame:
    """Operations (by..., operation, mission, start_ms, end_ms) in the hierarchy that a model declares, of any depth.

    Adds parent and level of the mission, parents (how many operations of the parent mission the run has; a link is good if that is one)
    and duration_ms.  Missions that the model doesn't know are left out; `filled` ones that a run lacks are added, named <run>-<mission>.  Derived
    times are those of the linked children, first start and last end, from the lowest level up; without such children
    they stay as logged.  by: the columns that tell runs apart.
    """
    by = by or []
    depth = levels(model)
    spark = ops.sparkSession
    dim = spark.createDataFrame([(m.name, m.parent, depth[m.name], "start" in m.derived, "end" in m.derived) for m in model], "mission string, parent string, level int, _start boolean, _end boolean")
    rows = ops.select(*by, "operation", "mission", "start_ms", "end_ms")
    none = F.lit(None).cast("long")
    for m in model:
        if m.filled:
            lacks = rows.groupBy(*by).agg(F.max((F.col("mission") == m.name).cast("int")).alias("_has")).where("_has = 0")
            rows = rows.unionAll(lacks.select(*by, F.concat_ws("-", *by, F.lit(m.name)), F.lit(m.name), none, none))
    rows = rows.join(F.broadcast(dim), "mission").withColumn("parents", F.lit(None).cast("long"))  # a row per declared mission
    for upper in range(max(depth.values()) - 1, -1, -1):
        above, below = F.col("level") == upper, F.col("level") == upper + 1
        family = F.when(above, F.concat(F.lit("of "), "mission")).when(below, F.concat(F.lit("of "), "parent")).otherwise(F.concat(F.lit("own "), "operation"))
        w = Window.partitionBy(*by, "_family")
        rows = rows.withColumn("_family", family).withColumns(
            {"_n": F.sum(above.cast("long")).over(w), "_first": F.min(F.when(below, F.col("start_ms"))).over(w), "_last": F.max(F.when(below, F.col("end_ms"))).over(w)}
        )
        good = above & (F.col("_n") == 1)
        rows = rows.withColumns(
            {
                "parents": F.when(below, F.col("_n")).otherwise(F.col("parents")),
                "start_ms": F.when(good & F.col("_start"), F.coalesce("_first", "start_ms")).otherwise(F.col("start_ms")),
                "end_ms": F.when(good & F.col("_end"), F.coalesce("_last", "end_ms")).otherwise(F.col("end_ms")),
            }
        ).drop("_family", "_n", "_first", "_last")
    return rows.select(*by, "operation", "mission", "parent", "level", "parents", "start_ms", "end_ms", (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"))


def linked(ops: DataFrame) -> DataFrame:
    """Operations of `modelled` as they are; ModelError if one has no parent or several."""
    bad = ops.where("parent is not null and parents <> 1").select("mission", "parent", "parents").first()
    if bad:
        raise ModelError(f"{bad.mission} has {bad.parents} operations {bad.parent} above it")
    return ops


def top_operation(ops: DataFrame) -> DataFrame:
    """One row: the whole run, from its children's first start to their last end."""
    return ops.where("parent is not null").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms")).withColumn("duration_ms", F.col("end_ms") - F.col("start_ms"))


def breakdown(ops: DataFrame) -> DataFrame:
    """One row of milliseconds: processing_ms, io_ms (loading) and overhead_ms, the rest of the job."""
    total = lambda m: F.coalesce(F.sum(F.when(F.col("mission") == m, F.col("duration_ms"))), F.lit(0))
    sums = ops.agg(total("Job").alias("job"), total("LoadGraph").alias("io_ms"), total("ProcessGraph").alias("processing_ms"))
    return sums.select("processing_ms", "io_ms", (F.col("job") - F.col("io_ms") - F.col("processing_ms")).alias("overhead_ms"))


def enriched(metrics: dict[str, object], ops: DataFrame) -> dict[str, object]:
    """metrics with the traced processing time, where the trace has one."""
    row = ops.where("mission = 'ProcessGraph'").agg(F.max("duration_ms")).first()
    if row[0] is None:
        return metrics
    return {**metrics, "processing_time": (Decimal(row[0]) / 1000).quantize(Decimal("0.001"), ROUND_CEILING)}
