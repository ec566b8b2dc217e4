"""All graph queries, by name, with their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import metrics as M
from ..functions.formatting import result_lines
from ..model import Graph
from ..operators import algorithms as A
from ..operators import primitives as P
from ..sources.files import convert, read_text_graph, write_result, write_text_graph
from ..storage import new_path, settings, written
from . import oracles
from .fixtures import FIXTURES, graph, root

Query = Callable[[SparkSession, str], DataFrame]


def derived(g: Graph) -> Graph:
    """The graph in its loaded form, on which algorithms run."""
    return convert(g, new_path(g.vertices.sparkSession, "loaded"))


def on(name: str, f: Callable[[Graph], DataFrame]) -> Query:
    return lambda spark, sf_dir: f(graph(spark, sf_dir, name))


def _levels(g: Graph) -> DataFrame:
    return A.bfs(g, root(g)).select("id", F.coalesce("level", F.lit(oracles.UNREACHED)).alias("level"))


def _ranks(g: Graph, **kw) -> DataFrame:
    return A.pagerank(g, **kw).select("id", F.round("rank", 10).alias("rank"))


def _lcc(g: Graph) -> DataFrame:
    return A.lcc(g).select("id", F.round("lcc", 10).alias("lcc"))


def _distances(g: Graph) -> DataFrame:
    return A.sssp(g, root(g)).select("id", F.round("distance", 4).alias("distance"))


#: whole algorithms: name to graph, what runs, oracle
ALGORITHMS: dict[str, tuple[str, Callable[[Graph], DataFrame], str]] = {
    **{f"bfs_{g}": (g, _levels, oracles.bfs(g)) for g in FIXTURES},
    **{f"pr_{g}": (g, _ranks, oracles.pr(g)) for g in FIXTURES},
    "pr_flow_d50_i5": ("flow", lambda g: _ranks(g, damping=0.5, iterations=5), oracles.pr("flow", 0.5, 5)),
    **{f"wcc_{g}": (g, A.wcc, oracles.wcc(g)) for g in FIXTURES},
    **{f"cdlp_{g}": (g, A.cdlp, oracles.cdlp(g)) for g in FIXTURES},
    "cdlp_flow_isolated_first": ("flow", lambda g: A.cdlp(g, isolated="first"), oracles.cdlp("flow", isolated="(SELECT min(id) FROM v)")),
    **{f"lcc_{g}": (g, _lcc, oracles.lcc(g)) for g in FIXTURES},
    **{f"sssp_{g}": (g, _distances, oracles.sssp(g)) for g in FIXTURES},
    "wcc_component_sizes": ("flow", lambda g: A.wcc(g).groupBy("component").agg(F.count("*").alias("size")), oracles.wcc_sizes("flow")),
    "cdlp_label_sizes": ("coorder", lambda g: A.cdlp(g).groupBy("label").agg(F.count("*").alias("size")), oracles.cdlp_sizes("coorder")),
}
QUERIES: dict[str, Query] = {k: on(g, lambda g, f=f: f(derived(g))) for k, (g, f, _) in ALGORITHMS.items()}
ORACLES: dict[str, str] = {k: sql for k, (_, _, sql) in ALGORITHMS.items()}


# --- primitives ---------------------------------------------------------------------------------------


def _first_ranks(g: Graph) -> DataFrame:
    """A rank of 1 / (1 + id) for every vertex, so that sums differ."""
    return P.out_degrees(g).withColumn("rank", 1.0 / (1 + F.col("id")))


def _state(g: Graph) -> DataFrame:
    """A distance of every vertex, so that some edges make it less and some don't."""
    return P.initial_state(g.vertices, "distance", F.col("id") * 10.0)


def _sources(g: Graph) -> DataFrame:
    return P.out_degrees(g).where("degree > 0")


def _labels(g: Graph) -> DataFrame:
    return g.vertices.select("id", F.pmod("id", F.lit(10)).alias("label"))


def _histogram(g: Graph) -> DataFrame:
    return P.label_histogram(_labels(g), P.neighbour_counts(g.edges))


RANKS = "k AS (SELECT v.id, count(e.src) AS degree, 1.0::DOUBLE / (1 + v.id) AS rank FROM v LEFT JOIN e ON e.src = v.id GROUP BY v.id)"
STATE = "s AS (SELECT id, id * 10.0::DOUBLE AS distance FROM v)"
SOURCES = "k AS (SELECT src AS id, count(*) AS degree, min(weight) AS least FROM e GROUP BY src)"
RELAXED = "x AS (SELECT e.dst AS id, min(s.distance + e.weight) AS distance FROM s JOIN e ON e.src = s.id GROUP BY e.dst)"
HISTOGRAM = "h AS (SELECT b.s AS id, b.d % 10 AS label, count(*) AS n FROM (SELECT src AS s, dst AS d FROM e UNION ALL SELECT dst, src FROM e) b GROUP BY 1, 2)"
SETS = "b AS (SELECT src, dst FROM e UNION SELECT dst, src FROM e)"

PARTS = 12  # ranges of edges

PRIMITIVES: dict[str, tuple[str, Callable[[Graph], DataFrame], str, str]] = {
    "graph_stats": ("flow", P.graph_stats, "", "SELECT (SELECT count(*) FROM v) AS vertices, (SELECT count(*) FROM e) AS edges"),
    "out_degree": ("flow", P.out_degrees, "", "SELECT v.id, count(e.src) AS degree FROM v LEFT JOIN e ON e.src = v.id GROUP BY v.id"),
    "in_degree": ("flow", P.in_degrees, "", "SELECT v.id, count(e.dst) AS degree FROM v LEFT JOIN e ON e.dst = v.id GROUP BY v.id"),
    "symmetrize": ("flow", lambda g: P.neighbours(g.edges), "", "SELECT src, dst FROM e UNION ALL SELECT dst, src FROM e"),
    "neighbor_set": ("flow", lambda g: P.neighbour_sets(g.edges), "", "SELECT src, dst FROM e UNION SELECT dst, src FROM e"),
    "frontier_expand": ("flow", lambda g: P.expand_out(g.vertices, g.edges.select("src", "dst")), "", "SELECT src AS id, dst FROM e"),
    "frontier_expand_in": ("flow", lambda g: P.expand_in(g.vertices, g.edges.select("src", "dst")), "", "SELECT dst AS id, src FROM e"),
    "visit_once": (
        "flow",
        lambda g: P.unvisited(P.expand_out(_sources(g).select("id"), g.edges).select(F.col("dst").alias("id")), _sources(g)),
        "",
        "SELECT DISTINCT dst AS id FROM e WHERE dst NOT IN (SELECT src FROM e)",
    ),
    "dangling_sum": ("flow", lambda g: P.dangling_sum(_first_ranks(g)).select(F.round("dangling", 10).alias("dangling")), RANKS, "SELECT round(coalesce(sum(rank), 0), 10) AS dangling FROM k WHERE degree = 0"),
    "pr_scatter": ("flow", lambda g: P.scatter_add(_first_ranks(g), P.shares(g.edges)).select("id", F.round("sum", 10).alias("sum")), RANKS, "SELECT e.dst AS id, round(sum(k.rank / k.degree), 10) AS sum FROM k JOIN e ON e.src = k.id GROUP BY e.dst"),
    "pr_apply": (
        "flow",
        lambda g: P.affine_apply(g.vertices, P.scatter_add(_first_ranks(g), P.shares(g.edges)), 0.85, F.lit(0.15)).select("id", F.round("rank", 10).alias("rank")),
        RANKS,
        "SELECT v.id, round(0.15 + 0.85 * coalesce(x.s, 0), 10) AS rank FROM v LEFT JOIN (SELECT e.dst AS id, sum(k.rank / k.degree) AS s FROM k JOIN e ON e.src = k.id GROUP BY e.dst) x ON x.id = v.id",
    ),
    "label_histogram": ("flow", _histogram, HISTOGRAM, "SELECT * FROM h"),
    "label_argmax": ("flow", lambda g: P.most_frequent(_histogram(g)), HISTOGRAM, "SELECT id, label FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, label) AS rn FROM h) WHERE rn = 1"),
    "histogram_changes": (
        "flow",
        lambda g: P.histogram_changes(P.most_frequent(_histogram(g)).join(_labels(g).withColumnRenamed("label", "old"), "id").where("old <> label"), P.neighbour_counts(g.edges)),
        HISTOGRAM + """, l AS (SELECT v.id, v.id % 10 AS old, coalesce(x.label, v.id % 10) AS label FROM v LEFT JOIN (SELECT id, label FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, label) AS rn FROM h) WHERE rn = 1) x USING (id)),
        b AS (SELECT src AS s, dst AS d FROM e UNION ALL SELECT dst, src FROM e)""",
        """SELECT id, label, sum(n)::BIGINT AS n FROM (SELECT b.s AS id, l.label, count(*) AS n FROM b JOIN l ON l.id = b.d GROUP BY 1, 2 UNION ALL SELECT b.s, l.old, -count(*) FROM b JOIN l ON l.id = b.d GROUP BY 1, 2)
        GROUP BY id, label HAVING sum(n) <> 0""",
    ),
    "min_label_push": ("flow", lambda g: P.scatter_min(P.initial_state(g.vertices, "component", F.col("id")), g.edges, "component"), "", "SELECT dst AS id, min(src) AS component FROM e GROUP BY dst"),
    "relax_step": ("flow", lambda g: P.relax(_state(g), g.edges).select("id", F.round("distance", 4).alias("distance")), f"{STATE}, {RELAXED}", "SELECT id, round(distance, 4) AS distance FROM x"),
    "activate_improved": (
        "flow",
        lambda g: P.improved(P.relax(_state(g), g.edges), _state(g), "distance").select("id", F.round("distance", 4).alias("distance")),
        f"{STATE}, {RELAXED}",
        "SELECT x.id, round(x.distance, 4) AS distance FROM x LEFT JOIN s ON s.id = x.id WHERE x.distance < s.distance",
    ),
    "intersect_count": (
        "coorder",
        lambda g: P.intersection_sizes(P.neighbour_sets(g.edges), g.edges.where("src < dst").select(F.col("src").alias("a"), F.col("dst").alias("b")).distinct()),
        SETS,
        "SELECT p.src AS a, p.dst AS b, count(*) AS n FROM (SELECT DISTINCT src, dst FROM e WHERE src < dst) p JOIN b x ON x.src = p.src JOIN b y ON y.src = p.dst AND y.dst = x.dst GROUP BY 1, 2",
    ),
    "edge_bounds": (
        "flow",
        lambda g: P.edge_bounds(g.edges, PARTS),
        "",
        f"""SELECT p.part, r.src AS id, r.pos - r.low AS skip FROM (SELECT unnest(range({PARTS})) AS part) p, (SELECT count(*) AS n FROM e) t
        JOIN (SELECT src, pos, min(pos) OVER (PARTITION BY src) AS low FROM (SELECT src, row_number() OVER (ORDER BY src) - 1 AS pos FROM e)) r ON r.pos = (p.part * t.n + {PARTS} - 1) // {PARTS}""",
    ),
    "degree_prefix": (
        "coorder",
        lambda g: P.edge_positions(g.edges)[0].select("id", "degree", "before"),
        "",
        "SELECT src AS id, degree, (sum(degree) OVER (ORDER BY src) - degree)::BIGINT AS before FROM (SELECT src, count(*) AS degree FROM e GROUP BY src)",
    ),
    "guarded_ratio": (
        "flow",
        lambda g: P.out_degrees(g).select("id", F.round(P.guarded_ratio(F.col("degree") + 1, F.col("degree")), 10).alias("ratio")),
        "",
        "SELECT v.id, round(CASE WHEN count(e.src) >= 2 THEN (count(e.src) + 1)::DOUBLE / (count(e.src) * (count(e.src) - 1)) ELSE 0.0 END, 10) AS ratio FROM v LEFT JOIN e ON e.src = v.id GROUP BY v.id",
    ),
    "init_state": ("flow", lambda g: P.initial_state(g.vertices, "component", F.col("id")), "", "SELECT id, id AS component FROM v"),
    "root_lookup": ("flow", lambda g: P.require_vertex(g.vertices, root(g)), "", "SELECT min(src) AS id FROM e"),
    "unreachable_default": ("flow", lambda g: P.with_default(g.vertices, _sources(g), "degree", F.lit(-1)), SOURCES, "SELECT v.id, coalesce(k.degree, -1)::BIGINT AS degree FROM v LEFT JOIN k ON k.id = v.id"),
    "edge_weights": ("flow", lambda g: g.edges.select("src", "dst", F.round("weight", 4).alias("weight")), "", "SELECT src, dst, round(weight, 4) AS weight FROM e"),
    "edges_undirected": ("coorder", lambda g: g.edges.select("src", "dst"), "", "SELECT src, dst FROM e"),
}

# --- text forms -----------------------------------------------------------------------------------------

FORMS: dict[str, tuple[str, Callable[[Graph], DataFrame], str, str]] = {
    "fmt_bfs": (
        "flow",
        lambda g: result_lines(P.with_default(g.vertices, _sources(g).withColumnRenamed("degree", "level"), "level", F.lit(None).cast("long")), "level"),
        SOURCES,
        f"SELECT v.id, v.id || ' ' || coalesce(k.degree, {oracles.UNREACHED}) AS line FROM v LEFT JOIN k ON k.id = v.id",
    ),
    "fmt_sssp": (
        "flow",
        lambda g: result_lines(P.with_default(g.vertices, g.edges.groupBy(F.col("src").alias("id")).agg(F.min("weight").alias("distance")), "distance", F.lit(None).cast("double")), "distance"),
        SOURCES,
        "SELECT v.id, v.id || ' ' || CASE WHEN k.id IS NULL THEN 'infinity' ELSE format('{:.15e}', k.least::DOUBLE) END AS line FROM v LEFT JOIN k ON k.id = v.id",
    ),
    "fmt_scientific": ("flow", lambda g: result_lines(g.vertices.select("id", (F.col("id") / 64.0).alias("rank")), "rank"), "", "SELECT id, id || ' ' || format('{:.15e}', id / 64.0::DOUBLE) AS line FROM v"),
    "result_lines": ("flow", lambda g: result_lines(A.wcc(g), "component"), "", ""),
}


def _reread(g: Graph) -> Graph:
    """The graph written as text files and read back."""
    path = new_path(g.vertices.sparkSession, "text")
    return read_text_graph(g.vertices.sparkSession, *write_text_graph(g, path), weighted=True)


def _converted(g: Graph) -> Graph:
    return convert(g, new_path(g.vertices.sparkSession, "converted"))


def _written_lines(g: Graph) -> DataFrame:
    """Result lines as a text sink holds them."""
    spark, path = g.vertices.sparkSession, new_path(g.vertices.sparkSession, "lines")
    write_result(P.out_degrees(g).withColumnRenamed("degree", "label"), "label", path)
    return spark.read.text(path).withColumnRenamed("value", "line")


_EDGES = "SELECT src, dst, weight::DOUBLE AS weight FROM e"
SOURCES_AND_SINKS: dict[str, tuple[str, Callable[[Graph], DataFrame], str, str]] = {
    "text_vertices": ("users", lambda g: _reread(g).vertices, "", "SELECT id FROM v"),
    "text_edges": ("flow", lambda g: _reread(g).edges, "", _EDGES),
    "text_edges_undirected": ("coorder", lambda g: _reread(g).edges, "", _EDGES),
    "converted_scan": ("flow", lambda g: _converted(g).edges, "", _EDGES),
    "converted_adjacency": (
        "flow",
        lambda g: _converted(g).adjacency.rows.select("id", "other", "forth", "back", "weight", F.round("share", 10).alias("share")),
        """x AS (SELECT src AS id, dst AS other, count(*) AS forth, 0 AS back, min(weight) AS weight FROM e GROUP BY 1, 2 UNION ALL SELECT dst, src, 0, count(*), NULL FROM e GROUP BY 1, 2 UNION ALL SELECT id, NULL, 0, 0, NULL FROM v),
        k AS (SELECT src, count(*) AS degree FROM e GROUP BY src)""",
        """SELECT id, other, sum(forth)::BIGINT AS forth, sum(back)::BIGINT AS back, min(weight)::DOUBLE AS weight, round(CASE WHEN sum(forth) > 0 THEN sum(forth)::DOUBLE / any_value(k.degree) END, 10) AS share
        FROM x LEFT JOIN k ON k.src = x.id GROUP BY id, other""",
    ),
    "written_lines": ("flow", _written_lines, "", "SELECT v.id || ' ' || count(e.src) AS line FROM v LEFT JOIN e ON e.src = v.id GROUP BY v.id"),
}
for _name, (_g, _f, _more, _select) in {**PRIMITIVES, **FORMS, **SOURCES_AND_SINKS}.items():
    QUERIES[_name] = on(_g, _f)
    ORACLES[_name] = oracles.over(_g, _select, _more) if _select else oracles._wcc(_g) + " SELECT id, id || ' ' || component AS line FROM result"


# --- logs and traces ---------------------------------------------------------------------------------


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per user: begin and end out of its events' times."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", F.expr("timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").alias("ms"))
    return events.groupBy(F.col("user_id").alias("run")).agg(F.min("ms").alias("t0"), F.max("ms").alias("t3"), F.count("*").alias("n"))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of the runs, with a stale begin that a later one replaces."""
    lines = F.array(
        F.lit("loading"),
        F.concat(F.lit(f"INFO {M.STARTS}"), F.col("t0") - 5000),
        F.concat(F.lit(M.STARTS), F.col("t0")),
        F.concat(F.lit(M.ENDS), F.col("t3")),
        F.lit("done"),
    )
    return _runs(spark, sf_dir).select("run", F.lit("run.log").alias("file"), F.posexplode(lines).alias("line_number", "line"))


def _trace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trace lines of the runs: job, load, process and offload with begin and end."""
    n = F.col("n")
    spans = [("Job", F.col("t0"), F.col("t3") + 100), ("LoadGraph", F.col("t0"), F.col("t0") + n), ("ProcessGraph", F.col("t0") + n, F.col("t0") + 3 * n), ("OffloadGraph", F.col("t3"), F.col("t3") + 50)]
    rows = []
    for mission, start, end in spans:
        for info, value in (("StartTime", start), ("EndTime", end)):
            rows.append(
                M.trace_line(
                    {
                        "OperationUuid": F.concat(F.col("run"), F.lit(f"-{mission}")), "ActorType": F.lit("Graph Engine"), "ActorId": F.concat(F.lit("host:"), F.col("run")), "MissionType": F.lit(mission),
                        "MissionId": F.col("run"), "InfoName": F.lit(info), "InfoValue": value, "Timestamp": value,
                    }
                )
            )
    return _runs(spark, sf_dir).select("run", F.explode(F.array(F.lit("noise"), *rows)).alias("line"))


def _processing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.processing_times(_log(spark, sf_dir), ["run"]).select("run", F.col("processing_time").cast("double").alias("processing_time"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = M.trace_records(_trace(spark, sf_dir))
    return r.select("run", *[F.col("record")[k].alias(a) for k, a in (("MissionType", "mission"), ("ActorType", "actor_type"), ("ActorId", "actor"), ("InfoName", "info"), ("InfoValue", "value"))])


def _durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.operations(M.trace_records(_trace(spark, sf_dir))).select("operation", "mission", "parent", "duration_ms")


def _breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.breakdown(M.operations(M.trace_records(_trace(spark, sf_dir))))


def _top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.top_operation(M.operations(M.trace_records(_trace(spark, sf_dir))))


#: a model of four levels: times of Run and Job come from below, those of ProcessGraph but for its end are logged
MODEL = (
    M.Mission("Run", derived=("start", "end"), filled=True),
    M.Mission("Job", "Run", derived=("start", "end")),
    M.Mission("LoadGraph", "Job"),
    M.Mission("ProcessGraph", "Job", derived=("end",)),
    M.Mission("OffloadGraph", "Job"),
    M.Mission("Compute", "ProcessGraph"),
)


def _modelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operations in the model: a Compute in each ProcessGraph, no OffloadGraph where the run has an even number of events, two Jobs where it is divisible by 7."""
    runs = _runs(spark, sf_dir).withColumn("times", F.when(F.col("n") % 7 == 0, 2).otherwise(1))
    spans = [("Job", F.col("t0") - 9, F.col("t3") + 100), ("LoadGraph", F.col("t0"), F.col("t0") + F.col("n")), ("ProcessGraph", F.col("t0") + F.col("n"), F.col("t0") + 3 * F.col("n")), ("OffloadGraph", F.col("t3"), F.col("t3") + 50)]
    spans.append(("Compute", F.col("t0") + F.col("n") + 1, F.col("t0") + 5 * F.col("n")))
    rows = F.array(*[F.struct(F.lit(m).alias("mission"), a.alias("start_ms"), b.alias("end_ms")) for m, a, b in spans])
    ops = runs.select("run", "n", "times", F.inline(rows)).where("mission <> 'OffloadGraph' or n % 2 = 1")
    ops = ops.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("mission") == "Job", F.col("times")).otherwise(1)))).withColumn("operation", F.concat_ws("-", "run", "mission", "copy"))
    return M.modelled(ops, MODEL, ["run"]).drop("parent")


def _log_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processing times out of log files that were written as text and are read in parts of a few kilobytes."""
    path = new_path(spark, "logs")
    lines = F.array(*[F.concat(F.lit("run "), F.col("run"), F.lit(" "), x) for x in (F.lit("loading"), F.concat(F.lit(M.STARTS), F.col("t0") - 5000), F.concat(F.lit(M.STARTS), F.col("t0")), F.concat(F.lit(M.ENDS), F.col("t3")))])
    _runs(spark, sf_dir).select(F.explode(lines).alias("value")).write.text(path)
    with settings(spark, {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "64"}):
        found = M.processing_times(M.read_logs(spark, path).withColumn("run", F.split("line", " ")[1].cast("long")), ["run"])
        return written(found.select("run", F.col("processing_time").cast("double").alias("processing_time")), new_path(spark, "times"))[0]


_T = f"WITH r AS ({oracles.LOG_TIMES}), o AS (SELECT run, t0, t3, n, unnest(['Job', 'LoadGraph', 'ProcessGraph', 'OffloadGraph']) AS mission FROM r), "
_T += """s AS (SELECT *, CASE mission WHEN 'ProcessGraph' THEN t0 + n WHEN 'OffloadGraph' THEN t3 ELSE t0 END AS a,
 CASE mission WHEN 'Job' THEN t3 + 100 WHEN 'LoadGraph' THEN t0 + n WHEN 'ProcessGraph' THEN t0 + 3 * n ELSE t3 + 50 END AS b FROM o) """
QUERIES |= {"processing_time": _processing, "trace_parse": _records, "trace_durations": _durations, "trace_breakdown": _breakdown, "trace_top": _top, "trace_model": _modelled, "log_files": _log_files}
ORACLES |= {
    "log_files": f"SELECT run, round((t3 - t0) / 1000.0, 3)::DOUBLE AS processing_time FROM ({oracles.LOG_TIMES})",
    "trace_model": f"""WITH r AS ({oracles.LOG_TIMES}), j AS (SELECT *, t0 + 5 * n AS done, CASE WHEN n % 2 = 1 THEN greatest(t0 + 5 * n, t3 + 50) ELSE t0 + 5 * n END AS last, CASE WHEN n % 7 = 0 THEN 2 ELSE 1 END AS jobs FROM r),
    o AS (SELECT run, run || '-Run' AS operation, 'Run' AS mission, 0 AS level, NULL::BIGINT AS parents, CASE WHEN jobs = 1 THEN t0 ELSE t0 - 9 END AS a, CASE WHEN jobs = 1 THEN last ELSE t3 + 100 END AS b FROM j
    UNION ALL SELECT run, run || '-Job-' || c, 'Job', 1, 1, CASE WHEN jobs = 1 THEN t0 ELSE t0 - 9 END, CASE WHEN jobs = 1 THEN last ELSE t3 + 100 END FROM (SELECT *, unnest(range(1, jobs + 1)) AS c FROM j)
    UNION ALL SELECT run, run || '-LoadGraph-1', 'LoadGraph', 2, jobs, t0, t0 + n FROM j UNION ALL SELECT run, run || '-ProcessGraph-1', 'ProcessGraph', 2, jobs, t0 + n, done FROM j
    UNION ALL SELECT run, run || '-OffloadGraph-1', 'OffloadGraph', 2, jobs, t3, t3 + 50 FROM j WHERE n % 2 = 1 UNION ALL SELECT run, run || '-Compute-1', 'Compute', 3, 1, t0 + n + 1, done FROM j)
    SELECT run, operation, mission, level::INT AS level, parents, a::BIGINT AS start_ms, b::BIGINT AS end_ms, (b - a)::BIGINT AS duration_ms FROM o""",
    "processing_time": f"SELECT run, round((t3 - t0) / 1000.0, 3)::DOUBLE AS processing_time FROM ({oracles.LOG_TIMES})",
    "trace_parse": _T + "SELECT run, mission, 'Graph Engine' AS actor_type, 'host:' || run AS actor, info, (CASE info WHEN 'StartTime' THEN a ELSE b END)::VARCHAR AS value FROM s, (SELECT unnest(['StartTime', 'EndTime']) AS info)",
    "trace_durations": _T + "SELECT run || '-' || mission AS operation, mission, CASE mission WHEN 'Job' THEN 'TopActor' ELSE 'Job' END AS parent, (b - a)::BIGINT AS duration_ms FROM s",
    "trace_breakdown": _T + "SELECT sum(b - a) FILTER (mission = 'ProcessGraph')::BIGINT AS processing_ms, sum(b - a) FILTER (mission = 'LoadGraph')::BIGINT AS io_ms, (2 * sum(b - a) FILTER (mission = 'Job') - sum(b - a) FILTER (mission <> 'OffloadGraph'))::BIGINT AS overhead_ms FROM s",
    "trace_top": _T + "SELECT min(a)::BIGINT AS start_ms, max(b)::BIGINT AS end_ms, (max(b) - min(a))::BIGINT AS duration_ms FROM s",
}
