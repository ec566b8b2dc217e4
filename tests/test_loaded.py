"""The loaded form, edge-balanced parts, triangles by lists, resumed and cleaned-up runs."""

import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphloom.engine import Engine, ExecutionError
from graphloom.operators import algorithms as A
from graphloom.operators import iterate
from graphloom.operators import primitives as P
from graphloom.sources.files import adjacency_rows, convert, delete_converted, read_converted

from graphloom.storage import run_folder, settings

from .test_golden import DIRECTED, GOLDEN, IDS, UNDIRECTED, make, parsed, values

ALGORITHMS = {"bfs": ("level", lambda g: A.bfs(g, 10)), "sssp": ("distance", lambda g: A.sssp(g, 10)), "wcc": ("component", A.wcc), "cdlp": ("label", A.cdlp), "lcc": ("lcc", A.lcc), "pr": ("rank", A.pagerank)}


def power_law(seed=7, n=600, m=6000):
    """Some vertices with very many edges, parallel edges, loops, vertices without edges."""
    r = random.Random(seed)
    pick = lambda: int(n * r.random() ** 4)
    return [(pick(), r.randrange(n), round(r.random() * 9, 2)) for _ in range(m)] + [(0, i % n, 1.0) for i in range(m // 2)] + [(3, 3, 1.0), (3, 3, 2.0)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("which,hub", [("d", 1), ("u", iterate.HUB)])
def test_golden_on_loaded_form(spark, tmp_path, which, hub):
    g = convert(make(spark, parsed(DIRECTED if which == "d" else UNDIRECTED), directed=which == "d"), str(tmp_path / "g"), hub)
    assert (g.adjacency.hubs is not None) == (hub == 1)
    for name, (column, f) in ALGORITHMS.items():
        got = values(f(g), column)
        for i, want in zip(IDS, GOLDEN[which][name]):
            assert got[i] == (want if want is None else pytest.approx(want, abs=1e-12)), (name, i, got[i], want)
        assert len(got) == len(IDS)


def test_loaded_form_equals_edges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(iterate, "PART_EDGES", 500)
    g = make(spark, power_law(), range(650))
    loaded = convert(g, str(tmp_path / "g"), 300)
    assert loaded.adjacency.buckets > 2 and loaded.adjacency.hubs is not None
    for name, (column, f) in ALGORITHMS.items():
        a, b = values(f(g), column), values(f(loaded), column)
        assert a.keys() == b.keys() and all(x == b[i] or math.isclose(x, b[i], rel_tol=1e-12) for i, x in a.items()), name


def test_first_hop_moves_no_edges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(iterate, "PART_EDGES", 500)
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    g = convert(make(spark, power_law(), range(650)), str(tmp_path / "g"))
    before = set(os.listdir(folder))
    with A._ways(g, F.lit(1).cast("long"), F.lit(True), iterate.HUB) as ways:
        text = plan(P.relax(g.vertices.where("id = 10").select("id", F.lit(0).cast("long").alias("level")), ways, "level"))
        edges = text[text.index("InMemoryTableScan") :]
        above = text[: text.index("InMemoryTableScan")].splitlines()[-8:]
        assert "Bucketed: true" in edges and "Exchange" not in edges  # neither below nor, but for the state's own, above the edges
        assert sum("Exchange" in x for x in above) <= 1 and text.count("Exchange") <= 2
    for f in (A._shares, A._votes):
        with f(g, iterate.HUB) as ways:
            state = g.vertices.select("id", F.lit(1.0).alias("rank"))
            assert plan(ways.sends(state)).count("Exchange") == 1
    assert set(os.listdir(folder)) == before  # nothing was written to be dealt
    again = read_converted(spark, str(tmp_path / "g"))
    assert again.adjacency.rows.count() == g.adjacency.size
    assert delete_converted(spark, str(tmp_path / "g"), "g")


def test_balanced_parts(spark):
    """Hubs with a third of all edges don't make a part heavier than the others."""
    g = make(spark, power_law(9, 2000, 20_000), range(2000))
    for parts in (1, 7, 16):
        sizes = {r.part: r.n for r in P.edge_parts(g.edges, parts).groupBy("part").agg(F.count("*").alias("n")).collect()}
        total = sum(sizes.values())
        assert total == 30_002 and set(sizes) == set(range(parts)) and max(sizes.values()) <= 1.2 * total / parts
        edges = sorted(r.src for r in g.edges.collect())
        bounds = {r.part: (r.id, r.skip) for r in P.edge_bounds(g.edges, parts).collect()}
        first = {s: i for i, s in reversed(list(enumerate(edges)))}
        assert bounds == {p: (edges[-(-p * total // parts)], -(-p * total // parts) - first[edges[-(-p * total // parts)]]) for p in range(parts)}
    assert not P.edge_bounds(g.edges.limit(0), 3).collect() and not P.edge_parts(g.edges.limit(0), 3).collect()
    few = make(spark, [(5, 6, 1.0), (7, 6, 1.0)], range(9))
    assert sorted(tuple(r) for r in P.edge_bounds(few.edges, 4).collect()) == [(0, 5, 0), (1, 7, 0), (2, 7, 0)]


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_triangles_in_blocks(spark, block):
    r = random.Random(block)
    edges = {(r.randrange(40), int(40 * r.random() ** 2)) for _ in range(500)}
    g = make(spark, [(a, b, 1.0) for a, b in edges], range(45))
    near = {v: ({b for a, b in edges if a == v} | {a for a, b in edges if b == v}) for v in range(45)}
    want = {v: sum((a, b) in edges for a in near[v] for b in near[v]) / (len(near[v]) * (len(near[v]) - 1)) if len(near[v]) > 1 else 0.0 for v in near}
    got = values(A.lcc(g, block), "lcc")
    assert all(got[v] == pytest.approx(x, abs=1e-12) for v, x in want.items())


class Stopped(Exception):
    pass


@pytest.mark.parametrize("name", ["bfs", "sssp", "wcc", "cdlp", "pr"])
def test_a_new_driver_resumes(spark, tmp_path, monkeypatch, name):
    """A run that stops after its third superstep goes on from there and gives equal rows; without resume nothing of it stays."""
    monkeypatch.setattr(iterate, "MOST_HOPS", 2)
    monkeypatch.setattr(A, "CHAIN", 2)
    monkeypatch.setattr(A, "MERGE", 3)
    home, folder = str(tmp_path / "home"), spark.sparkContext.getCheckpointDir().removeprefix("file:")
    edges = [(10 + i, 11 + i, 1.0 + i % 3) for i in range(40)] + [(10, 30, 3.0)]
    engine = Engine(spark, home)
    engine.add_graph("line", make(spark, edges, range(10, 55)))
    args = {"root": 10} if name in ("bfs", "sssp") else {}
    want = sorted(tuple(r) for r in engine.run(name, "line", **args).result.collect())
    commit, made = iterate.Supersteps.commit, []

    def stop(self, **values):
        commit(self, **values)
        made.append(self.made)
        if len(made) == 3:
            raise Stopped

    monkeypatch.setattr(iterate.Supersteps, "commit", stop)
    with pytest.raises(ExecutionError):
        engine.run(name, "line", job_id="gone", **args)
    assert not os.path.exists(f"{folder}/runs/gone")
    made.clear()
    with pytest.raises(ExecutionError):
        engine.run(name, "line", job_id="again", resume=True, **args)
    assert os.path.exists(f"{folder}/runs/again/0")
    begun, counted = made[-1], Counter()
    write = iterate.Supersteps.write
    monkeypatch.setattr(iterate.Supersteps, "commit", commit)
    monkeypatch.setattr(iterate.Supersteps, "write", lambda self, *a, **k: (counted.update([self.made]), write(self, *a, **k))[1])
    other = Engine(spark, home)  # as a new driver: it only knows names
    other.loaded["line"] = read_converted(spark, f"{home}/line")
    run = other.run(name, "line", job_id="again", resume=True, **args)
    assert sorted(tuple(r) for r in run.result.collect()) == want
    assert min(counted) >= begun and not os.path.exists(f"{folder}/runs/again")
    assert other.delete_result(run)


def test_failed_and_repeated_runs_leave_nothing(spark, tmp_path, monkeypatch):
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    engine = Engine(spark, str(tmp_path / "home"))
    bad = make(spark, [(1, 2, -1.0)], [1, 2])
    before = set(os.listdir(folder)) | {"runs"}
    with pytest.raises(ExecutionError):
        engine.run("sssp", bad, root=1)
    monkeypatch.setattr(A, "SETTLING", 1)
    for name in ("wcc", "lcc", "pr", "cdlp", "cdlp"):
        engine.run(name, bad, job_id="twice")
    assert set(os.listdir(folder)) <= before and not os.listdir(f"{folder}/runs")
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("superstep_")]


def test_runs_keep_uses_of_a_name_apart(spark):
    """Two traversals of one run don't take each other's supersteps for their own."""
    a, b = make(spark, [(1, 2, 1.0)], [1, 2, 3]), make(spark, [(1, 3, 1.0)], [1, 2, 3])
    with run_folder(spark, "both"):
        assert [values(A.bfs(g, 1), "level") for g in (a, b)] == [{1: 0, 2: 1, 3: None}, {1: 0, 2: None, 3: 1}]


def test_partitions_follow_the_rows(spark):
    assert [iterate.partitions_for(spark, n) for n in (0, 25_001, 10**6, 10**9)] == [1, 2, 4, 500]


@pytest.mark.parametrize("merge", [2, 8])
def test_votes_of_changes_only(spark, tmp_path, monkeypatch, merge):
    """Signed changes give the labels of whole votes, and what is sent falls with the changes."""
    r = random.Random(merge)
    edges = [(20 * c + r.randrange(20), 20 * c + r.randrange(20), 1.0) for c in range(30) for _ in range(120)] + [(r.randrange(600), r.randrange(600), 1.0) for _ in range(120)] + [(0, i, 1.0) for i in range(0, 600, 3)]
    g = make(spark, edges, range(620))
    for graph in (g, convert(g, str(tmp_path / "g"), 60)):
        for iterations in (3, 12):
            monkeypatch.setattr(A, "SETTLING", -1)
            want = values(A.cdlp(graph, iterations), "label")
            monkeypatch.setattr(A, "SETTLING", 1)
            monkeypatch.setattr(A, "CHAIN", 1)
            monkeypatch.setattr(A, "MERGE", merge)
            seen, commit = [], iterate.Supersteps.commit
            monkeypatch.setattr(iterate.Supersteps, "commit", lambda self, **v: (seen.append(v), commit(self, **v))[1])
            got = values(A.cdlp(graph, iterations), "label")
            monkeypatch.undo()
            assert got == want
            sent = [v["sent"] for v in seen if "sent" in v]
            changed = [v["changed"] for v in seen]
            assert sent and (iterations == 3 or sent[-1] * 4 < sent[0] and changed[-1] * 4 < changed[0])
    assert values(A.cdlp(g, 10, "first"), "label")[615] == 0


def test_stored_histograms_stay_where_they_lie(spark, monkeypatch):
    """Voting again joins the stored entries bucket by bucket: only what changed, and what these vertices hold, is shuffled."""
    monkeypatch.setattr(iterate, "PART_EDGES", 500)
    g = make(spark, power_law(5), range(650))
    with A._votes(g, iterate.HUB) as both:
        log = iterate.Supersteps(spark, "entries", both.parts)
        labels = P.initial_state(g.vertices, "label", F.col("id"))
        for _ in range(2):
            log.write(P.label_histogram(labels, both))
        changes = labels.where("id < 5").select("id", F.col("label").alias("old"), F.lit(1).cast("long").alias("label"))
        text = plan(P.voted_again(P.histogram_changes(changes, both), log.tables()))
        scans = [i for i, x in enumerate(text.splitlines()) if "Bucketed: true" in x]
        assert both.parts > 1 and len(scans) == 2
        for i in scans:  # up from the scan, no exchange before the join
            up = next(x for x in reversed(text.splitlines()[:i]) if "Join" in x or "Exchange" in x)
            assert "Join" in up, up


def test_partitions_are_filled_beyond_the_cores(spark):
    """A session of many partitions doesn't cut a graph into as many: blocks of a shuffle grow by their square."""
    with settings(spark, {"spark.sql.shuffle.partitions": "600"}):
        assert [iterate.partitions_for(spark, n) for n in (50_000, 10**6, 5 * 10**6, 30 * 10**6, 10**9)] == [2, 4, 20, 120, 600]


def test_votes_of_sparse_graphs_move_once(spark, tmp_path, monkeypatch):
    """Labels go to the voters' partitions once, where they are counted and compared; where vertices have many edges counts are made before they move."""
    monkeypatch.setattr(iterate, "PART_EDGES", 500)
    r = random.Random(3)
    thin = make(spark, [(i, r.randrange(900), 1.0) for i in range(900) for _ in range(2)], range(950))
    thick = make(spark, [(r.randrange(40), r.randrange(40), 1.0) for _ in range(20_000)], range(45))
    for name, g, moves in (("thin", thin, 2), ("thick", thick, 3)):
        loaded = convert(g, str(tmp_path / name))
        assert loaded.adjacency.buckets > 1 and loaded.adjacency.sparse == (name == "thin")
        with A._votes(loaded, iterate.HUB) as both:
            labels = P.initial_state(loaded.vertices, "label", F.col("id"))
            text = plan(P.most_frequent(P.label_histogram(labels, both)))
            assert text[: text.index("InMemoryTableScan")].count("Exchange") + text[text.index("InMemoryTableScan") :].count("Exchange") == moves, text
        for settling in (-1, 1):
            monkeypatch.setattr(A, "SETTLING", settling)
            assert values(A.cdlp(g, 6), "label") == values(A.cdlp(loaded, 6), "label")


def test_ends_move_to_their_bucket_once(spark):
    """Loading sums edges and takes degrees where they are written; both forms give equal rows."""
    g = make(spark, power_law(2, 100, 900), range(110))
    once = adjacency_rows(g, 3)
    assert plan(once).split("== Initial Plan ==")[-1].count("Exchange") == 1
    assert sorted(map(str, once.collect())) == sorted(map(str, adjacency_rows(g).collect()))


@pytest.mark.parametrize("root", [0, 7])
def test_long_chains_take_few_supersteps(spark, tmp_path, monkeypatch, root):
    """A vertex inside a chain gets its value from where the chain begins; supersteps don't grow with the chains' length."""
    r, chains, length = random.Random(root), 4, 30
    pairs = {}
    for c in range(chains):  # c*length .. c*length + length - 1 is a chain, its last vertex leads to beginnings
        pairs |= {(c * length + i, c * length + i + 1): 1.0 + r.randrange(9) for i in range(length - 1)}
        pairs |= {(c * length + length - 1, r.randrange(chains) * length): 1.0 + r.randrange(9) for _ in range(3)}
    pairs |= {(5000 + i, 5000 + (i + 1) % 40): 1.0 for i in range(40)}  # a circle that nothing leads to
    pairs |= {(3, 3): 2.0, (4, 6): 1.0, (20, 0): 0.5}  # a loop, a way round, a way out of a chain
    g = make(spark, [(a, b, w) for (a, b), w in pairs.items()], [*range(chains * length), *range(5000, 5042)])
    write, made = iterate.Supersteps.write, []
    monkeypatch.setattr(iterate.Supersteps, "write", lambda self, *a, **k: (made.append(1), write(self, *a, **k))[1])
    want = {name: values(f(g, root), column) for name, column, f in (("bfs", "level", A.bfs), ("sssp", "distance", A.sssp))}
    slow = len(made)
    made.clear()
    monkeypatch.setattr(A, "CHAINED", 10)
    loaded = convert(g, str(tmp_path / "g"))
    assert {name: values(f(loaded, root), column) for name, column, f in (("bfs", "level", A.bfs), ("sssp", "distance", A.sssp))} == want
    assert want["bfs"][5000] is None and sum(x is not None for x in want["sssp"].values()) >= length - root
    assert len(made) < slow, (len(made), slow)


def test_rank_moves_once_a_step(spark, tmp_path, monkeypatch):
    """A step's scattered rank is used by the next step and by the table of the chain, but worked out once."""
    seen, write = [], iterate.Supersteps.write

    def watched(self, df, **measures):
        seen.append(plan(df).splitlines())
        return write(self, df, **measures)

    monkeypatch.setattr(iterate.Supersteps, "write", watched)
    A.pagerank(convert(make(spark, power_law(), range(650)), str(tmp_path / "g")))
    assert len(seen) == 2
    for lines in seen:
        assert sum("ReusedExchange" not in x and "Exchange hash" in x for x in lines) == iterate.CHAIN + 1  # the ranks before, and one a step


@pytest.mark.parametrize("far", [0, -(2**40), 2**62])
def test_votes_without_sorting(spark, tmp_path, far):
    """Where ids and votes fit a long together labels are found by hashing, else by sorting; they are equal."""
    edges = [(a + far, b - far if far == 2**62 else b, w) for a, b, w in power_law(m=2000)]
    g = make(spark, edges, sorted({x for a, b, _ in edges for x in (a, b)}))
    loaded = convert(g, str(tmp_path / "g"))
    assert (loaded.adjacency.votes_within is None) == (far == 2**62)
    with A._votes(loaded, iterate.HUB) as both:
        votes = P.label_histogram(P.initial_state(loaded.vertices, "label", F.col("id")), both)
        found = P.most_frequent(votes, loaded.adjacency.votes_within)
        assert ("SortAggregate" in plan(found)) == (far == 2**62)
        assert values(found, "label") == values(P.most_frequent(votes), "label")
