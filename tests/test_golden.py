"""The two small golden graphs, their text forms and edge cases of every algorithm."""

import math

import pytest
from pyspark.sql import functions as F

from graphloom.functions.formatting import UNREACHED_LEVEL, result_lines
from graphloom.model import Graph, GraphError, MissingRootError
from graphloom.operators import algorithms as A

IDS = [10, 20, 30, 40, 50, 60, 70, 90]
DIRECTED = "10 20 1.0 · 10 30 4.0 · 20 30 2.0 · 30 10 1.5 · 20 40 7.0 · 30 40 3.0 · 40 50 0.5 · 20 10 1.0 · 70 60 2.5"
UNDIRECTED = "10 20 1.0 · 10 30 4.0 · 20 30 2.0 · 20 40 7.0 · 30 40 3.0 · 40 50 0.5 · 60 70 2.5"
INF = math.inf
GOLDEN = {
    "d": {
        "bfs": [0, 1, 1, 2, 3, None, None, None],
        "sssp": [0.0, 1.0, 3.0, 6.0, 6.5, None, None, None],
        "wcc": [10, 10, 10, 10, 10, 60, 60, 90],
        "cdlp": [10, 20, 20, 10, 20, 60, 70, 90],
        "lcc": [0.5, 0.5, 0.5, 1 / 6, 0.0, 0.0, 0.0, 0.0],
        "pr": [1.575498124529299e-01, 1.227661366896979e-01, 1.575498124529299e-01, 1.575498124529299e-01, 1.897246279670431e-01, 1.032445071597640e-01, 5.580764541235265e-02, 5.580764541235265e-02],
    },
    "u": {
        "bfs": [0, 1, 1, 2, 3, None, None, None],
        "sssp": [0.0, 1.0, 3.0, 6.0, 6.5, None, None, None],
        "wcc": [10, 10, 10, 10, 10, 60, 60, 90],
        "cdlp": [10, 20, 20, 10, 20, 60, 70, 90],
        "lcc": [1.0, 2 / 3, 2 / 3, 1 / 3, 0.0, 0.0, 0.0, 0.0],
        "pr": [1.159494979639992e-01, 1.680760227125802e-01, 1.680760227125802e-01, 1.760628114766623e-01, 7.113634442125419e-02, 1.398601398574152e-01, 1.398601398574152e-01, 2.097902099809360e-02],
    },
}


def make(spark, edges, ids=IDS, directed=True):
    rows = [tuple(x) for x in edges]
    return Graph.of(spark.createDataFrame([(i,) for i in ids], "id long"), spark.createDataFrame(rows, "src long, dst long, weight double"), directed)


def parsed(text):
    return [(int(a), int(b), float(w)) for a, b, w in (x.split() for x in text.split("·"))]


@pytest.fixture(scope="module", params=["d", "u"])
def tiny(request, spark):
    return request.param, make(spark, parsed(DIRECTED if request.param == "d" else UNDIRECTED), directed=request.param == "d")


def values(df, column):
    return {r.id: r[column] for r in df.collect()}


@pytest.mark.parametrize("name,column,f", [("bfs", "level", lambda g: A.bfs(g, 10)), ("sssp", "distance", lambda g: A.sssp(g, 10)), ("wcc", "component", A.wcc), ("cdlp", "label", A.cdlp), ("lcc", "lcc", A.lcc), ("pr", "rank", A.pagerank)])
def test_golden(tiny, name, column, f):
    which, g = tiny
    got = values(f(g), column)
    for i, want in zip(IDS, GOLDEN[which][name]):
        assert got[i] == (want if want is None else pytest.approx(want, abs=1e-12)), (i, got[i], want)
    assert len(got) == len(IDS)


def test_lines(tiny):
    _, g = tiny
    levels = values(result_lines(A.bfs(g, 10), "level"), "line")
    assert levels[10] == "10 0" and levels[90] == f"90 {UNREACHED_LEVEL}"
    far = values(result_lines(A.sssp(g, 10), "distance"), "line")
    assert far[50] == "50 6.500000000000000e+00" and far[60] == "60 infinity"


def test_missing_root_and_bad_input(spark, tiny):
    _, g = tiny
    for f in (A.bfs, A.sssp):
        with pytest.raises(MissingRootError):
            f(g, 11)
    with pytest.raises(GraphError):
        A.sssp(Graph(g.vertices, g.edges.drop("weight")), 10)
    with pytest.raises(GraphError):
        A.sssp(make(spark, [(10, 20, -1.0)]), 10)
    with pytest.raises(GraphError):
        A.cdlp(g, isolated="none")
    with pytest.raises(GraphError):
        make(spark, [(10, 11, 1.0)]).validate()
    g.validate()


def test_zero_iterations_run_once(tiny):
    _, g = tiny
    assert values(A.pagerank(g, iterations=0), "rank") == pytest.approx(values(A.pagerank(g, iterations=1), "rank"))
    assert values(A.cdlp(g, iterations=0), "label") == values(A.cdlp(g, iterations=1), "label")


def brute_lcc(ids, edges):
    out = {i: {b for a, b, _ in edges if a == i} for i in ids}
    near = {i: out[i] | {a for a, b, _ in edges if b == i} for i in ids}
    t = {i: sum(len(near[i] & out[u]) for u in near[i]) for i in ids}
    return {i: t[i] / (len(near[i]) * (len(near[i]) - 1)) if len(near[i]) >= 2 else 0.0 for i in ids}


def test_parallel_edges_and_loops(spark):
    edges = [(1, 2, 1.0), (1, 2, 2.0), (2, 2, 1.0), (2, 3, 1.0), (3, 1, 1.0), (3, 3, 1.0), (4, 4, 1.0), (5, 2, 1.0), (3, 5, 4.0)]
    ids = [1, 2, 3, 4, 5]
    g = make(spark, edges, ids)
    assert values(A.lcc(g), "lcc") == pytest.approx(brute_lcc(ids, edges))
    n, rank = 5, {i: 0.2 for i in ids}
    for _ in range(10):
        degree = {i: sum(a == i for a, _, _ in edges) for i in ids}
        dangling = sum(rank[i] for i in ids if not degree[i])
        rank = {i: 0.15 / n + 0.85 * (sum(rank[a] / degree[a] for a, b, _ in edges if b == i) + dangling / n) for i in ids}
    assert values(A.pagerank(g), "rank") == pytest.approx(rank, abs=1e-12)
    label = {i: i for i in ids}
    for _ in range(10):
        new = {}
        for i in ids:
            votes = [label[b] for a, b, _ in edges if a == i] + [label[a] for a, b, _ in edges if b == i]
            new[i] = min(set(votes), key=lambda x: (-votes.count(x), x)) if votes else label[i]
        label = new
    assert values(A.cdlp(g), "label") == label


def test_empty_edges(spark):
    g = make(spark, [], [3, 1])
    assert values(A.bfs(g, 3), "level") == {3: 0, 1: None}
    assert values(A.wcc(g), "component") == {3: 3, 1: 1}
    assert values(A.lcc(g), "lcc") == {3: 0.0, 1: 0.0}
    assert values(A.pagerank(g), "rank") == pytest.approx({3: 0.5, 1: 0.5})
    assert values(A.cdlp(g, isolated="first"), "label") == {3: 1, 1: 1}
    assert values(A.sssp(g, 1), "distance") == {3: None, 1: 0.0}


def test_properties(spark):
    edges = [(i * 7 % 40, i * 11 % 40, float(i % 5)) for i in range(90)]
    g = make(spark, edges, range(40))
    assert sum(values(A.pagerank(g), "rank").values()) == pytest.approx(1)
    level, far, part = values(A.bfs(g, 0), "level"), values(A.sssp(g, 0), "distance"), values(A.wcc(g), "component")
    for a, b, w in edges:
        assert part[a] == part[b]
        if level[a] is not None:
            assert level[b] <= level[a] + 1 and far[b] <= far[a] + w + 1e-9
    for i, c in part.items():
        assert c == min(j for j in part if part[j] == c)
    again = Graph(g.vertices.repartition(3), g.edges.orderBy(F.desc("dst")).repartition(5))
    assert values(A.wcc(again), "component") == part and values(A.bfs(again, 0), "level") == level
