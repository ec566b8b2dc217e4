"""The six whole-graph algorithms."""

from __future__ import annotations

from contextlib import AbstractContextManager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import Graph, GraphError
from ..storage import new_path, remove, static_plans, written
from . import primitives as P
from .iterate import CHAIN, CHAIN_ROWS, HUB, Dealt, Supersteps, dealt, hops_for, partitions_for, placed

def _planned(spark: SparkSession, rows: int) -> AbstractContextManager[None]:
    """Of few rows a plan is one job over as many partitions as they fill; of many it adapts, so that a vertex of many rows is split."""
    return static_plans(spark, partitions_for(spark, rows), compiled=False) if rows < CHAIN_ROWS else nullcontext()


MERGE = 8  # tables of a traversal's state before they are merged


def _ways(graph: Graph, weight: Column, used: Column, hub: int) -> AbstractContextManager[Dealt]:
    """Edges (src, dst, weight), one per pair, and each vertex's to itself without a weight; of pairs with a null weight none."""
    least = F.min("weight")
    if graph.adjacency:
        rows = graph.adjacency.rows.where(F.col("other").isNull() | ((F.col("forth") > 0) & used))
        salt = ["salt"] if graph.adjacency.hubs is not None else []
        ways = rows.select(F.col("id").alias("src"), F.coalesce("other", "id").alias("dst"), F.when(F.col("other").isNotNull(), weight).alias("weight"), *salt)
        return placed(ways, graph.adjacency, least=least)
    pairs = graph.edges.withColumn("weight", weight).where(used).groupBy("src", "dst").agg(least.alias("weight"))
    stay = graph.vertices.select("id", "id", F.lit(None).cast(pairs.schema["weight"].dataType))
    return dealt(pairs.unionAll(stay), "src", hub, least=least)


def _nearest(graph: Graph, root: int, ways: AbstractContextManager[Dealt], value: str, zero: Column, hub: int) -> DataFrame:
    """(id, value): least sum of weights over edges (src, dst, weight) from the root, of vertices that are reached.

    Where most vertices stand inside chains these are walked as one edge, so that the supersteps don't grow with their length; what is inside
    takes its value from where its chain begins.
    """
    start = P.require_vertex(graph.vertices, root)
    with ways as ways:
        if (ways.measures["least"] or 0) < 0:
            raise GraphError("negative weights")
        inner = _inner(graph, ways, root)
        if inner is None:
            return _relaxed(graph, root, start, ways, value, zero)
        pairs = P.shortcuts(_walked(ways), inner)
        stay = graph.vertices.join(inner.select("id"), "id", "left_anti").select("id", "id", F.lit(None).cast(pairs.schema["weight"].dataType))
        with dealt(pairs.unionAll(stay), "src", hub) as short:
            found = _relaxed(graph, root, start, short, value, zero, chains=True)
    inside = inner.join(found.withColumnRenamed("id", "head"), "head").select("id", (F.col(value) + F.col("ahead")).alias(value))
    return found.unionAll(inside)


CHAINED = 1000  # vertices inside chains; fewer are walked one by one


def _walked(ways: Dealt) -> DataFrame:
    return ways.edges.where("weight is not null").select("src", "dst", "weight")


def _inner(graph: Graph, ways: Dealt, root: int) -> DataFrame | None:
    """(id, head, ahead) of the vertices inside chains, if these are most of those with edges; none are in undirected graphs."""
    if not graph.directed:
        return None
    spark = graph.vertices.sparkSession
    path = new_path(spark, "inner")
    inner, seen = P.inner_vertices(_walked(ways), root, path)
    many = seen["inner"] >= CHAINED and 2 * seen["inner"] > seen["ends"]
    heads = P.chain_heads(inner, seen["inner"]) if many else None
    remove(spark, path)
    return heads


def _relaxed(graph: Graph, root: int, start: DataFrame, ways: Dealt, value: str, zero: Column, chains: bool = False) -> DataFrame:
    """(id, value) as in _nearest, over dealt edges.

    A superstep relaxes several hops as one plan, in which vertices keep what they have by an edge to themselves.
    Only what fell in its last hop is still to be sent on: the next frontier.
    """
    steps = Supersteps(graph.vertices.sparkSession, value, graph=graph.name, root=root, **({"chains": True} if chains else {}))
    if not steps.values:
        steps.write(start.select("id", zero.alias(value), F.lit(True).alias("front")))
        steps.commit(hops=4, rows=1)
    hops, rows = steps.values["hops"], steps.values["rows"]
    frontier = steps.table().where("front")
    while rows:
        found = frontier
        for h in range(1, hops + 1):
            found = P.relax(found, ways, value, last=h == hops)
        fresh = P.improved(found, P.least(steps.all(), value), value)
        table, seen = steps.write(fresh, front=F.count(F.when(F.col("front"), 1)))
        frontier = table.where("front")
        hops, rows = hops_for(seen["front"], rows, hops), seen["front"]
        if rows and len(steps.paths) > MERGE:
            steps.replace(P.least(steps.but_last(), value).withColumn("front", F.lit(False)), keep=1)
        steps.commit(hops=hops, rows=rows)
    return P.least(steps.all(), value)


def bfs(graph: Graph, root: int, hub: int = HUB) -> DataFrame:
    """(id, level): least number of edges from the root along edge directions; null where it isn't reached.

    A missing root raises.
    """
    ways = _ways(graph, F.lit(1).cast("long"), F.lit(True), hub)
    levels = _nearest(graph, root, ways, "level", F.lit(0).cast("long"), hub)
    return P.with_default(graph.vertices, levels, "level", F.lit(None).cast("long"))


def sssp(graph: Graph, root: int, hub: int = HUB) -> DataFrame:
    """(id, distance): least sum of weights from the root; null where it isn't reached.

    Only vertices whose distance fell are expanded.  Weights must not make a
    negative cycle: a negative weight raises.  A missing root raises.
    """
    if not graph.weighted:
        raise GraphError("distances need a weighted graph")
    ways = _ways(graph, F.col("weight"), F.col("weight").isNotNull(), hub)
    distances = _nearest(graph, root, ways, "distance", F.lit(0.0), hub)
    return P.with_default(graph.vertices, distances, "distance", F.lit(None).cast("double"))


def pagerank(graph: Graph, damping: float = 0.85, iterations: int = 10, hub: int = HUB) -> DataFrame:
    """(id, rank) after a fixed number of synchronous steps, one at least; parallel edges and self-loops count.

    The rank of vertices without out-edges is shared by all.  An empty graph gives no rows.

    A step is linear: rank = scale * scattered rank + the same offset for all.  So the steps only scatter, without
    waiting for a sum over all vertices, first 1 from each vertex, then what came of that (walks of 0, 1, 2 ... edges).
    What each step scatters in total tells the rank of vertices without out-edges, hence the offsets, hence
    each step's part in the ranks.
    """
    spark = graph.vertices.sparkSession
    times = max(1, iterations)
    steps = Supersteps(spark, "pagerank", graph=graph.name, times=times)
    n = graph.vertices.count()
    if not n:
        return graph.vertices.select("id", F.lit(0.0).alias("rank"))
    totals = steps.values.get("totals", [float(n)])
    with _shares(graph, hub) as edges:
        walk = graph.vertices.select("id", F.lit(1.0).alias("rank"))
        if steps.values:
            walk = steps.table().where(F.col("step") == len(totals) - 1).select("id", "rank")
        for i in range(len(totals), times + 1, CHAIN):
            last = min(i + CHAIN - 1, times)
            out = None
            for k in range(i, last + 1):
                # stated, as the next step's join implies it: so this step's shuffle serves both that and the total
                walk = P.scatter_add(walk, edges).where("id is not null").withColumnRenamed("sum", "rank")
                tagged = walk.withColumn("step", F.lit(k))
                out = tagged if out is None else out.unionAll(tagged)
            table, seen = steps.write(out, **{f"t{k}": F.sum(F.when(F.col("step") == k, F.col("rank"))) for k in range(i, last + 1)})
            totals += [seen[f"t{k}"] or 0.0 for k in range(i, last + 1)]
            steps.commit(totals=totals)
            walk = table.where(F.col("step") == last).select("id", "rank")
    parts = _walk_parts(totals, damping, n, times)
    weight = F.element_at(F.array(*[F.lit(p) for p in parts]), F.col("step") + 1)
    sums = steps.all().groupBy("id").agg(F.sum(F.col("rank") * weight).alias("sum"))
    return P.affine_apply(graph.vertices.select("id"), sums, 1.0, F.lit(parts[0]))


def _shares(graph: Graph, hub: int) -> AbstractContextManager[Dealt]:
    """Edges (src, dst, share), one per pair."""
    if not graph.adjacency:
        return dealt(P.shares(graph.edges.select("src", "dst")), "src", hub)
    salt = ["salt"] if graph.adjacency.hubs is not None else []
    return placed(graph.adjacency.rows.where("forth > 0").select(F.col("id").alias("src"), F.col("other").alias("dst"), "share", *salt), graph.adjacency)


def _votes(graph: Graph, hub: int) -> AbstractContextManager[Dealt]:
    """Neighbours (src, dst, times) in both directions, one row per pair."""
    if not graph.adjacency:
        return dealt(P.neighbour_counts(graph.edges), "src", hub)
    salt = ["salt"] if graph.adjacency.hubs is not None else []
    return placed(graph.adjacency.rows.where("other is not null").select(F.col("id").alias("src"), F.col("other").alias("dst"), (F.col("forth") + F.col("back")).alias("times"), *salt), graph.adjacency)


def _walk_parts(totals: list[float], damping: float, n: int, times: int) -> list[float]:
    """Each step's part in the ranks after `times` steps; totals: what is left after 0, 1, 2 ... steps of scattering 1 each."""
    lost = [a - b for a, b in zip(totals, totals[1:])]  # what vertices without out-edges held
    parts = [1.0 / n]
    for _ in range(times):
        dangling = sum(p * m for p, m in zip(parts, lost))
        parts = [(1 - damping + damping * dangling) / n, *[damping * p for p in parts]]
    return parts


def wcc(graph: Graph, rounds: int = 100) -> DataFrame:
    """(id, component): the smallest id reachable along edges in either direction.

    Links are contracted to stars by alternating steps, which takes about log(n) rounds
    where passing labels along edges takes as many as the longest path.
    """
    steps = Supersteps(graph.vertices.sparkSession, "wcc", graph=graph.name)
    check = {"links": F.count("*"), "hash": F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).cast("string")}
    if not steps.values:
        if graph.adjacency:  # a pair is there once from either end
            links = graph.adjacency.rows.where("id > other").select(F.col("id").alias("a"), F.col("other").alias("b"))
        else:
            links = graph.edges.where("src <> dst").select(F.greatest("src", "dst").alias("a"), F.least("src", "dst").alias("b")).distinct()
        steps.commit(**steps.write(links, **check)[1], settled=False)
    for _ in range(rounds):
        if steps.values["settled"]:
            break
        links, before = steps.table(), steps.values
        with _planned(steps.spark, before["links"]):
            _, now = steps.replace(P.star_step(links), **check)
        steps.commit(**now, settled=all(before[k] == now[k] for k in now))
    else:
        raise RuntimeError(f"no fix-point after {rounds} rounds")
    return P.with_default(graph.vertices, steps.table().select(F.col("a").alias("id"), F.col("b").alias("component")), "component", F.col("id"))


def cdlp(graph: Graph, iterations: int = 10, isolated: str = "own", hub: int = HUB) -> DataFrame:
    """(id, label) after a fixed number of synchronous votes, one at least.

    Each vertex takes the most frequent label among its in- and out-neighbours, of equals
    the smallest; reciprocal and parallel edges vote as often as they are there.  A vertex without
    neighbours keeps its own label (isolated='own') or gets the smallest id of all ('first').
    Votes are counted by (vertex, label) before they meet, so hubs don't gather their neighbours.  Once a quarter of
    the voters or fewer change their label in a step, only the changes are sent (_settled).
    """
    if isolated not in ("own", "first"):
        raise GraphError(f"isolated is 'own' or 'first', not {isolated!r}")
    times = max(1, iterations)
    spark = graph.vertices.sparkSession
    steps = Supersteps(spark, "cdlp", graph=graph.name, times=times)
    within = graph.adjacency.votes_within if graph.adjacency else None
    with _votes(graph, hub) as both:
        done = steps.values.get("done", 0)
        labels = steps.table().select("id", "label") if done else P.initial_state(graph.vertices, "label", F.col("id"))
        while done < times and not _settling(steps.values):
            upto = min(times, done + CHAIN)
            for _ in range(done, upto):
                last, labels = labels, P.most_frequent(P.label_histogram(labels, both), within)
            labels, seen = steps.replace(labels.join(last.withColumnRenamed("label", "old"), "id"), changed=F.count(F.when(F.col("label") != F.col("old"), 1)), voters=F.count("*"))
            labels = labels.select("id", "label")
            done = upto
            steps.commit(done=done, **seen)
        if done < times and steps.values["changed"]:
            labels = _settled(steps, both, done, times, within)
    alone = F.col("id")
    if isolated == "first":
        alone = F.lit(graph.vertices.agg(F.min("id")).first()[0])
    return P.with_default(graph.vertices, labels, "label", alone)


SETTLING = 0.25  # of the voters changed their label in the last step: from there on only changes are sent


def _settling(values: dict) -> bool:
    return bool(values) and values["changed"] <= SETTLING * values["voters"]


def _settled(steps: Supersteps, both: Dealt, done: int, times: int, within: tuple[int, int] | None) -> DataFrame:
    """(id, label) after the rest of the votes, in which only vertices that changed send: one vote less for the old label, one more for the new.

    Histograms are kept as tables of signed entries, bucketed by id, together with the labels that were taken in each step.  A vertex votes again
    if its histogram changed, by its entries in all tables.  A step in which nothing changes is the last.
    """
    log = Supersteps(steps.spark, "cdlp-votes", both.parts, **steps.parameters)
    votes = lambda t: t.where("step is null").select("id", "label", "n")
    taken = lambda t: t.where("step is not null").select("id", "label", "step", "old")
    none = F.lit(None)
    as_votes = lambda t: t.select("id", "label", "n", none.cast("int").alias("step"), none.cast("long").alias("old"))
    as_taken = lambda t, step: t.select("id", "label", none.cast("long").alias("n"), step.cast("int").alias("step"), "old")
    changed = F.count(F.when(F.col("old") != F.col("label"), 1))
    if not log.values:
        before = steps.table()
        all_votes = P.label_histogram(before.select("id", "label"), both)
        new = P.most_frequent(all_votes, within).join(before.select("id", F.col("label").alias("old")), "id")
        _, seen = log.write(as_votes(all_votes).unionAll(as_taken(new, F.lit(done + 1))), changed=changed)
        log.commit(done=done + 1, **seen)
    while log.values["done"] < times and log.values["changed"]:
        step = log.values["done"] + 1
        tables = log.tables()
        delta = P.histogram_changes(taken(tables[-1]).where(F.col("step") == step - 1).where("old <> label"), both)
        new = P.voted_again(delta, [votes(t) for t in tables], within)
        have = None
        for t in tables:
            some = taken(t).join(delta.select("id").distinct().hint("shuffle_hash"), "id", "left_semi")
            have = some if have is None else have.unionAll(some)
        have = have.groupBy("id").agg(F.max_by("label", "step").alias("old"))
        _, seen = log.write(as_votes(delta).unionAll(as_taken(new.join(have, "id").where("old <> label"), F.lit(step))), changed=changed, sent=F.count(F.when(F.col("step").isNull(), 1)))
        if len(log.paths) > MERGE:
            every = log.all()
            sums = as_votes(votes(every).groupBy("id", "label").agg(F.sum("n").alias("n")).where("n <> 0"))
            latest = taken(every).groupBy("id").agg(F.max(F.struct("step", "label", "old")).alias("x")).select("id", "x.*")
            log.replace(sums.unionAll(as_taken(latest, F.col("step"))))
        log.commit(done=step, **seen)
    return taken(log.all()).groupBy("id").agg(F.max_by("label", "step").alias("label"))


def _pairs(graph: Graph) -> tuple[DataFrame, DataFrame, dict]:
    """(id, other, m) of each vertex and neighbour, loops too, with the number of directions that edges between them have; degrees; number of loops."""
    spark = graph.vertices.sparkSession
    loops = F.count(F.when(F.col("id") == F.col("other"), 1))
    m = (F.col("forth") > 0).cast("int") + (F.col("back") > 0).cast("int")
    if graph.adjacency:
        ends = graph.adjacency.rows.where("other is not null").select("id", "other", m.alias("m"))
        seen = ends.agg(loops.alias("loops"), F.count("*").alias("n")).first().asDict()
    else:
        edges = graph.edges.select(F.col("src").alias("id"), F.col("dst").alias("other"), F.lit(1).alias("forth"), F.lit(0).alias("back"))
        both = edges.unionAll(edges.select(F.col("other"), F.col("id"), F.col("back"), F.col("forth")))
        ends, seen = written(both.groupBy("id", "other").agg(F.max("forth").alias("forth"), F.max("back").alias("back")).select("id", "other", m.alias("m")), new_path(spark, "pairs"), loops=loops, n=F.count("*"))
    degrees = ends.where("id <> other").groupBy("id").agg(F.count("*").alias("d"), F.sum("m").alias("touching"))
    with _planned(spark, seen["n"]):
        return ends, written(degrees, new_path(spark, "degrees"))[0], seen


def lcc(graph: Graph, block: int = P.BLOCK) -> DataFrame:
    """(id, lcc): share of ordered pairs of neighbours that an edge joins.

    Neighbours are the distinct in- and out-neighbours, the vertex itself too if it has a
    loop.  Triangles are found once each, from their vertex of least degree: lists of neighbours of higher degree, of which none is
    longer than the root of twice the edges, go to the neighbours in blocks and are intersected with theirs.
    A triangle counts for its three vertices by the directed edges between the other two.
    """
    spark = graph.vertices.sparkSession
    ends, degrees, seen = _pairs(graph)
    with _planned(spark, seen["n"]):
        lists, _ = written(P.ranked_lists(P.ranked(ends, degrees)), new_path(spark, "lists"))
        counts, _ = written(P.closed_triangles(lists, block), new_path(spark, "triangles"))
    loops, pairs = ends.where("id = other").select("id"), ends.where("id <> other")
    if seen["loops"]:
        # one at a neighbour is an edge among neighbours; a vertex's own makes it its own neighbour
        counts = counts.unionAll(pairs.join(loops.select(F.col("id").alias("other")), "other", "left_semi").select("id", F.lit(1).cast("long").alias("t")))
    counts = counts.groupBy("id").agg(F.sum("t").alias("t"))
    state = graph.vertices.join(degrees, "id", "left").join(counts, "id", "left")
    state = state.join(loops.withColumn("loop", F.lit(1)), "id", "left") if seen["loops"] else state.withColumn("loop", F.lit(0))
    state = state.na.fill(0, ["d", "touching", "t", "loop"])
    count = F.col("t") + F.col("loop") * (F.col("touching") + 1)
    return state.select("id", P.guarded_ratio(count, F.col("d") + F.col("loop")).alias("lcc"))
