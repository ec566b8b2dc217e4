"""Dataflow primitives that the algorithms are composed of: DataFrames in, DataFrames out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..model import Graph, MissingRootError, symmetrized
from ..storage import new_path, remove, written
from .iterate import Dealt


def expand_out(frontier: DataFrame, edges: DataFrame | Dealt) -> DataFrame:
    """Edges, a table or dealt ones, that leave the frontier (id, ...): frontier's columns with dst and the edges' other columns."""
    return edges.sends(frontier) if isinstance(edges, Dealt) else frontier.join(edges, frontier.id == edges.src).drop("src")


def _meeting(sent: DataFrame, edges: DataFrame | Dealt) -> DataFrame:
    return edges.meeting(sent) if isinstance(edges, Dealt) else sent


def expand_in(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges that enter the frontier."""
    return frontier.join(edges, frontier.id == edges.dst).drop("dst")


def neighbours(edges: DataFrame) -> DataFrame:
    """(src, dst): out- and in-neighbours as a multiset."""
    return symmetrized(edges.select("src", "dst"))


def neighbour_counts(edges: DataFrame) -> DataFrame:
    """(src, dst, times): out- and in-neighbours with how often they are."""
    return neighbours(edges).groupBy("src", "dst").agg(F.count("*").alias("times"))


def neighbour_sets(edges: DataFrame) -> DataFrame:
    """(src, dst): out- and in-neighbours as sets."""
    return neighbours(edges).distinct()


def unvisited(candidates: DataFrame, visited: DataFrame) -> DataFrame:
    """Distinct candidate ids that aren't visited."""
    return candidates.select("id").distinct().join(visited.select("id"), "id", "left_anti")


def out_degrees(graph: Graph) -> DataFrame:
    """(id, degree) of every vertex, parallel edges counted."""
    counts = graph.edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree"))
    return graph.vertices.join(counts, "id", "left").select("id", F.coalesce("degree", F.lit(0)).alias("degree"))


def in_degrees(graph: Graph) -> DataFrame:
    counts = graph.edges.groupBy(F.col("dst").alias("id")).agg(F.count("*").alias("degree"))
    return graph.vertices.join(counts, "id", "left").select("id", F.coalesce("degree", F.lit(0)).alias("degree"))


def dangling_sum(ranks: DataFrame) -> DataFrame:
    """One row: the rank of vertices (id, degree, rank) without out-edges."""
    return ranks.agg(F.coalesce(F.sum(F.when(F.col("degree") == 0, F.col("rank"))), F.lit(0.0)).alias("dangling"))


def shares(edges: DataFrame) -> DataFrame:
    """(src, dst, share): the part of a vertex's rank that goes along its edges to each target, parallel ones together."""
    pairs = edges.groupBy("src", "dst").agg(F.count("*").alias("times"))
    degrees = edges.groupBy("src").agg(F.count("*").alias("degree"))
    return pairs.join(degrees, "src").select("src", "dst", (F.col("times") / F.col("degree")).alias("share"))


def scatter_add(ranks: DataFrame, edges: DataFrame | Dealt) -> DataFrame:
    """(id, sum): what vertices get when each (id, rank) deals its rank over edges (src, dst, share)."""
    return expand_out(ranks, edges).groupBy(F.col("dst").alias("id")).agg(F.sum(F.col("rank") * F.col("share")).alias("sum"))


def affine_apply(vertices: DataFrame, sums: DataFrame, scale: float, offset: Column) -> DataFrame:
    """vertices with rank = offset + scale * sum; no sum counts as 0."""
    return vertices.join(sums, "id", "left").withColumn("rank", offset + scale * F.coalesce("sum", F.lit(0.0))).drop("sum")


def scatter_min(state: DataFrame, edges: DataFrame, value: str) -> DataFrame:
    """(id, value): the least value that the out-edges of (id, value) bring to each vertex."""
    return expand_out(state.select("id", value), edges.select("src", "dst")).groupBy(F.col("dst").alias("id")).agg(F.min(value).alias(value))


def star_step(links: DataFrame) -> DataFrame:
    """Links (a, b), a > b, contracted: first each a to the least neighbour of its b, then each b of an a to the least of them."""
    low = links.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("m"))
    large = links.join(low, links.b == low.c, "left").select("a", F.coalesce("m", "b").alias("b"))
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").select(F.inline(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))))
    return small.where("a <> b").distinct()


def relax(frontier: DataFrame, edges: DataFrame | Dealt, value: str = "distance", last: bool = False) -> DataFrame:
    """(id, value): the least value + weight over the edges that leave (id, value); an edge without weight adds nothing.

    With `last` also front: whether the value is less than what came along the edge without weight, if one did.
    """
    sums = F.col(value) + F.coalesce("weight", F.lit(0))
    by = expand_out(frontier, edges).groupBy(F.col("dst").alias("id"))
    if not last:
        return by.agg(F.min(sums).alias(value))
    was = F.max(F.when(F.col("weight").isNull(), F.col(value)))
    return by.agg(F.min(sums).alias(value), was.alias("was")).select("id", value, F.coalesce(F.col(value) < F.col("was"), F.lit(True)).alias("front"))


def improved(candidates: DataFrame, state: DataFrame, value: str) -> DataFrame:
    """Candidates (id, value, ...) less than what the state has, or new to it."""
    old = state.select("id", F.col(value).alias("_old"))
    return candidates.join(old, "id", "left").where(F.col("_old").isNull() | (F.col(value) < F.col("_old"))).select(*candidates.columns)


def least(states: DataFrame, value: str) -> DataFrame:
    """(id, value): the least value of each id."""
    return states.groupBy("id").agg(F.min(value).alias(value))


def inner_vertices(edges: DataFrame, keep: int, path: str) -> tuple[DataFrame, dict]:
    """(id, head, ahead) of the vertices with one edge (src, dst, weight) in and one out, but for `keep`: where it comes from and its weight.

    Written to the path; also how many these are (inner) of how many vertices with edges (ends).
    """
    none, one, zero = F.lit(None), F.lit(1), F.lit(0)
    leaves = F.struct(F.col("src").alias("id"), one.alias("out"), zero.alias("into"), none.cast("long").alias("head"), none.cast(edges.schema["weight"].dataType).alias("ahead"))
    enters = F.struct(F.col("dst").alias("id"), zero.alias("out"), one.alias("into"), F.col("src").alias("head"), F.col("weight").alias("ahead"))
    ends = edges.select(F.inline(F.array(leaves, enters))).groupBy("id").agg(F.sum("out").alias("out"), F.sum("into").alias("into"), F.max("head").alias("head"), F.max("ahead").alias("ahead"))
    inner = F.expr("out = 1 and into = 1 and head <> id") & (F.col("id") != F.lit(keep))
    seen = Observation()
    watched = ends.observe(seen, F.count("*").alias("ends"), F.count(F.when(inner, 1)).alias("inner"))
    table, _ = written(watched.where(inner).select("id", "head", "ahead"), path)
    return table, seen.get


def chain_heads(inner: DataFrame, n: int) -> DataFrame:
    """(id, head, ahead) of `n` inner vertices, as a table: the vertex at which each one's chain begins, which is no inner one, and the sum of weights from there.

    Each round doubles how far a vertex looks back, so chains of any length take about log n.  Circles of inner vertices begin nowhere and are left out.
    """
    spark, old = inner.sparkSession, None
    back = lambda t: t.select(F.col("id").alias("_id"), F.col("head").alias("_head"), F.col("ahead").alias("_ahead"))
    for _ in range(n.bit_length() + 1):
        further = inner.join(back(inner), F.col("head") == F.col("_id"), "left")
        path = new_path(spark, "chains")
        inner, seen = written(further.select("id", F.coalesce("_head", "head").alias("head"), (F.coalesce("_ahead", F.lit(0)) + F.col("ahead")).alias("ahead"), F.col("_id").isNotNull().alias("open")), path, open=F.count(F.when(F.col("open"), 1)))
        if old:
            remove(spark, old)
        old = path
        inner = inner.select("id", "head", "ahead")
        if not seen["open"]:
            return inner
    return inner.join(inner.select(F.col("id").alias("head")), "head", "left_anti").select("id", "head", "ahead")


def shortcuts(edges: DataFrame, inner: DataFrame) -> DataFrame:
    """Edges (src, dst, weight) of the other vertices, in which each chain of inner vertices (id, head, ahead) is one edge of its whole weight."""
    outside = edges.join(inner.select(F.col("id").alias("dst")), "dst", "left_anti")
    begun = outside.join(inner, F.col("src") == F.col("id"), "left")
    return begun.groupBy(F.coalesce("head", "src").alias("src"), "dst").agg(F.min(F.coalesce("ahead", F.lit(0)) + F.col("weight")).alias("weight"))


def label_histogram(labels: DataFrame, both: DataFrame | Dealt) -> DataFrame:
    """(id, label, n): labels (id, label) that each vertex's neighbours send over edges (src, dst, times) to dst."""
    sent = expand_out(labels, both).select(F.col("dst").alias("id"), "label", "times")
    return _meeting(sent, both).groupBy("id", "label").agg(F.sum("times").alias("n"))


def most_frequent(histogram: DataFrame, within: tuple[int, int] | None = None) -> DataFrame:
    """(id, label): the most frequent label, of equals the smallest.

    Where labels are known to lie `within` (the greatest, bits of the range) and counts to fit above these bits, both are one number, of which
    the greatest is found by hashing; pairs of numbers have to be sorted by id.
    """
    if within:
        greatest, bits = within
        best = histogram.groupBy("id").agg(F.max(F.shiftleft("n", bits) + (F.lit(greatest) - F.col("label"))).alias("x"))
        return best.select("id", (F.lit(greatest) - F.col("x").bitwiseAND(F.lit((1 << bits) - 1))).alias("label"))
    best = histogram.groupBy("id").agg(F.min(F.struct((-F.col("n")).alias("n"), "label")).alias("x"))
    return best.select("id", "x.label")


def intersection_sizes(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, n): size of the intersection of the sets (src, dst) of a and b, where it isn't empty."""
    left, right = sets.select(F.col("src").alias("a"), "dst"), sets.select(F.col("src").alias("b"), "dst")
    return pairs.join(left, "a").join(right, ["b", "dst"]).groupBy("a", "b").agg(F.count("*").alias("n"))


def signed_changes(changes: DataFrame) -> DataFrame:
    """(id, label, sign): for each vertex that changed from label `old` to `label` one vote less and one more."""
    return changes.select(F.inline(F.array(F.struct("id", F.col("old").alias("label"), F.lit(-1).alias("sign")), F.struct("id", "label", F.lit(1).alias("sign")))))


def histogram_changes(changes: DataFrame, both: DataFrame | Dealt) -> DataFrame:
    """(id, label, n): what changes (id, old, label) add to the neighbours' label histograms, where it isn't 0."""
    sent = expand_out(signed_changes(changes), both).select(F.col("dst").alias("id"), "label", (F.col("sign") * F.col("times")).alias("n"))
    return _meeting(sent, both).groupBy("id", "label").agg(F.sum("n").alias("n")).where("n <> 0")


def voted_again(delta: DataFrame, stored: list[DataFrame], within: tuple[int, int] | None = None) -> DataFrame:
    """(id, label): the most frequent label of the vertices whose histogram changed, out of the stored entries (id, label, n) and their changes.

    Stored entries that are bucketed by id don't move but for those of these vertices.
    """
    touched = delta.select("id").distinct()
    entries = delta
    for table in stored:
        entries = entries.unionAll(table.join(touched.hint("shuffle_hash"), "id", "left_semi").select("id", "label", "n"))
    return most_frequent(entries.groupBy("id", "label").agg(F.sum("n").alias("n")).where("n > 0"), within)


def prefix_sums(rows: DataFrame, key: str, value: str) -> DataFrame:
    """rows with before: the sum of `value` over all rows of smaller `key`, which is unique.

    Rows are dealt into ranges of the key; each range sums on its own, and what stands before it is one number a range.
    """
    spark = rows.sparkSession
    ranges, _ = written(rows.repartitionByRange(key).withColumn("_range", F.spark_partition_id()), new_path(spark, "ranges"))
    totals = ranges.groupBy("_range").agg(F.sum(value).alias("_total"))
    offsets = totals.select("_range", (F.sum("_total").over(Window.orderBy("_range")) - F.col("_total")).alias("_offset"))  # a row per range
    inside = F.sum(value).over(Window.partitionBy("_range").orderBy(key)) - F.col(value)
    return ranges.withColumn("_inside", inside).join(F.broadcast(offsets), "_range").withColumn("before", F.col("_offset") + F.col("_inside")).drop("_range", "_inside", "_offset")


def edge_positions(edges: DataFrame) -> tuple[DataFrame, int]:
    """(id, degree, before) of each source: its edges are numbers before .. before + degree - 1 in the order of sources; and the number of all edges."""
    degrees = prefix_sums(edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree")), "id", "degree")
    return degrees, degrees.agg(F.coalesce(F.sum("degree"), F.lit(0))).first()[0]


def edge_bounds(edges: DataFrame, parts: int) -> DataFrame:
    """(part, id, skip): where each of `parts` ranges of equally many edges begins: at the source id, after `skip` of its edges.

    A hub may stretch over several ranges.  Part p begins at edge ceil(p * edges / parts); parts that begin behind the last edge, and graphs without edges, have no rows.
    """
    degrees, total = edge_positions(edges)
    if not total:
        return degrees.select(F.lit(0).cast("long").alias("part"), "id", F.lit(0).cast("long").alias("skip")).limit(0)
    part = lambda at: F.call_function("div", at * F.lit(parts), F.lit(total))
    first = F.when(F.col("before") > 0, part(F.col("before") - 1) + 1).otherwise(F.lit(0).cast("long"))
    last = part(F.col("before") + F.col("degree") - 1)
    cuts = degrees.where(first <= last).withColumn("part", F.explode(F.sequence(first, last)))
    begins = F.call_function("div", F.col("part") * F.lit(total) + F.lit(parts - 1), F.lit(parts))
    return cuts.select("part", "id", (begins - F.col("before")).alias("skip"))


def edge_parts(edges: DataFrame, parts: int) -> DataFrame:
    """edges with part: the range of edge_bounds in which each lies, with a hub's edges in the order of a hash of their targets.

    Parts have about equally many edges whatever the degrees; parallel edges stay together.
    """
    degrees, total = edge_positions(edges)
    at = F.col("before") + F.pmod(F.xxhash64("dst"), F.col("degree"))
    part = F.call_function("div", at * F.lit(parts), F.lit(max(total, 1))).cast("int")
    return edges.join(degrees.withColumnRenamed("id", "_id"), F.col("src") == F.col("_id")).withColumn("part", part).drop("_id", "degree", "before")


BLOCK = 4096  # neighbours that are sent on at once


def ranked(ends: DataFrame, degrees: DataFrame) -> DataFrame:
    """Pairs (a, b, d, m) of ends (id, other, m), once each, from the end of less degree, of equals of less id; d is b's degree."""
    d = degrees.select(F.col("id").alias("_id"), "d")
    low = ends.where("id <> other").join(d.withColumnRenamed("d", "da"), F.col("id") == F.col("_id")).drop("_id").join(d, F.col("other") == F.col("_id"))
    return low.where(F.struct("da", "id") < F.struct("d", "other")).select(F.col("id").alias("a"), F.col("other").alias("b"), "d", "m")


def ranked_lists(low: DataFrame) -> DataFrame:
    """(id, next, one, two): each vertex's pairs in order of degree and id, and their ids apart by m, the directions of their edges.

    next has b, m and how many ids of `one` and of `two` stand before what follows b.
    """
    order = Window.partitionBy("a").orderBy("d", "b")
    upto = lambda m: F.sum((F.col("m") == m).cast("int")).over(order).cast("int")
    rows = low.select("a", "d", "b", "m", upto(1).alias("ones"), upto(2).alias("twos"))
    lists = rows.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("d", "b", "m", "ones", "twos"))).alias("next"))
    of = lambda m: F.transform(F.filter("next", lambda y: y["m"] == m), lambda y: y["b"])
    return lists.select(F.col("a").alias("id"), "next", of(1).alias("one"), of(2).alias("two"))


def closed_triangles(lists: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, t): for each triangle and each of its vertices the number of directed edges between the other two, partly summed.

    Each vertex sends to each neighbour b on its list what follows b there, at most `block` ids of either kind a row; b's own lists are
    intersected with that.  As they are kept apart by m, the numbers of hits are enough for two of the vertices.
    """
    sent = lists.select(F.col("id").alias("a"), "one", "two", F.inline("next"))
    blocks = F.ceil(F.greatest(F.size("one") - F.col("ones"), F.size("two") - F.col("twos")) / block)
    sent = sent.withColumn("blocks", blocks.cast("int")).where("blocks > 0").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rest = lambda x: F.slice(x, F.col(f"{x}s") + F.col("i") * block + 1, F.lit(block)).alias(x)
    own = lists.select(F.col("id").alias("b"), F.col("one").alias("own_one"), F.col("two").alias("own_two"))
    both = sent.select("a", "b", "m", rest("one"), rest("two")).join(own, "b")
    none = F.array().cast("array<bigint>")
    hit = lambda x, y: F.when((F.size(x) > 0) & (F.size(f"own_{y}") > 0), F.array_intersect(x, f"own_{y}")).otherwise(none).alias(f"{x}_{y}")
    hits = both.select("a", "b", "m", *[hit(x, y) for x in ("one", "two") for y in ("one", "two")])
    size = lambda x, y: F.size(f"{x}_{y}").cast("long")
    for_a = size("one", "one") + size("two", "one") + 2 * (size("one", "two") + size("two", "two"))
    for_b = size("one", "one") + size("one", "two") + 2 * (size("two", "one") + size("two", "two"))
    found, m = F.concat("one_one", "one_two", "two_one", "two_two"), F.col("m").cast("long")
    row = lambda i, t: F.struct(i.alias("id"), t.alias("t"))
    ends = F.filter(F.array(row(F.col("a"), for_a), row(F.col("b"), for_b)), lambda x: x["t"] > 0)
    return hits.select(F.inline(F.concat(ends, F.transform(found, lambda c: row(c, m))))).groupBy("id").agg(F.sum("t").alias("t"))


def guarded_ratio(count: Column, degree: Column) -> Column:
    """count / (degree * (degree - 1)), 0 where the degree is under 2."""
    d = degree.cast("double")
    return F.when(degree >= 2, count / (d * (d - 1))).otherwise(F.lit(0.0))


def initial_state(vertices: DataFrame, value: str, what: Column) -> DataFrame:
    """Every vertex with the same first value, or one of its own."""
    return vertices.select("id", what.alias(value))


def require_vertex(vertices: DataFrame, root: int) -> DataFrame:
    """The root's row; MissingRootError if it is no vertex."""
    found = vertices.where(F.col("id") == F.lit(int(root))).select("id").limit(1)
    if not found.count():
        raise MissingRootError(f"root {root} is no vertex")
    return found


def with_default(vertices: DataFrame, found: DataFrame, value: str, default: Column) -> DataFrame:
    """(id, value) of every vertex; the default where nothing was found."""
    return vertices.join(found, "id", "left").select("id", F.coalesce(F.col(value), default).alias(value))


def graph_stats(graph: Graph) -> DataFrame:
    """One row: vertices, edges."""
    v = graph.vertices.agg(F.count("*").alias("vertices")).withColumn("_k", F.lit(1))
    e = graph.edges.agg(F.count("*").alias("edges")).withColumn("_k", F.lit(1))
    return v.join(F.broadcast(e), "_k").select("vertices", "edges")  # one row each
