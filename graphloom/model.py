"""The property graph: vertices and edges as DataFrames."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERTEX_SCHEMA = T.StructType([T.StructField("id", T.LongType())])
EDGE_SCHEMA = T.StructType([T.StructField("src", T.LongType()), T.StructField("dst", T.LongType())])
WEIGHTED_EDGE_SCHEMA = T.StructType([*EDGE_SCHEMA.fields, T.StructField("weight", T.DoubleType())])


class GraphError(ValueError):
    """A graph or an argument that an operation can't work with."""


class MissingRootError(GraphError):
    """The root of a traversal is no vertex."""


@dataclass(frozen=True)
class Adjacency:
    """The loaded form of a graph: its neighbours in both directions, as a table that is bucketed by id and sorted.

    rows: id, other, forth and back (edges from id to other and from other to id), weight (the least of those that go forth), share (the part of
    id's edges that go forth to other); a row without other stands for the vertex itself.  Of hubs, which lie in several buckets, rows have a salt too.
    edges: their number; ids: the least and the greatest vertex.
    """

    rows: DataFrame
    buckets: int
    size: int
    hubs: DataFrame | None = None
    vertices: int | None = None
    edges: int | None = None
    ids: tuple[int, int] | None = None

    @property
    def sparse(self) -> bool:
        """Whether a vertex has at most about two neighbours in each bucket, so that summing by vertex inside buckets saves little."""
        return self.hubs is None and self.vertices is not None and self.size <= 2 * self.vertices * self.buckets

    @property
    def votes_within(self) -> tuple[int, int] | None:
        """The greatest id and the bits of the range of ids, if the number of all votes fits above these bits in a long."""
        if not self.ids or self.edges is None:
            return None
        bits = (self.ids[1] - self.ids[0]).bit_length()
        return (self.ids[1], bits) if bits + (2 * self.edges).bit_length() <= 63 else None


@dataclass(frozen=True)
class Graph:
    """vertices (id); edges (src, dst[, weight]) in the directions they can be walked.

    An undirected graph holds each edge both ways; Graph.of does that.  Parallel
    edges and self-loops are kept.
    """

    vertices: DataFrame
    edges: DataFrame
    directed: bool = True
    name: str = "graph"
    adjacency: Adjacency | None = None

    @property
    def weighted(self) -> bool:
        return "weight" in self.edges.columns

    @staticmethod
    def of(vertices: DataFrame, edges: DataFrame, directed: bool = True, name: str = "graph") -> "Graph":
        """Graph from raw tables: columns cast to the schema, undirected edges added in reverse."""
        weight = [F.col("weight").cast("double").alias("weight")] if "weight" in edges.columns else []
        v = vertices.select(F.col("id").cast("long").alias("id"))
        e = edges.select(F.col("src").cast("long").alias("src"), F.col("dst").cast("long").alias("dst"), *weight)
        return Graph(v, e if directed else symmetrized(e), directed, name)

    def validate(self) -> None:
        """Raises GraphError for null or repeated vertices and for edges whose ends are no vertices."""
        bad = self.vertices.groupBy("id").count().where("id is null or count > 1").limit(1).count()
        if bad:
            raise GraphError("vertex ids must be unique and not null")
        ends = self.edges.select(F.explode(F.array("src", "dst")).alias("id"))
        if ends.join(self.vertices, "id", "left_anti").limit(1).count():
            raise GraphError("an edge ends at no vertex")


def symmetrized(edges: DataFrame) -> DataFrame:
    """edges and their reverses: a multiset, so a reciprocal pair counts twice."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    return edges.unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *rest))
