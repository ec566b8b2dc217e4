"""Text and Parquet sources and sinks of graphs and results."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.formatting import result_lines
from ..model import EDGE_SCHEMA, VERTEX_SCHEMA, WEIGHTED_EDGE_SCHEMA, Adjacency, Graph, GraphError
from ..operators.iterate import HUB, partitions_for, salted, salts_of
from ..storage import bucketed, bucketed_at, get_json, put_json, remove, written


def _columns(spark: SparkSession, path: str, sep: str, schema: StructType) -> DataFrame:
    """Leading columns of a separated text file by position; further columns are ignored, blank lines skipped."""
    parts = F.split(F.trim("value"), f"{re.escape(sep)}+")

    def column(i: int, name: str, kind: str) -> Column:
        piece = F.get(parts, F.lit(i))
        bad = F.raise_error(F.concat(F.lit(f"column {name} is no {kind}: "), F.col("value")))
        return F.coalesce(piece.try_cast(kind), bad.cast(kind)).alias(name)

    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(*[column(i, f.name, f.dataType.simpleString()) for i, f in enumerate(schema)])


def read_vertices(spark: SparkSession, path: str, sep: str = " ") -> DataFrame:
    """Vertex file without header: the id in the first column; a value that is no number fails the read."""
    return _columns(spark, path, sep, VERTEX_SCHEMA)


def read_edges(spark: SparkSession, path: str, weighted: bool = False, sep: str = " ") -> DataFrame:
    """Edge file without header: source, target and, if weighted, weight; a value that is no number fails the read."""
    return _columns(spark, path, sep, WEIGHTED_EDGE_SCHEMA if weighted else EDGE_SCHEMA)


def read_text_graph(spark: SparkSession, vertices: str, edges: str, directed: bool = True, weighted: bool = False, name: str = "graph") -> Graph:
    return Graph.of(read_vertices(spark, vertices), read_edges(spark, edges, weighted), directed, name)


ADJACENCY = "id long, other long, forth long, back long, weight double, share double"


def adjacency_rows(graph: Graph, buckets: int | None = None) -> DataFrame:
    """Each vertex with each of its neighbours once, and each vertex alone (other is null); see Adjacency.

    With `buckets` the ends of edges move to their vertex's bucket once, where they are summed and degrees are taken; hubs, which
    would make a bucket heavy, need the form without.
    """
    weight = F.col("weight") if graph.weighted else F.lit(None).cast("double").alias("weight")
    none, zero, one = F.lit(None), F.lit(0).cast("long"), F.lit(1).cast("long")
    forth = graph.edges.select(F.col("src").alias("id"), F.col("dst").alias("other"), one.alias("forth"), zero.alias("back"), weight)
    back = graph.edges.select("dst", "src", zero, one, none.cast("double"))
    own = graph.vertices.select("id", none.cast("long"), zero, zero, none.cast("double"))
    rows = forth.unionAll(back).unionAll(own)
    rows = rows.repartition(buckets, "id") if buckets else rows
    rows = rows.groupBy("id", "other").agg(F.sum("forth").alias("forth"), F.sum("back").alias("back"), F.min("weight").alias("weight"))
    if buckets:
        rows = rows.withColumn("degree", F.sum("forth").over(Window.partitionBy("id")))
    else:
        rows = rows.join(graph.edges.groupBy(F.col("src").alias("id")).agg(F.count("*").alias("degree")), "id", "left")
    return rows.select("id", "other", "forth", "back", "weight", F.when(F.col("forth") > 0, F.col("forth") / F.col("degree")).alias("share"))


def convert(graph: Graph, path: str, hub: int = HUB) -> Graph:
    """Writes the loaded form over what was there, and returns it as read from there.

    Edges lie in ranges of (source, target), so a vertex with many edges may stretch over several files.  The adjacency in both
    directions is a table bucketed by id (of hubs by salt too) and sorted, in which later runs find each vertex's neighbours without a shuffle.
    """
    spark = graph.vertices.sparkSession
    for part in ("adjacency.json", "vertices", "edges", "hubs", "adjacency"):
        remove(spark, f"{path}/{part}")
    vertices, v = written(graph.vertices, f"{path}/vertices", n=F.count("*"), least=F.min("id"), most=F.max("id"))
    edges, e = written(graph.edges.repartitionByRange("src", "dst").sortWithinPartitions("src", "dst"), f"{path}/edges", n=F.count("*"))
    most = v["n"] + 2 * e["n"]  # rows of the adjacency, unless edges are parallel or reciprocal
    buckets = partitions_for(spark, most)
    ends = edges.select(F.explode(F.array("src", "dst")).alias("id"))
    hubs = salts_of(ends, "id", most, buckets, hub, f"{path}/hubs")
    table = f"adjacency_{uuid.uuid4().hex}"
    by, order = (["id"], ["id", "other"]) if hubs is None else (["id", "salt"], ["id", "salt", "other"])
    rows = adjacency_rows(Graph(vertices, edges, graph.directed, graph.name), buckets if hubs is None else None)
    seen = Observation()
    bucketed((rows if hubs is None else salted(rows, "id", hubs)).observe(seen, F.count("*").alias("size")), f"{path}/adjacency", table, buckets, by, order)
    put_json(spark, f"{path}/adjacency.json", {"table": table, "buckets": buckets, "size": seen.get["size"], "vertices": v["n"], "edges": e["n"], "ids": [v["least"], v["most"]] if v["n"] else None, "hubs": hubs is not None, "directed": graph.directed})
    return read_converted(spark, path, graph.directed, graph.name)


def read_converted(spark: SparkSession, path: str, directed: bool = True, name: str = "graph") -> Graph:
    """A converted graph: edges already stand in all directions they can be walked.  This session, too, then knows the adjacency as a table."""
    said = get_json(spark, f"{path}/adjacency.json")
    at = None
    if said:
        hubs = spark.read.parquet(f"{path}/hubs") if said["hubs"] else None
        by, order, more = (["id", "salt"], ["id", "salt", "other"], ", salt int") if said["hubs"] else (["id"], ["id", "other"], "")
        at = Adjacency(bucketed_at(spark, f"{path}/adjacency", said["table"], ADJACENCY + more, said["buckets"], by, order), said["buckets"], said["size"], hubs, said.get("vertices"), said.get("edges"), said.get("ids"))
    return Graph(spark.read.parquet(f"{path}/vertices"), spark.read.parquet(f"{path}/edges"), directed, name, at)


def write_text_graph(graph: Graph, path: str) -> tuple[str, str]:
    """Writes `<id>` and `<src> <dst>[ <weight>]` lines into two folders and returns their paths."""
    graph.vertices.select(F.col("id").cast("string")).write.mode("overwrite").text(f"{path}/vertices")
    names = ["src", "dst", *(["weight"] if graph.weighted else [])]
    graph.edges.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in names])).write.mode("overwrite").text(f"{path}/edges")
    return f"{path}/vertices", f"{path}/edges"


def write_result(result: DataFrame, value: str, path: str | None) -> bool:
    """Writes `<id> <value>` lines; False, and nothing written, without a path."""
    if not path:
        return False
    result_lines(result, value).select("line").write.mode("overwrite").text(path)
    return True


def delete_converted(spark: SparkSession, path: str, name: str) -> bool:
    """Deletes a converted graph; refused unless the path holds the graph's name."""
    if not name or name not in path:
        raise GraphError(f"{path} isn't the folder of graph {name!r}")
    if said := get_json(spark, f"{path}/adjacency.json"):
        spark.sql(f"DROP TABLE IF EXISTS {said['table']}")
    return remove(spark, path)
