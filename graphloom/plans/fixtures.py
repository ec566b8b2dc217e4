"""Graphs derived from the driver's tables, as SQL text that both engines run and as Graph objects."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..model import Graph

FLOW_V = "SELECT p_partkey AS id FROM part"
FLOW_E = """SELECT a.l_partkey AS src, b.l_partkey AS dst, MIN(a.l_extendedprice) AS weight
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_linenumber = a.l_linenumber + 1
WHERE a.l_returnflag = 'R' AND b.l_returnflag = 'R' AND a.l_partkey <> b.l_partkey
GROUP BY a.l_partkey, b.l_partkey"""
USERS_V = "SELECT DISTINCT user_id AS id FROM events"
USERS_E = """SELECT s AS src, d AS dst, MIN(v) AS weight FROM (
  SELECT user_id AS s, value AS v, LEAD(user_id) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS d FROM events) t
WHERE d IS NOT NULL AND s <> d GROUP BY s, d"""
COORDER_E = """SELECT a.l_partkey AS src, b.l_partkey AS dst, MIN(ABS(a.l_extendedprice - b.l_extendedprice)) AS weight
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey
WHERE a.l_partkey < b.l_partkey AND a.l_returnflag = 'R' AND b.l_returnflag = 'R' AND a.l_linestatus = 'O' AND b.l_linestatus = 'O'
GROUP BY a.l_partkey, b.l_partkey"""

#: vertices, edges, directed, tables
FIXTURES = {
    "flow": (FLOW_V, FLOW_E, True, ("part", "lineitem")),
    "users": (USERS_V, USERS_E, True, ("events",)),
    "coorder": (FLOW_V, COORDER_E, False, ("part", "lineitem")),
}


def graph(spark: SparkSession, sf_dir: str, name: str) -> Graph:
    """The named graph over a folder of tables; undirected edges stand both ways."""
    vertices, edges, directed, tables = FIXTURES[name]
    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in tables}
    named = lambda sql: _with_tables(sql, tables)
    return Graph.of(spark.sql(named(vertices), **frames), spark.sql(named(edges), **frames), directed, name)


def _with_tables(sql: str, tables: tuple[str, ...]) -> str:
    for t in tables:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}").replace(f"JOIN {t}", f"JOIN {{{t}}}")
    return sql


def root(g: Graph) -> int:
    """The root that traversals of fixtures start from: the smallest source."""
    return g.edges.agg(F.min("src")).first()[0]


def ctes(name: str) -> str:
    """DuckDB common table expressions v (id) and e (src, dst, weight) of a graph."""
    vertices, edges, directed, _ = FIXTURES[name]
    if directed:
        return f"v AS MATERIALIZED ({vertices}), e AS MATERIALIZED ({edges})"
    return f"v AS MATERIALIZED ({vertices}), e0 AS MATERIALIZED ({edges}), e AS MATERIALIZED (SELECT src, dst, weight FROM e0 UNION ALL SELECT dst, src, weight FROM e0)"
