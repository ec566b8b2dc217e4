"""Mixing sources to target weights by weighted fair queueing (operator 9, DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .cluster import staged, width

WEIGHTS = (5, 2, 1)
REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"


def running_sums(df: DataFrame, order: list[Column], values: dict[str, Column]) -> DataFrame:
    """df with inclusive running sums in a total order, without one task that sees all rows.

    Rows are range-partitioned and summed inside each partition; the partitions'
    own totals (one row each) give the offsets.
    """
    ranged = staged(df.repartitionByRange(width(df.sparkSession), *order).withColumn("_p", F.spark_partition_id()), "ranged")
    inside = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = ranged.groupBy("_p").agg(*[F.sum(v).alias(f"_t_{k}") for k, v in values.items()])
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_p", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}") for k in values])
    # one row per partition: as many as spark.sql.shuffle.partitions at most
    out = ranged.select("*", *[F.sum(v).over(inside).alias(k) for k, v in values.items()]).join(F.broadcast(offsets), "_p")
    return out.withColumns({k: F.col(k) + F.col(f"_o_{k}") for k in values}).drop("_p", *[f"_o_{k}" for k in values])


def source_targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, start, target): weights repeat over the sources by code point, null last.

    Targets share the total by weight; none is above `repeats` times its source's size,
    and what is cut is shared again by weight.  start: words of the sources before it.
    """
    by_name = [F.col("source").asc_nulls_last()]
    ranked = running_sums(totals, by_name, {"rank": F.lit(1), "upto": F.col("source_size")})
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.select("source", "source_size", (F.col("upto") - F.col("source_size")).alias("start"), cycle.alias("weight"))
    filled = staged(
        running_sums(ranked.withColumn("ratio", F.col("source_size") / F.col("weight")), [F.col("ratio"), *by_name], {"s_upto": F.col("source_size"), "w_upto": F.col("weight")}),
        "sources",
    )
    total, heavy = filled.agg(F.sum("source_size"), F.sum("weight")).first()
    if not total:
        return filled.select("source", "source_size", "start", F.lit(0.0).alias("target"))
    level = (F.lit(float(total)) - repeats * (F.col("s_upto") - F.col("source_size"))) / (F.lit(float(heavy)) - (F.col("w_upto") - F.col("weight")))
    filled = filled.withColumn("full", level * F.col("weight") > repeats * F.col("source_size"))
    used, gone = filled.agg(F.coalesce(F.sum(F.when(F.col("full"), F.col("source_size"))), F.lit(0)), F.coalesce(F.sum(F.when(F.col("full"), F.col("weight"))), F.lit(0.0))).first()
    rest = (float(total) - repeats * float(used)) / (float(heavy) - float(gone)) if heavy > gone else 0.0
    target = F.when(F.col("full"), repeats * F.col("source_size").cast("double")).otherwise(F.lit(rest) * F.col("weight"))
    return filled.select("source", "source_size", "start", target.alias("target"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS, row: str | None = None) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, finish) of every row, and its column `row`, a number, if one is named.

    size is the number of words; the documents of a source are shuffled by MD5 of their id and
    queued, up to `repeats` times over.  A copy's virtual finish time is the source's
    words up to it divided by the source's target; copies are range-sorted by finish time and the
    queue ends where the budget, the words of all documents, is used up.  taken counts
    the words of a document's copies inside the budget; finish is the first copy's time.

    Null texts have size 0.  A null source is a source.  Rows with equal or null ids
    each count for themselves, in an order given by (MD5, id, size, hash of the text).  Texts of any length are counted whole.  An empty table gives
    no rows; if all sizes are 0, targets and taken are 0.  Other columns are ignored.
    """
    own = [] if row is None else [row]
    key = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 15), 16, 10).cast("long")
    sized = docs.select(*own, F.xxhash64("text").alias("hash"), F.col("doc_id").cast("long").alias("doc_id"), "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")).withColumn("key", key)
    sized = staged(sized, "sized")
    targets = staged(source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, repeats), "targets")
    order = [F.col("source").asc_nulls_last(), F.col("key").asc(), F.col("doc_id").asc_nulls_first(), F.col("size").asc(), F.col("hash").asc()]
    queued = running_sums(sized, order, {"rank": F.lit(1), "upto": F.col("size")})
    t = targets.withColumnRenamed("source", "_source")
    queued = queued.join(t, queued.source.eqNullSafe(t._source)).drop("_source")
    copies = queued.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    finish = F.when(F.col("target") > 0, (F.col("copy") * F.col("source_size") + F.col("upto") - F.col("start")) / F.col("target")).otherwise(F.lit(0.0))
    copies = copies.select("rank", *own, "doc_id", "source", "size", "source_size", "target", "copy", finish.alias("finish"))
    budget = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    sent = running_sums(copies, [F.col("finish"), F.col("rank"), F.col("copy")], {"sent": F.col("size")})
    return sent.groupBy("rank", *own, "doc_id", "source", "size", "source_size", "target").agg(
        F.sum(F.when(F.col("sent") <= budget, F.col("size")).otherwise(0)).alias("taken"), F.min("finish").alias("finish")
    ).drop("rank")


def taken_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """The rows of docs that the mix takes, with all their columns and size, source_size, target, taken and finish (of that name they are replaced)."""
    row = "_row"
    while row in docs.columns:
        row += "_"
    rows = staged(docs.withColumn(row, F.monotonically_increasing_id()), "rows")  # written, so that a row keeps its number
    more = ["size", "source_size", "target", "taken", "finish"]
    mix = mixed(rows, weights, repeats, row).where("taken > 0").select(row, *more)
    return rows.drop(*more).join(mix, row).drop(row)


def op9_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


def mix_sql(docs: str) -> str:
    """DuckDB SQL for op9_mix_sources over a relation with doc_id, source and text."""
    return rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key FROM {docs}),
ranked AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rn
  FROM sized GROUP BY source),
weighted AS (SELECT *, [5.0, 2.0, 1.0][((rn - 1) % 3 + 1)::INT]::DOUBLE AS weight FROM ranked),
level AS (
  SELECT *, sum(source_size) OVER () AS z, sum(weight) OVER () AS w,
         sum(source_size) OVER o - source_size AS s0, sum(weight) OVER o - weight AS w0
  FROM weighted WINDOW o AS (ORDER BY source_size / weight, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING)),
capped AS (SELECT *, (z::DOUBLE - 3 * s0::DOUBLE) / (w - w0) * weight > 3 * source_size AS is_full FROM level),
rest AS (
  SELECT (max(z)::DOUBLE - 3 * coalesce(sum(source_size) FILTER (is_full), 0)::DOUBLE)
         / nullif(max(w) - coalesce(sum(weight) FILTER (is_full), 0), 0) AS fair FROM capped),
targets AS (
  SELECT source, source_size, CASE WHEN z = 0 THEN 0.0 WHEN is_full THEN 3.0 * source_size::DOUBLE ELSE fair * weight END::DOUBLE AS target
  FROM capped, rest),
queued AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         row_number() OVER (ORDER BY s.source ASC NULLS LAST, key, s.doc_id ASC NULLS FIRST, size) AS rank,
         sum(size) OVER (PARTITION BY s.source ORDER BY key, s.doc_id ASC NULLS FIRST, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT *, CASE WHEN target > 0 THEN (copy * source_size + upto)::DOUBLE / target ELSE 0.0 END AS finish
  FROM queued, (SELECT unnest([0, 1, 2]) AS copy)),
sent AS (
  SELECT *, sum(size) OVER (ORDER BY finish, rank, copy ROWS UNBOUNDED PRECEDING) AS sent, (SELECT sum(size) FROM sized) AS budget FROM copies)
SELECT doc_id, size, source_size, target, sum(CASE WHEN sent <= budget THEN size ELSE 0 END)::BIGINT AS taken
FROM sent GROUP BY rank, doc_id, size, source_size, target
"""


OP9_SQL = mix_sql("documents")
