"""Phrase collocations by hierarchical pair naming (operator 13)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cluster import arrow_bytes, new_path, release, remove
from .textops import _LOWER, string_bytes

LEAST = 30
LONGEST = 4
COVERED = 80  # per cent
TOP = 2000
SALTS = 64  # parts of a language that are ranked apart before their first ones meet
BLOCK_BYTES = 16 << 20
BATCH_BYTES = 32 << 20

_BREAK = np.zeros(256, bool)
_BREAK[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9]] = True

_PAIR = pa.struct([("left", pa.int64()), ("right", pa.int64()), ("n", pa.int64())])
_BLOCKS = "block long, lang string, size long, words array<struct<word:string,n:long>>, seq binary"
_LEVEL = "block long, pairs array<struct<left:long,right:long,n:long>>, seq binary"


class _Tables:
    """Tables in the shared folder; what is needed no more is deleted, shuffle files of jobs that ended with it."""

    def __init__(self, spark):
        self.spark, self.paths = spark, {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        release(self.spark)  # what the job before moved is held by nothing any more
        path = new_path(self.spark, name)
        df.write.option("compression", "zstd").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, df: DataFrame) -> None:
        if id(df) in self.paths:
            remove(self.spark, self.paths.pop(id(df))[1])


def _lists(values: pa.Array) -> pa.Array:
    """One list that holds all the values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _words(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, word starts and ends, and the number of each word's piece, which never falls."""
    data, off = string_bytes(col)
    data = _LOWER[data]
    breaks = _BREAK[data]
    word = ~(breaks | _SPACE[data])
    start, end = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    full = off[:-1] < off[1:]
    first, last = off[:-1][full], off[1:][full] - 1
    start[first] = word[first]
    end[last] = word[last]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    piece = np.searchsorted(np.flatnonzero(breaks), starts) + np.searchsorted(off, starts, side="right")
    return data, starts, ends, piece


def _block(block: int, lang: str, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, piece: np.ndarray) -> pa.RecordBatch:
    """A row of a block's different words with their counts, and its words as numbers from 1 with a 0 between pieces."""
    size = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    inside = np.zeros(int(ends[-1] - starts[0]) + 1, np.int8)
    inside[starts - starts[0]] += 1
    inside[ends - starts[0]] -= 1
    letters = data[starts[0] : ends[-1]][np.cumsum(inside[:-1], dtype=np.int8) > 0]
    told = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters)).dictionary_encode()
    codes = told.indices.to_numpy()
    gap = np.concatenate([[0], np.cumsum(piece[1:] != piece[:-1])])
    seq = np.zeros(len(codes) + int(gap[-1]), np.int32)
    seq[np.arange(len(codes)) + gap] = codes + 1
    counts = np.bincount(codes, minlength=len(told.dictionary)).astype(np.int64)
    words = pa.StructArray.from_arrays([told.dictionary.cast(pa.string()), pa.array(counts)], names=["word", "n"])
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([lang]), pa.array([len(codes)], pa.int64()), _lists(words), pa.array([seq.tobytes()], pa.binary())], names=["block", "lang", "size", "words", "seq"])


def cut(batches, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Blocks of about `limit` bytes of one language's texts; long texts are cut between pieces, which no phrase spans."""
    number = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
    held: dict[str, list[pa.Array]] = {}
    total = 0

    def flush():
        nonlocal number
        for lang in sorted(held):
            data, starts, ends, piece = _words(pa.concat_arrays(held[lang]))
            if not len(starts):
                continue
            edges = np.flatnonzero(piece[1:] != piece[:-1]) + 1  # words that begin a piece
            wanted = np.searchsorted(starts, np.arange(limit, starts[-1] + 1, limit))
            at = np.searchsorted(edges, wanted)
            begins = np.unique(np.concatenate([[0], edges[at[at < len(edges)]]]))
            for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(starts)]):
                yield _block(number, lang, data, starts[a:b], ends[a:b], piece[a:b])
                number += 1
        held.clear()

    for batch in batches:
        text, langs = batch.column("text").cast(pa.large_string()), batch.column("lang").dictionary_encode()
        sizes = np.diff(string_bytes(text)[1])
        code = langs.indices.to_numpy()
        begin = 0
        while begin < len(code):
            upto = begin + max(1, int(np.searchsorted(np.cumsum(sizes[begin:]), limit - total, side="right")))
            for k in np.unique(code[begin:upto]).tolist():
                held.setdefault(langs.dictionary[k].as_py(), []).append(text.take(pa.array(begin + np.flatnonzero(code[begin:upto] == k))))
            total += int(sizes[begin:upto].sum())
            begin = upto
            if total >= limit:
                yield from flush()
                total = 0
    yield from flush()


def _pair(batches) -> Iterator[pa.RecordBatch]:
    """Of blocks (block, names, seq): the pairs of named phrases that stand one after the other, counted, and the block in numbers of these."""
    for batch in batches:
        for i in range(batch.num_rows):
            names = batch.column("names")[i].values
            code, name = (names.field(k).to_numpy(zero_copy_only=False) for k in ("code", "id"))
            seq = np.frombuffer(batch.column("seq")[i].as_buffer(), np.int32)
            ids = np.zeros(int(max(seq.max(initial=0), code.max(initial=0) + 1)) + 1, np.int64)
            ids[code + 1] = name
            known = ids[seq] > 0
            at = np.flatnonzero(known[:-1] & known[1:])
            local, place = np.unique(ids, return_inverse=True)  # pairs in the order of their names, which packs well
            place = place[seq]
            key, inverse, n = np.unique(place[at] * len(local) + place[at + 1], return_inverse=True, return_counts=True)
            gap = np.concatenate([[0], np.cumsum(np.diff(at) != 1)]) if len(at) else at
            out = np.zeros(len(at) + int(gap[-1]) if len(at) else 0, np.int32)
            out[np.arange(len(at)) + gap] = inverse + 1
            pairs = pa.StructArray.from_arrays([pa.array(local[key // len(local)]), pa.array(local[key % len(local)]), pa.array(n.astype(np.int64))], fields=list(_PAIR))
            yield pa.RecordBatch.from_arrays([batch.column("block").slice(i, 1), _lists(pairs), pa.array([out.tobytes()], pa.binary())], names=["block", "pairs", "seq"])


def _named(entries: DataFrame, keys: list[str], least: int, tables: _Tables) -> DataFrame:
    """Entries (block, code, keys, n) of keys that occur `least` times or more, with their f and id, as a table.

    All entries of a key meet in one place, once: their sum, the choice and the name need no further shuffle.  An entry is a
    block's different phrase, so a phrase that stands everywhere is one row per block, which windows spill.
    `first` marks one entry of each key, which alone tells the key and f.
    """
    key = Window.partitionBy(*keys)
    frequent = entries.withColumn("f", F.sum("n").over(key)).where(F.col("f") >= least).withColumn("at", F.monotonically_increasing_id() + 1)
    frequent = frequent.withColumn("id", F.min("at").over(key)).withColumn("first", F.col("id") == F.col("at"))
    once = [F.when(F.col("first"), F.col(c)).alias(c) for c in [*keys, "f"]]
    return tables.write(frequent.select("block", "code", "id", "first", *once), "named")


def _entries(table: DataFrame, items: str, keys: list[str]) -> DataFrame:
    rows = table.select("block", *[c for c in keys if c in table.columns], F.posexplode(items).alias("code", "x"))
    return rows.select("block", "code", *[F.col(c) if c in table.columns else F.col(f"x.{c}").alias(c) for c in keys], "x.n")


def _next_level(table: DataFrame, named: DataFrame, tables: _Tables) -> DataFrame:
    """Pairs of named phrases that follow each other, by block."""
    names = named.groupBy("block").agg(F.collect_list(F.struct("code", "id")).alias("names"))
    with arrow_bytes(table.sparkSession, BATCH_BYTES):
        return tables.write(table.select("block", "seq").join(names, "block").select("block", "names", "seq").mapInArrow(_pair, _LEVEL), "pairs")


def _grown(pairs: DataFrame, parents: DataFrame) -> DataFrame:
    """Pairs (left, right, f, id) with lang, phrase, last word and the counts of all their heads and tails, from their parents'."""
    left = parents.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("head"), "heads")
    right = parents.select(F.col("id").alias("right"), "last", "tails")
    both = pairs.join(left, "left").join(right, "right")
    return both.select(
        "id", "left", "right", "f", "lang", "last", F.concat_ws(" ", "head", "last").alias("phrase"),
        F.concat("heads", F.array("f")).alias("heads"), F.concat("tails", F.array("f")).alias("tails"),
    )


def _exact(x: Column) -> Column:
    return x.cast("decimal(20,0)")


def _weakest_cut(k: int) -> Column:
    """Struct (score, k, l, r) of the cut of a k-word phrase with the lowest score, of equals the first."""
    cuts = []
    for j in range(1, k):
        l, r = F.col("heads")[j - 1], F.col("tails")[k - j - 1]
        score = F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * _exact(F.col("f")), _exact(l) + _exact(r))
        cuts.append(F.struct(score.alias("score"), F.lit(j).alias("k"), l.alias("l"), r.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's phrases of 2 to `longest` words that stand together most firmly.

    A-Z are lower-cased, texts split into pieces at . , ; : ! ? and line ends, pieces into words at spaces and tabs; all is
    counted per lang.  Words that occur `least` times get ids; then, level by level, two overlapping phrases of k - 1 words that
    follow each other are a pair of ids, and pairs that occur `least` times are named by ids of their own.  A phrase of k words
    can only be frequent if both its parents are, so nothing is missed.  The pair is also the pointer to the parents: a
    phrase's heads and tails, whose counts tell the score of each cut, come down the left and the right parents, and since
    every longer phrase that holds a phrase holds one a word longer with at least its own count, it is enough to see whether a
    child has `covered` per cent of the phrase's count, which drops the phrase.

    Texts become numbers by blocks of 16 MB; a block's different phrases are counted in it, so what goes over the network per level is
    each of them once with its count, the names of frequent ones back to the block, and the block's numbers.  Null texts are empty, a null lang is
    'und', like the lang of that name; repeated rows count each time; texts of any length count whole; an empty table and
    languages without frequent phrases give no rows.  Ties go by score, a and then the phrase's bytes; other columns are ignored.
    """
    tables = _Tables(docs.sparkSession)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    with arrow_bytes(docs.sparkSession, BATCH_BYTES):
        table = tables.write(texts.mapInArrow(cut, _BLOCKS), "blocks")
    sizes = tables.write(table.groupBy("lang").agg(F.sum("size").alias("n")).hint("rebalance"), "sizes")
    named = _named(_entries(table, "words", ["lang", "word"]), ["lang", "word"], least, tables)
    first = named.where("first")
    known = first.select("id", "lang", "f", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("f").alias("heads"), F.array("f").alias("tails"))
    known = tables.write(known.hint("rebalance"), "phrases")
    levels: list[DataFrame] = []
    for _ in range(2, longest + 1):
        last, table = (table, named), _next_level(table, named, tables)
        for old in last:
            tables.drop(old)
        if table.isEmpty() and levels:  # no two named phrases follow each other: nothing longer is frequent
            break
        named = _named(_entries(table, "pairs", ["left", "right"]), ["left", "right"], least, tables)
        known = tables.write(_grown(named.where("first").select("id", "left", "right", "f"), known).hint("rebalance"), "phrases")
        levels.append(known)
    for old in (table, named):
        tables.drop(old)
    found = None
    for i, level in enumerate(levels):
        rows = level.withColumn("cut", _weakest_cut(i + 2))
        if i + 1 < len(levels):
            longer = levels[i + 1]
            cover = longer.select(F.inline(F.array(F.struct(F.col("left").alias("id"), F.col("f").alias("most")), F.struct(F.col("right").alias("id"), F.col("f").alias("most"))))).groupBy("id").agg(F.max("most").alias("most"))
            rows = rows.join(cover, "id", "left").where(F.col("most").isNull() | (100 * _exact(F.col("most")) < covered * _exact(F.col("f"))))
        rows = rows.select("lang", "phrase", F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")
        found = rows if found is None else found.unionAll(rows)
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    return _first(_first(found.withColumn("salt", salt), ["lang", "salt"], top).drop("rank", "salt"), ["lang"], top).join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _first(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
g AS MATERIALIZED (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS k)) GROUP BY ALL HAVING count(*) >= 30),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM g WHERE k > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, j, x.f AS l, y.f AS r, 2000000::HUGEINT * c.a // (x.f::HUGEINT + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c JOIN g x ON x.lang = c.lang AND x.phrase = array_to_string(w[:j], ' ') JOIN g y ON y.lang = c.lang AND y.phrase = array_to_string(w[j + 1:], ' ')),
low AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT lang, a, w, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)) GROUP BY ALL),
left_over AS (SELECT low.* FROM low LEFT JOIN inside i USING (lang, phrase) WHERE i.most IS NULL OR 100 * i.most::HUGEINT < 80 * low.a::HUGEINT),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
