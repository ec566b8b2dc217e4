"""Incremental removal of repeated 13-word passages (operator 5).

A log-structured index keeps the window hashes of all earlier batches as sorted,
immutable runs in one bucketed table, so that history is read where it lies and only a new batch moves.
The batch is merge-joined with the runs bucket by bucket, matches are verified on the words themselves, and the
batch's own windows become a new run; runs are compacted when there are several.

Windows are stored in groups: all windows that share the smallest 5-word hash at one
place (their anchor) stand together, so an entry's anchor, document and position are
written once for about five windows.  Equal windows have equal anchors, so groups with
an anchor of their own need no closer look.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cluster import new_path, release, remove, staged, width
from .textops import chunks, fmix64, joined, split_words, window_hashes, word_hashes

WINDOW, GRAM = 13, 5
WIN_BYTES = 5
BATCH_BYTES = 8 << 20  # text of one map batch
BUCKET_BYTES = 2 << 20  # text whose windows one bucket gets, on average
HOT_LEAST, HOT_MOST = 20_000, 1_000_000
MAX_RUNS = 4  # of an index that grows on; the query's own compacts sooner
ASKS = 10_000  # passages of one document that one task hashes, at most
_ROW = "bucket int, kind int, n int, anchor binary, doc binary, pos binary, cnt binary, wins binary"


@dataclass
class Groups:
    """Windows by anchor: per group the anchor's hash, document, first position and number of windows; per window its hash."""

    anchor: np.ndarray
    doc: np.ndarray
    pos: np.ndarray
    cnt: np.ndarray
    wins: np.ndarray

    @staticmethod
    def joined(parts: list["Groups"]) -> "Groups":
        if len(parts) == 1:
            return parts[0]
        return Groups(*[np.concatenate([getattr(p, k) for p in parts]) for k in ("anchor", "doc", "pos", "cnt", "wins")])

    @property
    def first(self) -> np.ndarray:
        return np.cumsum(self.cnt) - self.cnt

    def take(self, index: np.ndarray) -> "Groups":
        cnt = self.cnt[index]
        at = np.repeat(self.first[index] - (np.cumsum(cnt) - cnt), cnt) + np.arange(int(cnt.sum()))
        return Groups(self.anchor[index], self.doc[index], self.pos[index], cnt, self.wins[at])

    def cut(self, keep: np.ndarray) -> "Groups":
        """Only the windows that `keep` marks, as groups of windows that still stand side by side."""
        own = np.repeat(np.arange(len(self.cnt)), self.cnt)
        within = np.arange(len(own)) - self.first[own]
        at = np.flatnonzero(keep)
        if not len(at):
            return self.take(at)
        new = np.concatenate([[True], (np.diff(at) != 1) | (own[at][1:] != own[at][:-1])])
        head = at[new]
        cnt = np.diff(np.append(np.flatnonzero(new), len(at)))
        return Groups(self.anchor[own[head]], self.doc[own[head]], self.pos[own[head]] + within[head], cnt, self.wins[at])


def _planes(x: np.ndarray, size: int) -> bytes:
    """The low bytes of the numbers, all first bytes before all second ones: equal high bytes then compress away."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize)[:, :size].T).tobytes()


def _numbers(raw: bytes, n: int, size: int, dtype) -> np.ndarray:
    out = np.zeros((n, np.dtype(dtype).itemsize), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(size, n).T
    return out.view(dtype).reshape(n)


def _packed(bucket: int, kind: int, g: Groups) -> tuple:
    cnt = g.cnt.astype(np.uint8)
    return (bucket, kind, len(cnt), _planes(g.anchor, 8), _planes(g.doc, 8), _planes(g.pos, 8), cnt.tobytes(), _planes(g.wins, WIN_BYTES))


def _unpacked(r: dict) -> Groups:
    n, cnt = r["n"], np.frombuffer(r["cnt"], np.uint8).astype(np.int64)
    return Groups(_numbers(r["anchor"], n, 8, np.uint64), _numbers(r["doc"], n, 8, np.int64), _numbers(r["pos"], n, 8, np.int64), cnt, _numbers(r["wins"], int(cnt.sum()), WIN_BYTES, np.uint64))


_NAMES = ["bucket", "kind", "n", "anchor", "doc", "pos", "cnt", "wins"]
_TYPES = pa.schema(list(zip(_NAMES, [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 5])))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 8, _TYPES.types)], schema=_TYPES)


def groups_of(batch: pa.RecordBatch) -> Groups:
    """All windows of some documents (doc_id, piece, text)."""
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
    piece = batch.column("piece").to_numpy(zero_copy_only=False)
    w = split_words(batch.column("text"))
    at, doc = w.window_starts(WINDOW)
    if not len(at):
        none = np.zeros(0, np.int64)
        return Groups(none.astype(np.uint64), none, none, none, none.astype(np.uint64))
    h = word_hashes(w)
    grams = window_hashes(h, np.arange(len(h) - GRAM + 1), GRAM)
    low, off = grams[at], np.zeros(len(at), np.int64)
    for o in range(1, WINDOW - GRAM + 1):
        x = grams[at + o]
        less = x < low
        low = np.where(less, x, low)
        off[less] = o
    wins = window_hashes(h, at, WINDOW) & np.uint64((1 << 8 * WIN_BYTES) - 1)
    anchor_at = at + off
    head = np.flatnonzero(np.concatenate([[True], (anchor_at[1:] != anchor_at[:-1]) | (doc[1:] != doc[:-1])]))
    cnt = np.diff(np.append(head, len(at)))
    d = doc[head]
    return Groups(low[head], ids[d], (piece[d] << 32) + at[head] - w.first[d], cnt, wins)


def _keys(anchor: np.ndarray, wins: np.ndarray) -> np.ndarray:
    return fmix64(anchor ^ (wins * np.uint64(0x9E3779B97F4A7C15)))


def _claims(g: Groups, old: np.ndarray) -> tuple[np.ndarray, tuple]:
    """Windows whose hash an older entry or a smaller document has, and where that one stands.

    old: per group, whether it comes from an earlier batch.  Only new windows are claimed.
    Returns a mark for each window and (doc, pos, count, source doc, source pos) of runs of them.
    """
    own = np.repeat(np.arange(len(g.cnt)), g.cnt)
    within = np.arange(len(own)) - g.first[own]
    marked = np.zeros(len(own), bool)
    _, back, times = np.unique(g.anchor, return_inverse=True, return_counts=True)
    some = np.flatnonzero(times[back][own] > 1)
    o = own[some]
    key = _keys(g.anchor[o], g.wins[some])
    doc, pos, new = g.doc[o], g.pos[o] + within[some], ~old[o]
    order = np.lexsort((pos, doc, new, key))
    key, o, some = key[order], o[order], some[order]
    doc, pos, new = doc[order], pos[order], new[order]
    head = np.concatenate([[True], key[1:] != key[:-1]]) if len(key) else np.zeros(0, bool)
    lead = np.flatnonzero(head)[np.cumsum(head) - 1]
    hit = new & (doc != doc[lead])
    at = some[hit]
    src, spos, d, p, gr = doc[lead][hit], pos[lead][hit], doc[hit], pos[hit], o[hit]
    marked[at] = True
    back = np.argsort(at)
    at, src, spos, d, p, gr = at[back], src[back], spos[back], d[back], p[back], gr[back]
    if not len(at):
        return marked, (d, p, d, src, spos)
    start = np.concatenate([[True], (np.diff(at) != 1) | (gr[1:] != gr[:-1]) | (src[1:] != src[:-1]) | (np.diff(spos) != 1)])
    n = np.diff(np.append(np.flatnonzero(start), len(at)))
    return marked, (d[start], p[start], n, src[start], spos[start])


def _claim_rows(claims: tuple, buckets: int) -> list[tuple]:
    """Claims packed by document, so that all those of one document meet: kind 1."""
    d, p, n, src, spos = claims
    block = ((fmix64(d.view(np.uint64)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    edges = np.append(np.flatnonzero(np.concatenate([[True], np.diff(block[order]) != 0])), len(order)) if len(order) else [0]
    out = []
    for i, j in zip(edges[:-1], edges[1:]):
        k = order[i:j]
        out.append((int(block[k[0]]), 1, j - i, _planes(src[k], 8), _planes(d[k], 8), _planes(p[k], 8), _planes(n[k], 4), _planes(spos[k], 8)))
    return out


def _by_bucket(g: Groups, buckets: int, hot: np.ndarray) -> list[tuple]:
    """Rows of kind 0, one per bucket: by anchor, but windows of hot anchors each by their own hash."""
    if len(hot) and len(g.anchor):
        is_hot = hot[np.minimum(np.searchsorted(hot, g.anchor), len(hot) - 1)] == g.anchor
        if is_hot.any():
            far = g.take(np.flatnonzero(is_hot))
            own = np.repeat(np.arange(len(far.cnt)), far.cnt)
            alone = Groups(far.anchor[own], far.doc[own], far.pos[own] + np.arange(len(own)) - far.first[own], np.ones(len(own), np.int64), far.wins)
            near = g.take(np.flatnonzero(~is_hot))
            return _dealt(near, near.anchor, buckets) + _dealt(alone, fmix64(alone.wins ^ alone.anchor), buckets)
    return _dealt(g, g.anchor, buckets)


def _dealt(g: Groups, by: np.ndarray, buckets: int) -> list[tuple]:
    if not len(by):
        return []
    bucket = ((by >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.lexsort((g.anchor, bucket))
    g, bucket = g.take(order), bucket[order]
    edges = np.append(np.flatnonzero(np.concatenate([[True], np.diff(bucket) != 0])), len(bucket))
    return [_packed(int(bucket[i]), 0, g.take(np.arange(i, j))) for i, j in zip(edges[:-1], edges[1:])]


def _super(batches):
    """Groups of about BATCH_BYTES of text."""
    for batch in batches:
        for part in chunks(batch, "text", BATCH_BYTES):
            yield Groups.joined([groups_of(c) for c in chunks(part, "text")])


def _map(buckets: int, hot: np.ndarray):
    def run(batches):
        for g in _super(batches):
            marked, claims = _claims(g, np.zeros(len(g.cnt), bool))
            yield _rows(_by_bucket(g.cut(~marked), buckets, hot) + _claim_rows(claims, buckets))

    return run


def _frequent(least: int):
    """Anchors seen at least `least` times in a partition, with that count."""

    def run(batches):
        known, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for g in _super(batches):
            known, back = np.unique(np.concatenate([known, g.anchor]), return_inverse=True)
            times = np.bincount(back, np.concatenate([times, np.ones(len(g.anchor), np.int64)]), len(known)).astype(np.int64)
        often = times >= least
        yield pa.RecordBatch.from_arrays([pa.array(known[often].view(np.int64)), pa.array(times[often])], names=["anchor", "n"])

    return run


def _matching(run: Groups, anchors: np.ndarray) -> Groups:
    """The groups of a run, which lies in the order of its anchors, whose anchors are among the given ones, in order too."""
    if not len(anchors):
        return run.take(np.zeros(0, np.int64))
    at = np.minimum(np.searchsorted(anchors, run.anchor), len(anchors) - 1)
    return run.take(np.flatnonzero(anchors[at] == run.anchor))


def _merge(keep_run: bool, buckets: int):
    """Per bucket: a batch's rows (kind 0) against those of earlier runs (kind 2); claims made already (kind 1) pass."""

    def run(new: pa.Table, runs: pa.Table) -> pa.Table:
        rows = new.to_pylist()
        out = [tuple(r[k] for k in _NAMES) for r in rows if r["kind"] == 1]
        parts = [_unpacked(r) for r in rows if r["kind"] == 0 and r["n"]]
        if parts:
            fresh = Groups.joined(parts)
            anchors = np.unique(fresh.anchor)
            olds = [_matching(_unpacked(r), anchors) for r in runs.to_pylist()]
            g = Groups.joined([fresh, *olds])
            old = np.arange(len(g.cnt)) >= len(fresh.cnt)
            marked, claims = _claims(g, old)
            out += _claim_rows(claims, buckets)
            if keep_run:
                own = np.repeat(np.arange(len(g.cnt)), g.cnt)
                left = g.cut(~marked & ~old[own])
                if len(left.cnt):
                    out.append(_packed(rows[0]["bucket"], 2, left.take(np.argsort(left.anchor, kind="stable"))))
        return pa.Table.from_batches([_rows(out)])

    return run


def _compacted(table: pa.Table) -> pa.Table:
    """The rows of one bucket as one, in the order of the anchors."""
    g = Groups.joined([_unpacked(r) for r in table.to_pylist()])
    return pa.Table.from_batches([_rows([_packed(table["bucket"][0].as_py(), 2, g.take(np.argsort(g.anchor, kind="stable")))])])


def _segments(table: pa.Table) -> pa.Table:
    """Claims of some documents, neighbours that continue each other as one."""
    rows = table.to_pylist()
    cols = [np.concatenate([_numbers(r[k], r["n"], s, t) for r in rows]) for k, s, t in (("doc", 8, np.int64), ("pos", 8, np.int64), ("cnt", 4, np.int64), ("anchor", 8, np.int64), ("wins", 8, np.int64))]
    order = np.lexsort((cols[1], cols[0]))
    d, p, n, src, spos = [c[order] for c in cols]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (p[1:] != p[:-1] + n[:-1]) | (src[1:] != src[:-1]) | (spos[1:] != spos[:-1] + n[:-1])])
    total = np.add.reduceat(n, np.flatnonzero(new))
    return pa.table({"doc": d[new], "pos": p[new], "words": total + WINDOW - 1, "src": src[new], "spos": spos[new]})


@dataclass
class WindowIndex:
    """Runs of window hashes in one bucketed table in the shared folder; `buckets` is fixed when the index is made."""

    spark: SparkSession
    buckets: int
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    table: str = field(default_factory=lambda: f"window_runs_{uuid.uuid4().hex}")
    most_runs: int = MAX_RUNS
    runs: int = 0  # runs in the table now
    made: int = 0  # batches and compactions so far
    paths: list[str] = field(default_factory=list)

    @classmethod
    def sized_for(cls, docs: DataFrame) -> "WindowIndex":
        """An empty index for about as much text as docs holds, whose hot anchors (2 * HOT_MOST at most, 16 MB) are dealt out by window.

        A task leaves out anchors it sees less than a 2 * tasks-th of the limit, which is less than half of the
        limit in all tasks together; so what is counted half as often as the limit holds all anchors above it.
        """
        size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
        index = cls(docs.sparkSession, max(1, -(-size // BUCKET_BYTES)))
        least = max(HOT_LEAST, size // 30 // HOT_MOST)  # an anchor for every 30 bytes at most
        rows = _pieces(docs, False)
        often = rows.mapInArrow(_frequent(-(-least // (2 * max(1, rows.rdd.getNumPartitions())))), "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") >= least / 2)
        index.hot = np.sort(np.array([r.anchor for r in often.select("anchor").collect()], np.int64).view(np.uint64))
        return index

    def _save(self, rows: DataFrame) -> int:
        """Adds rows to the table, bucketed as they were dealt; returns their number in it."""
        if not self.paths:
            self.paths.append(new_path(self.spark, self.table))
            self.files = width(self.spark)
        self.made += 1
        rows.withColumn("part", F.lit(self.made)).write.option("compression", "zstd").option("path", self.paths[-1]).mode("append").partitionBy("part", "kind").bucketBy(self.files, "bucket").sortBy("bucket").saveAsTable(self.table)
        return self.made

    def _rows(self, kind: int) -> DataFrame:
        return self.spark.table(self.table).where(F.col("kind") == kind)

    def add(self, docs: DataFrame, pieces: bool = False, keep: bool = True) -> DataFrame:
        """Adds a batch and returns its claims (doc, pos, words, src, spos): `words` words from pos on are as in document src from spos on.

        A window is claimed if an earlier batch, or a smaller document of this one, has its hash.
        keep: whether the batch's windows become a run.
        """
        new = _pieces(docs, pieces).mapInArrow(_map(self.buckets, self.hot), _ROW)
        old = self._rows(2).select(*_NAMES) if self.runs else self.spark.createDataFrame([], _ROW)
        merged = new.groupBy("bucket").cogroup(old.groupBy("bucket")).applyInArrow(_merge(keep, self.buckets), _ROW)
        part = self._save(merged)
        claims = self._rows(1).where(F.col("part") == part).select(*_NAMES)
        segments = staged(claims.groupBy("bucket").applyInArrow(_segments, "doc long, pos long, words long, src long, spos long"), "claims")
        self.runs += keep
        if self.runs > self.most_runs:
            self.compact()
        return segments

    def compact(self) -> None:
        """Merges all runs into one, bucket by bucket, in a new table."""
        rows = self._rows(2).select(*_NAMES).groupBy("bucket").applyInArrow(_compacted, _ROW)
        was, self.table = self.table, f"window_runs_{uuid.uuid4().hex}"
        self.paths.append(new_path(self.spark, self.table))
        self._save(rows)
        self.runs = 1
        self._drop(was, self.paths.pop(0))

    def _drop(self, table: str, path: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove(self.spark, path)

    def close(self) -> None:
        """Deletes the table."""
        for path in self.paths:
            self._drop(self.table, path)
        self.paths, self.runs = [], 0


def _pieces(docs: DataFrame, pieces: bool) -> DataFrame:
    piece = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF))) if pieces else F.lit(0)
    return docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), piece.cast("long").alias("piece"), "text")


def _kept(batches):
    """Words left when claimed passages go, and digests of the passages that were asked for."""
    for batch in batches:
        for part in chunks(batch, "text"):
            w = split_words(part.column("text"))
            text, starts, ends = joined(w)
            out: list[list] = [[], [], [], [], [], []]
            pieces = part.column("piece").to_pylist()
            for i, (doc, first, asked) in enumerate(zip(part.column("doc_id").to_pylist(), part.column("first").to_pylist(), part.column("asked").to_pylist())):
                a, b = int(w.first[i]), int(w.first[i + 1])
                gone, digests = np.zeros(b - a + 1, np.int64), []
                for r in asked or ():
                    if r["pos"] >> 32 != pieces[i]:
                        continue
                    p = r["pos"] & 0xFFFFFFFF
                    if r["own"]:
                        gone[p] += 1
                        gone[p + r["words"]] -= 1
                    if r["digest"]:
                        passage = text[starts[a + p] : ends[a + p + r["words"] - 1]]
                        digests.append({"pos": r["pos"], "words": r["words"], "digest": hashlib.sha256(passage).digest()})
                keep = np.flatnonzero(np.cumsum(gone)[:-1] == 0) + a
                if not first:
                    left = b""
                elif len(keep) == b - a:
                    left = text[starts[a] : ends[b - 1]] if b > a else b""
                else:
                    left = b" ".join([text[x:y] for x, y in zip(starts[keep].tolist(), ends[keep].tolist())])
                for o, x in zip(out, (doc, first, b - a, b - a - len(keep), hashlib.sha256(left).hexdigest(), digests)):
                    o.append(x)
            types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("pos", pa.int64()), ("words", pa.int64()), ("digest", pa.binary())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["doc_id", "first", "n_words", "n_removed", "kept_sha256", "digests"])


_KEPT = "doc_id long, first boolean, n_words long, n_removed long, kept_sha256 string, digests array<struct<pos:bigint,words:bigint,digest:binary>>"


def _applied(docs: DataFrame, own: DataFrame, asks: DataFrame, pieces: bool, digest: bool, all_rows: bool) -> DataFrame:
    """Rows of _kept: own (doc, pos, words) go from the texts, and have digests if wanted; asks (doc, pos, words) have digests.

    A document of many asks is read by several tasks, ASKS of them each; one of its rows is the `first`.
    """
    count = asks.groupBy("doc").agg(F.count("*").alias("n"))
    share = F.when(F.col("n") > ASKS, F.pmod(F.xxhash64("pos", "words"), F.ceil(F.col("n") / ASKS))).otherwise(0)
    dealt = asks.join(count, "doc").select("doc", share.cast("int").alias("share"), "pos", "words", F.lit(False).alias("own"), F.lit(True).alias("digest"))
    some = own.select("doc", F.lit(0).alias("share"), "pos", "words", F.lit(True).alias("own"), F.lit(digest).alias("digest")).unionAll(dealt)
    first = dealt.where("share > 0").select("doc").distinct().select("doc", F.lit(0).alias("share"), *[F.lit(None).cast(t).alias(c) for c, t in (("pos", "long"), ("words", "long"), ("own", "boolean"), ("digest", "boolean"))])
    asked = some.unionAll(first).groupBy(F.col("doc").alias("_id"), "share").agg(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "words", "own", "digest"))).alias("asked"))
    piece = F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)) if pieces else F.lit(0)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), piece.cast("long").alias("piece"), "text")
    rows = rows.join(asked, rows.doc_id == asked._id, "left" if all_rows else "inner").select("doc_id", "piece", "text", (F.coalesce("share", F.lit(0)) == 0).alias("first"), "asked")
    return staged(rows.mapInArrow(_kept, _KEPT), "kept")


def _digests(kept: DataFrame) -> DataFrame:
    return kept.select(F.col("doc_id").alias("doc"), F.explode("digests").alias("x")).select("doc", "x.pos", "x.words", F.col("x.digest").alias("digest")).distinct()


def _like_asked(batches):
    """Windows of each text that have the hash of an asked one."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            g = groups_of(row)
            own = np.repeat(np.arange(len(g.cnt)), g.cnt)
            pos = g.pos[own] + np.arange(len(own)) - g.first[own]
            key = _keys(g.anchor[own], g.wins)
            same = pos[np.isin(key, key[np.isin(pos, row.column("asked")[0].values.to_numpy())])]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(same), row.column("doc_id")[0].as_py()), pa.int64()), pa.array(same, pa.int64())], names=["doc", "pos"])


def _looked_at_again(docs: DataFrame, wrong: DataFrame, pieces: bool) -> DataFrame:
    """(doc, pos, words) of windows of failed claims that a smaller document has all the same.

    Windows with one hash but different words claim the first of them all.  The smallest document of
    each different window is that first one's or fails in its claim, so it is among the failed claims and
    the windows of that hash in their sources: these are compared with each other by SHA-256 of the words.
    """
    at = wrong.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("words") - WINDOW)))
    windows = at.select("doc", (F.col("pos") + F.col("o")).alias("pos"), F.lit(WINDOW).cast("long").alias("words"))
    spots = at.select(F.col("src").alias("_id"), (F.col("spos") + F.col("o")).alias("p")).distinct().groupBy("_id").agg(F.collect_list("p").alias("asked"))  # windows of one text
    piece = F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)) if pieces else F.lit(0)
    texts = docs.join(spots, docs.doc_id == spots._id).select("doc_id", piece.cast("long").alias("piece"), "text", "asked")
    sources = texts.mapInArrow(_like_asked, "doc long, pos long").withColumn("words", F.lit(WINDOW).cast("long"))
    asks = staged(windows.unionAll(sources).distinct(), "asks")
    seen = staged(_digests(_applied(docs, asks.limit(0), asks, pieces, False, False)), "seen")
    low = seen.groupBy("digest").agg(F.min("doc").alias("low"))
    return windows.distinct().join(seen, ["doc", "pos", "words"]).join(low, "digest").where("low < doc").select("doc", "pos", "words")


def without_repeats(docs: DataFrame, batches: int = 3, most_runs: int = 1) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): words in 13-word windows that a smaller document has too are removed.

    Documents enter the index in `batches` ranges of doc_id, so that what earlier
    batches hold is always smaller; more than `most_runs` runs are compacted.  Windows are judged on the input.  Every claimed
    passage is compared with the passage it repeats by SHA-256 of the words; where they
    differ (equal hashes of unequal windows), its windows are compared with all others of such claims.

    Null texts have no words; texts under 13 words lose none; texts of any length are read whole.  Equal texts keep
    all words in the smallest document only.  Rows with one doc_id are one document: they don't repeat each
    other.  Rows without doc_id are returned as they are, repeat nothing and are repeated by none.
    Other columns are ignored; an empty table gives no rows.
    """
    names = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    low, high = names.agg(F.min("doc_id"), F.max("doc_id")).first()
    pieces = bool(names.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").limit(1).count())
    index = WindowIndex.sized_for(names)
    index.most_runs = most_runs
    claims = docs.sparkSession.createDataFrame([], "doc long, pos long, words long, src long, spos long")
    for i in range(batches if low is not None else 0):
        a, b = low + (high - low + 1) * i // batches, low + (high - low + 1) * (i + 1) // batches
        claims = claims.unionAll(index.add(names.where(F.col("doc_id").between(a, b - 1)), pieces, keep=i + 1 < batches))
        release(docs.sparkSession)
    index.close()
    own, asks = claims.select("doc", "pos", "words"), claims.select(F.col("src").alias("doc"), F.col("spos").alias("pos"), "words").distinct()
    out = _applied(names, own, asks, pieces, True, True)
    digest = _digests(out)
    mine, theirs = digest.select("doc", "pos", "words", F.col("digest").alias("mine")), digest.select(F.col("doc").alias("src"), F.col("pos").alias("spos"), "words", F.col("digest").alias("theirs"))
    wrong = claims.join(mine, ["doc", "pos", "words"]).join(theirs, ["src", "spos", "words"]).where("mine <> theirs").select("doc", "pos", "words", "src", "spos")
    wrong = staged(wrong, "wrong")
    out = out.where("first")
    if not wrong.isEmpty():
        some = wrong.select(F.col("doc").alias("doc_id")).distinct()
        right = claims.join(wrong, ["doc", "pos", "words", "src", "spos"], "left_anti").select("doc", "pos", "words")
        right = staged(right.unionAll(_looked_at_again(names, wrong, pieces)).join(some, F.col("doc") == F.col("doc_id"), "left_semi"), "right")
        again = _applied(names.join(some, "doc_id", "left_semi"), right, right.limit(0), pieces, False, True)
        out = out.join(some, "doc_id", "left_anti").unionAll(again.select(*out.columns))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
