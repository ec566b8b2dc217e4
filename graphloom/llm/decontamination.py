"""Benchmark decontamination: SimHash of item-sized windows in multi-index Hamming blocks (operator 8)."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cluster import staged
from .textops import chunks, joined, split_words, window_hashes, word_hashes

SHINGLE = 5
SIMILAR = 0.8
RADIUS, BLOCKS = 24, 8  # similar windows differ in about 10 of 64 bits, deviation 3
ITEM_BYTES = 4 << 20  # benchmark text of one pass over the documents

# Generalised pigeonhole: thresholds that sum to RADIUS - BLOCKS + 1 leave no pair within RADIUS above all of them.
THRESHOLDS = [(RADIUS - BLOCKS + 1 + i) // BLOCKS for i in range(BLOCKS)]


def _fingerprints(h: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """SimHash of n shingle hashes from each index in `first`."""
    low, high = int(first.min()), int(first.max()) + n
    bits = np.unpackbits(np.ascontiguousarray(h[low:high]).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros((len(bits) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    ones = total[first - low + n] - total[first - low]
    return np.packbits(ones * 2 > n, axis=1, bitorder="little").view("<u8").reshape(-1)


def _block_tables(own: np.ndarray) -> np.ndarray:
    """Per block and value of its byte, a bitmap of the fingerprints that are within the block's threshold of it."""
    values = np.arange(256, dtype=np.uint8)
    blocks = np.ascontiguousarray(own.astype("<u8")).view(np.uint8).reshape(-1, BLOCKS)
    near = [np.bitwise_count(values[:, None] ^ blocks[None, :, k]) <= THRESHOLDS[k] for k in range(BLOCKS)]
    return np.packbits(np.array(near), axis=2)


@dataclass
class Items:
    """Benchmark items of one pass: their words, the hashes of their shingles, and per item size fingerprints and block tables."""

    ids: list[int | None]
    first: list[int]  # per item its first word
    sizes: list[int]
    text: bytes
    starts: np.ndarray
    ends: np.ndarray
    known: np.ndarray  # hashes of all shingles, in order
    by_size: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # items, fingerprints, tables
    counted: dict[int, Counter] = field(default_factory=dict)

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]]) -> "Items":
        w = split_words(pa.array([t for _, t in rows], pa.string()))
        text, starts, ends = joined(w, lower=True)
        h = word_hashes(w, lower=True)
        ids, first, sizes, known, by_size, prints = [], [], [], [], defaultdict(list), []
        for i, (item, _) in enumerate(rows):
            a, b = int(w.first[i]), int(w.first[i + 1])
            if a == b:
                continue
            k = min(SHINGLE, b - a)
            g = window_hashes(h, np.arange(a, b - k + 1), k)
            by_size[b - a].append(len(ids))
            ids.append(item)
            first.append(a)
            sizes.append(b - a)
            known.append(g)
            prints.append(_fingerprints(g, np.zeros(1, np.int64), len(g))[0])
        prints = np.array(prints, np.uint64)
        tables = {n: (np.array(x), prints[x], _block_tables(prints[x])) for n, x in by_size.items()}
        return cls(ids, first, sizes, text, starts, ends, np.unique(np.concatenate(known)) if known else np.zeros(0, np.uint64), tables)

    def plain(self) -> tuple:
        """What a broadcast carries: numbers, bytes and arrays, without this class."""
        return tuple(getattr(self, f.name) for f in fields(self)[:-1])

    def shingles(self, item: int) -> Counter:
        """The item's shingles and their numbers; those of some items are kept."""
        if item not in self.counted:
            if len(self.counted) >= 1000:
                self.counted.clear()
            a, n = self.first[item], self.sizes[item]
            k = min(SHINGLE, n)
            self.counted[item] = Counter(self.text[self.starts[x] : self.ends[x + k - 1]] for x in range(a, a + n - k + 1))
        return self.counted[item]

    def within(self, size: int, fp: np.ndarray) -> list[tuple[int, int]]:
        """(window, item) for all fingerprints within RADIUS, each looked up in every block's table."""
        items, own, tables = self.by_size[size]
        out = []
        for i in range(0, len(fp), 1024):
            part = np.ascontiguousarray(fp[i : i + 1024].astype("<u8"))
            blocks = part.view(np.uint8).reshape(-1, BLOCKS)
            near = tables[0][blocks[:, 0]]
            for k in range(1, BLOCKS):
                near = near | tables[k][blocks[:, k]]
            a, b = np.nonzero(np.unpackbits(near, axis=1, count=len(items)))
            true = np.bitwise_count(part[a] ^ own[b]) <= RADIUS
            out += zip((a[true] + i).tolist(), items[b[true]].tolist())
        return out


def _similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard of two shingle multisets."""
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def _hits(col: pa.Array, items: Items, quick: np.ndarray) -> list[tuple[int, int, int, float]]:
    """(row, item, first word, similarity): each item's most similar window in each text, the first of equals."""
    w = split_words(col)
    text, starts, ends = joined(w, lower=True)
    if not len(starts) or not items.ids:
        return []
    h = word_hashes(w, lower=True)
    best: dict[tuple[int, int], tuple[float, int]] = {}

    def verify(row: int, item: int, first: int, n: int, k: int) -> None:
        at = range(first, first + n - k + 1)
        s = _similarity(items.shingles(item), Counter(text[starts[x] : ends[x + k - 1]] for x in at))
        if s >= SIMILAR:
            at0 = first - int(w.first[row])
            if (-s, at0) < best.get((row, item), (0.0, 0)):
                best[(row, item)] = (-s, at0)

    def member(g: np.ndarray) -> np.ndarray:
        out = quick[(g & np.uint64(0xFFFFF)).astype(np.int64)]
        some = np.flatnonzero(out)
        at = np.minimum(np.searchsorted(items.known, g[some]), len(items.known) - 1)
        out[some] = items.known[at] == g[some]
        return out

    for k in {min(SHINGLE, n) for n in items.by_size}:
        at, doc = w.window_starts(k)
        if not len(at):
            continue
        g = window_hashes(h, at, k)
        flag = member(g)
        total = np.concatenate([[0], np.cumsum(flag)])
        edge = np.searchsorted(doc, np.arange(len(col) + 1))
        sizes = sorted(n for n in items.by_size if min(SHINGLE, n) == k)
        for row in np.flatnonzero(total[edge[1:]] > total[edge[:-1]]).tolist():
            a, b = int(edge[row]), int(edge[row + 1])
            for n in sizes:
                m = n - k + 1  # shingles of an item of n words
                size = min(m, b - a)
                # at 0.8 or more of size + m - both shingles in common, both is at least this
                need = int(np.ceil(SIMILAR * (size + m) / (1 + SIMILAR) - 1e-9))
                if need > size:
                    continue
                first = np.arange(a, b - size + 1)
                common = total[first + size] - total[first]
                first, common = first[common > 0], common[common > 0]  # a window without any item's shingle resembles none
                if not len(first):
                    continue
                if size < m:  # a text shorter than the item is one window
                    n_words = size + k - 1
                else:
                    n_words = n
                for x, item in items.within(n, _fingerprints(g, first, size)):
                    if common[x] >= need:
                        verify(row, item, int(at[first[x]]), n_words, k)
    return [(row, item, at0, -s) for (row, item), (s, at0) in best.items()]


def item_passes(benchmark: DataFrame, limit: int = ITEM_BYTES) -> Iterator[Items]:
    """The benchmark in passes of bounded text, one after the other; a longer item has a pass of its own."""
    rows, size = [], 0
    for r in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").orderBy("item_id", "text").toLocalIterator():
        if rows and size + len(r.text) > limit:
            yield Items.of(rows)
            rows, size = [], 0
        rows.append((r.item_id, r.text))
        size += len(r.text)
    if rows:
        yield Items.of(rows)


def _quick(items: Items) -> np.ndarray:
    quick = np.zeros(1 << 20, bool)
    quick[(items.known & np.uint64(0xFFFFF)).astype(np.int64)] = True
    return quick


_FOUND = "doc_id long, item_id long, first_word long, similarity double"


def _found_in(rows: DataFrame, items: Items) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(items.plain())  # ITEM_BYTES of text, or one item

    def run(batches):
        here = Items(*sent.value)
        quick = _quick(here)
        for batch in batches:
            for part in chunks(batch, "text"):
                found = _hits(part.column("text"), here, quick)
                ids = part.column("doc_id").take(pa.array([x[0] for x in found], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([here.ids[x[1]] for x in found], pa.int64()), pa.array([x[2] for x in found], pa.int64()), pa.array([x[3] for x in found], pa.float64())], names=["doc_id", "item_id", "first_word", "similarity"])

    return rows.mapInArrow(run, _FOUND)


def _free_of(docs: DataFrame, items: Items) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items.plain())

    def run(batches):
        here = Items(*sent.value)
        quick = _quick(here)
        for batch in batches:
            for part in chunks(batch, "text"):
                keep = np.ones(part.num_rows, bool)
                keep[[x[0] for x in _hits(part.column("text"), here, quick)]] = False
                yield part.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, similarity): items that a text holds a window of, the most similar window of each.

    A window has as many words as the item (the whole text, if that is shorter).  Similarity is
    the weighted Jaccard index of five-word shingles with their numbers, letters A-Z in
    lower case, and at least 0.8.  The SimHash of each window that has some item's shingle is looked up in the
    items' block tables, which find all within RADIUS bits; these are verified.

    Items of under five words are one shingle, found where their words stand in that order.
    Null and empty texts or items match nothing; texts of any length are read whole.  Repeated documents or items
    each give rows.  A null doc_id or item_id stays null.  Empty tables give no rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out, last = docs.sparkSession.createDataFrame([], _FOUND), None
    for items in item_passes(benchmark):
        if last is not None:  # earlier passes are written, so that their items can go
            out = out.unionAll(staged(last, "found"))
        last = _found_in(rows, items)
    return out if last is None else out.unionAll(last)


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that hold no benchmark item."""
    last = None
    for items in item_passes(benchmark):
        if last is not None:
            docs = staged(last, "free")
        last = _free_of(docs, items)
    return docs if last is None else last


def op8_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
