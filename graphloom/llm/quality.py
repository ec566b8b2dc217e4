"""Quality rules: monotonic gradient-boosted trees over document statistics (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .textops import _SEP, chunks, fmix64, split_words, string_bytes, window_hashes

LABELLED = 20_000
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30  # words; per cent
TREES, DEPTH, RATE, BINS, RIDGE, LEAST_WEIGHT = 80, 3, 0.15, 64, 1.0, 4.0

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: statistics the trees see, and how quality may change with each: -1 never rises, 0 either way
FEATURES = {
    "log_words": 0, "word_length": 0, "symbols_per_char": -1, "dup_line_share": -1, "repeat_share": -1, "stutter_share": -1, "distinct_share": 0, "symbol_word_share": -1,
    "sign_word_share": -1, "sentence_share": 0, "upper_share": 0, "digit_share": 0, "wide_share": 0, "log_longest": 0, "log_words_per_line": 0, "top_word_share": 0,
}

_table = lambda chars: np.isin(np.arange(256), np.frombuffer(chars.encode(), np.uint8))
_SYMBOL, _END = _table("#*$%&|<>"), _table(".!?")
_UPPER, _DIGIT = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("0123456789")
_PLAIN = np.arange(256) >= 128
_PLAIN |= _UPPER | _DIGIT | _table("abcdefghijklmnopqrstuvwxyz")


def _codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number per byte range, equal for equal bytes; ranges stand in order and don't overlap."""
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    letters = data[np.cumsum(inside[:-1], dtype=np.int8) > 0]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    ranges = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return ranges.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _repeated(codes: np.ndarray, at: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """Which windows of n words from the word indices `at` are found twice or more in their document."""
    hashes = window_hashes(fmix64(codes.astype(np.uint64) + np.uint64(1)), at, n)
    order = np.lexsort((hashes, doc))
    same = (doc[order[1:]] == doc[order[:-1]]) & (hashes[order[1:]] == hashes[order[:-1]])
    again = np.flatnonzero(same)
    place = np.arange(n)
    if not (codes[at[order[again], None] + place] == codes[at[order[again + 1], None] + place]).all():  # other words of the same hash: by the words
        _, of, times = np.unique(np.column_stack([doc, codes[at[:, None] + place]]), axis=0, return_inverse=True, return_counts=True)
        return times[of.reshape(-1)] > 1
    out = np.zeros(len(at), bool)
    out[order[again]] = out[order[again + 1]] = True
    return out


def statistics(col: pa.Array, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """COUNTS (long) and FEATURES (double) of each text, a row per text; null texts have no words."""
    w = split_words(col)
    data, off = string_bytes(col)
    rows, n = len(off) - 1, w.counts
    doc = np.repeat(np.arange(rows), n)
    letter = (data & 0xC0) != 0x80

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[off[1:]] - sums[off[:-1]]

    def of_words(mask: np.ndarray) -> np.ndarray:
        return np.bincount(doc, mask, rows)

    def in_words(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return sums[w.ends] - sums[w.starts]

    word_chars, symbols = total(~_SEP[data] & letter), total(_SYMBOL[data])
    codes = _codes(w.data, w.starts, w.ends)
    at, of = w.window_starts(window)
    again = at[_repeated(codes, at, of, window)] if len(at) else at
    cover = np.zeros(len(codes) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + window, -1)
    repeated = of_words(np.cumsum(cover[:-1]) > 0).astype(np.int64)
    # lines with a word, by their first words
    breaks = np.flatnonzero(data == 10)
    line = np.searchsorted(breaks, w.starts) + doc
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]])) if len(line) else line
    nth = np.searchsorted(breaks, w.starts[first])
    begin = np.maximum(off[:-1][doc[first]], np.concatenate([[-1], breaks])[nth] + 1)
    end = np.minimum(off[1:][doc[first]], np.concatenate([breaks, [len(data)]])[nth])
    lines = np.bincount(doc[first], minlength=rows)
    different = np.unique(np.column_stack([doc[first], _codes(data, begin, end)]), axis=0)
    dup_lines = lines - np.bincount(different[:, 0], minlength=rows)

    length = in_words(letter)
    longest, top = np.zeros(rows), np.zeros(rows)
    np.maximum.at(longest, doc, length)
    pairs, times = np.unique(doc * (codes.max(initial=0) + 1) + codes, return_counts=True)
    np.maximum.at(top, pairs // (codes.max(initial=0) + 1), times)
    stutter = np.concatenate([[False], (codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1])]) if len(codes) else np.zeros(0, bool)
    words, chars = np.maximum(n, 1), np.maximum(word_chars, 1)
    features = np.column_stack(
        [
            np.log1p(n), word_chars / words, symbols / chars, dup_lines / np.maximum(lines, 1), repeated / words, of_words(stutter) / words, np.bincount(pairs // (codes.max(initial=0) + 1), minlength=rows) / words,
            of_words(in_words(_SYMBOL[data]) > 0) / words, of_words(in_words(_PLAIN[data]) == 0) / words, of_words(_END[data[w.ends - 1]]) / words, total(_UPPER[data]) / chars, total(_DIGIT[data]) / chars,
            total((data >= 128) & letter) / chars, np.log1p(longest), np.log1p(n / np.maximum(lines, 1)), top / words,
        ]
    )
    return np.column_stack([n, word_chars, symbols, dup_lines, repeated]).astype(np.int64), features


@dataclass
class Trees:
    """Full binary trees of one depth as node arrays: node i of a tree has the children 2i + 1 (up to its cut) and 2i + 2 (above)."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    value: np.ndarray  # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        tree, row = np.arange(len(self.feature)), np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(tree)), np.int64)
        inner = self.feature.shape[1]
        for _ in range((inner + 1).bit_length() - 1):
            node = 2 * node + 1 + (x[row, self.feature[tree, node]] > self.cut[tree, node])
        return 1.0 / (1.0 + np.exp(-(self.start + self.value[tree, node - inner].sum(axis=1))))


def fit_trees(x: np.ndarray, y: np.ndarray, signs: list[int], trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS) -> Trees:
    """Boosted trees for the logistic loss, by second-order gains over histograms of quantile bins.

    signs: per feature 1, -1 or 0, so that scores never fall, never rise or do either as the feature grows.  A split that would go
    against its sign isn't taken, and below a split on such a feature both sides keep to their side of the mean of its two values.
    """
    share = float(np.clip(y.mean() if len(y) else 1.0, 1e-3, 1 - 1e-3))
    inner = (1 << depth) - 1
    out = Trees(np.log(share / (1 - share)), np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)))
    if not len(y) or y.min() == y.max():
        return out
    cuts = [np.unique(np.quantile(c, np.arange(1, bins) / bins)) for c in x.T]
    place = np.column_stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)])  # x <= cuts[b] where place <= b
    offset = np.arange(x.shape[1]) * bins
    sign = np.array(signs)
    raw = np.full(len(y), out.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        low, high = np.full(2 * inner + 1, -np.inf), np.full(2 * inner + 1, np.inf)
        weight = lambda g, h, a, b: np.clip(-g / (h + RIDGE), a, b)
        for level in range(depth):
            first, wide = (1 << level) - 1, 1 << level
            key = ((node - first)[:, None] * (x.shape[1] * bins) + offset + place).reshape(-1)
            shape = (wide, x.shape[1], bins)
            sums = [np.bincount(key, np.repeat(v, x.shape[1]), wide * x.shape[1] * bins).reshape(shape).cumsum(axis=2) for v in (g, h)]
            gl, hl = sums
            gr, hr = gl[:, :, -1:] - gl, hl[:, :, -1:] - hl
            a, b = low[first : first + wide, None, None], high[first : first + wide, None, None]
            wl, wr = weight(gl, hl, a, b), weight(gr, hr, a, b)
            worth = lambda g, h, w: -(g * w + 0.5 * (h + RIDGE) * w * w)
            whole = gl[:, :, -1:], hl[:, :, -1:]
            gain = worth(gl, hl, wl) + worth(gr, hr, wr) - worth(*whole, weight(*whole, a, b))
            gain[(hl < LEAST_WEIGHT) | (hr < LEAST_WEIGHT) | (sign[None, :, None] * (wr - wl) < 0)] = -np.inf
            for i in range(wide):
                f, c = divmod(int(gain[i].argmax()), bins)
                k = first + i
                if not gain[i, f, c] > 1e-9 or c >= len(cuts[f]):
                    low[2 * k + 1 : 2 * k + 3], high[2 * k + 1 : 2 * k + 3] = low[k], high[k]
                    continue
                out.feature[t, k], out.cut[t, k] = f, cuts[f][c]
                middle = (wl[i, f, c] + wr[i, f, c]) / 2
                low[2 * k + 1 : 2 * k + 3], high[2 * k + 1 : 2 * k + 3] = low[k], high[k]
                if sign[f] > 0:
                    high[2 * k + 1], low[2 * k + 2] = middle, middle
                elif sign[f] < 0:
                    low[2 * k + 1], high[2 * k + 2] = middle, middle
            node = 2 * node + 1 + (x[np.arange(len(y)), out.feature[t, node]] > out.cut[t, node])
        leaf = node - inner
        out.value[t] = rate * weight(np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1), low[inner:], high[inner:])
        raw += out.value[t, leaf]
    return out


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that no model learns from: a remainder of the id's checksum."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def learn(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> Trees:
    """Trees fitted on `bound` labelled documents at most, none of the held-out fold.

    Null labels and labels of unknown documents don't count; several labels of one document count as the smallest.  With
    labels of one kind only, or none, every text scores alike: high, unless all labels are 0.
    """
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)  # 12 bytes a row: 240 kB at most by default

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                x = statistics(part.column("text"))[1]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), *[pa.array(c) for c in x.T]], names=["doc_id", "quality", *FEATURES])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")
    rows = texts.mapInArrow(run, "doc_id long, quality int, " + ", ".join(f"{k} double" for k in FEATURES)).toPandas()
    rows = rows.sort_values(list(rows.columns), kind="stable")  # the same trees in whatever order rows arrive
    return fit_trees(rows[list(FEATURES)].to_numpy(np.float64), (rows["quality"].to_numpy() > 0).astype(np.float64), list(FEATURES.values()))


def _judged(trees: Trees, part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, whether the base rules fail, and scores."""
    counts, x = statistics(part.column("text"))
    return counts, (counts[:, 0] < LEAST_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0]), trees.scores(x)


def quality(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score, held_out) of every row.

    Words are runs of other bytes than space and 0x09-0x0D.  word_chars: their code points; n_symbols: characters of #*$%&|<>;
    n_dup_lines: lines (split at \\n) with a word that equal an earlier one; n_repeat_words: words in windows of 8 that are found twice or more
    in the text, overlapping ones and the first included.  base_failed: under 20 words, or over 30 per cent of them repeated.
    score: that the text is of quality, by trees over FEATURES that were learned from `labels` (doc_id, quality); of more symbols, repeated
    lines, repeated windows, repeated words or signs alone no score rises.  kept: not base_failed, and a score of 0.5 or more.

    One pass over the texts, a megabyte at a time, besides that over the labelled ones; a longer text is read whole.  Null texts have no words and
    fail; repeated rows each get a row; a null doc_id stays null and is in no fold; other columns are ignored; an empty table gives no rows.
    """
    trees = learn(docs, labels, bound)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                counts, failed, score = _judged(trees, part)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(c) for c in counts.T], pa.array(failed), pa.array(~failed & (score >= 0.5)), pa.array(score)], names=["doc_id", *COUNTS, "base_failed", "kept", "score"])

    schema = "doc_id long, " + ", ".join(f"{k} long" for k in COUNTS) + ", base_failed boolean, kept boolean, score double"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
    return rows.withColumn("held_out", F.coalesce(held_out(), F.lit(False)))


def without_poor(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """The rows of docs, with all their columns, that `quality` keeps."""
    trees = learn(docs, labels, bound)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                _, failed, score = _judged(trees, part)
                yield part.filter(pa.array(~failed & (score >= 0.5)))

    return docs.mapInArrow(run, docs.schema)


def op11_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
