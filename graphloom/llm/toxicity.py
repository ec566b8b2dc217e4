"""Toxicity by noisy-channel deobfuscation (operator 4).

1. A character trigram model is counted over the letters of all documents.
2. Tokens that look disguised (leetspeak, spaced or dotted letters, repeated letters) become lattices
   of possible letters; the Viterbi path under that model restores them.  Others with a sign, separator, mask or
   doubled letter, and runs of single characters, may also stay as they are; if they don't, both readings count.
3. Restored texts are scored by words and word beginnings whose presence in labelled documents
   goes with the label by more than chance: the three strongest of the whole text, and its length.

Texts of any length are read whole, in time that grows with their length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cluster import staged
from .textops import _BYTE, _BYTE_BASE, Words, _powers, chunks, fmix64, split_words, string_bytes, window_hashes, word_hashes

LABELLED = 20_000  # labelled documents learned from, at most: those with the smallest hashes of doc_id
FOLDS = 5
PREFIXES = (4, 5, 6, 7)

# What a sign may stand for, and the log-probabilities of the channel's edits.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t"}
SEPARATORS = ".-_*~'`"
SWAP, DROP_SAME, DROP_SIGN, DROP_SPACE, MASKED = -1.5, -0.7, -0.3, -0.3, -3.3
MASK, ANY = "*", "abcdefghijklmnopqrstuvwxyz"

LETTERS = 62
_CODE = np.zeros(0x180, np.int64)  # letter classes: 0 none, 1-26 a-z, 27-58 further Latin letters, 60 others
_CODE[97:123] = np.arange(1, 27)
_CODE[0xDF:0x100] = np.arange(27, 60)
_CODE[0xF7] = 0  # the division sign
_CODE[0x100:] = 60


def _codes(text: str) -> np.ndarray:
    return _CODE[np.minimum(np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), 0x17F)]


def _code(ch: str) -> int:
    return int(_CODE[min(ord(ch), 0x17F)])


def letter_model(docs: DataFrame) -> np.ndarray:
    """log P(letter | two before) from all texts, interpolated with shorter contexts; 62 x 62 x 62 numbers whatever the input."""

    def run(batches):
        total = np.zeros(LETTERS**3, np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                data, off = string_bytes(part.column("text"))
                c = _codes("  " + data.tobytes().decode("utf-8", "replace").lower() + "  ")
                total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=LETTERS**3)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    rows = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    tri = np.zeros(LETTERS**3)
    tri[rows["gram"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
    tri = tri.reshape(LETTERS, LETTERS, LETTERS)
    bi, uni = tri.sum(0), tri.sum((0, 1))
    p1 = (uni + 1) / (uni.sum() + LETTERS)
    p2 = (bi + 5 * p1) / (bi.sum(1, keepdims=True) + 5)
    p3 = (tri + 5 * p2[None]) / (tri.sum(2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


def _edits(ch: str, keep: bool) -> list[tuple[str, int, float]]:
    """What a character may stand for: letters (none: it is left out), their code and the log-probability of the edit."""
    if ch == " ":
        return [(" ", 0, 0.0), ("", 0, DROP_SPACE)]
    code = _code(ch)
    if ch in LEET:
        out = [(x, _code(x), SWAP) for x in LEET[ch]]
    elif code:
        return [(ch, code, 0.0)]
    else:
        out = [("", 0, DROP_SIGN if ch in SEPARATORS else 2 * SWAP)]
    if keep and not code:
        out.append((ch, 0, 0.0))
        if ch == MASK:
            out += [(x, _code(x), MASKED) for x in ANY]
    return out


_EDITS: dict[tuple[str, bool], list[tuple[str, int, float]]] = {}


def restore(token: str, model, keep: bool = False) -> str:
    """The likeliest letters behind a disguised token (lower case); spaces may stay or go, with `keep` signs too; then masks may hide letters."""
    states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    before = ""
    for ch in token:
        options = _EDITS.get((ch, keep))
        if options is None:
            options = _edits(ch, keep)
            if len(_EDITS) < 100_000:
                _EDITS[(ch, keep)] = options
        new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (s, path) in states.items():
            row = model[a][b]
            for x, code, cost in options:
                if x:
                    key, t = (b, code), s + cost + row[code]
                    if key not in new or t > new[key][0]:
                        new[key] = (t, (path, x))
                elif (a, b) not in new or s + cost > new[(a, b)][0]:
                    new[(a, b)] = (s + cost, path)
            if ch == before and ch != " " and ((a, b) not in new or s + DROP_SAME > new[(a, b)][0]):
                new[(a, b)] = (s + DROP_SAME, path)
        states, before = new, ch
    _, path = max(((s + model[a][b][0], path) for (a, b), (s, path) in states.items()), key=lambda x: x[0])
    out: list[str] = []
    while path is not None:
        path, x = path
        out.append(x)
    return "".join(reversed(out))


_SIGNS = re.escape("".join(LEET))
_L = r"[^\W\d_]"
DISGUISED = re.compile(
    rf"{_L}[{_SIGNS}]{{1,3}}{_L}"  # a sign between letters
    rf"|(?:^|(?<=\s))[{_SIGNS}]{_L}|{_L}[013457@$](?=\s|$)"  # one at either end
    rf"|({_L})\1\1"  # repetition
    rf"|(?:^|(?<=\s)){_L}(?:[{re.escape(SEPARATORS)}]{_L}){{2,}}(?=\W|$)"  # l.i.k.e this
    rf"|(?:^|(?<=\s)){_L}(?: {_L}){{2,}}(?=\s|$)"  # or l i k e this
)
_UNIT = rf"(?:{_L}|[{_SIGNS}{re.escape(SEPARATORS)}])"
_SINGLES = re.compile(rf"(?<!\w){_UNIT}(?:\s+{_UNIT}){{2,}}(?=[^\w\s]*(?:\s|$))")
_EDGES = re.compile(rf"^[^\w{_SIGNS}]+|[^\w{_SIGNS}]+$")
_MAYBE = re.compile(rf"({_L})\1|[\W\d_]")  # in a token with a letter: may be disguised
_LETTER = re.compile(_L)
_DOUBLED = re.compile(r"(.)\1")
_PLAIN_EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in LEET and c != "_")
_SPACED = re.compile(rf"(?:^|(?<=\s)){_L}(?: {_L}){{2,}}(?=\s|$)")

_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[65:91] = _IS_LETTER[97:123] = True
_IS_LETTER[128:] = True
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[32, 9, 10, 11, 12, 13, 28, 29, 30, 31]] = True


def _odd_words(data: np.ndarray, off: np.ndarray) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words; those that may be disguised: with anything but ASCII letters, or a doubled one; and words of one character that may stand in a run of such."""
    n = len(data)
    gap = _IS_GAP[data]
    word = ~gap
    st, en = word.copy(), word.copy()
    st[1:] &= gap[:-1]
    en[:-1] &= gap[1:]
    some = off[:-1] < off[1:]
    st[off[:-1][some]] = word[off[:-1][some]]
    en[off[1:][some] - 1] = word[off[1:][some] - 1]
    starts, ends = np.flatnonzero(st), np.flatnonzero(en) + 1
    w = Words(data, starts, ends, np.searchsorted(starts, off))
    odd = word & (~_IS_LETTER[data] | (data >= 128))
    if n > 1:
        odd[1:] |= _IS_LETTER[data[1:]] & (data[1:] | 32 == data[:-1] | 32)
    odd[starts] &= ~_IS_LETTER[data[starts]] | (data[starts] >= 128)  # a first letter repeats none
    count = np.concatenate([[0], np.cumsum(odd)])
    flag = count[ends] > count[starts]
    lone, first, last = _lone(data, starts, ends)
    near = np.zeros(len(starts), bool)
    if len(starts) > 2:
        near[1:-1] = lone[1:-1] & last[:-2] & first[2:]
    return w, flag, near


def _lone(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of one character; words whose first, and whose last character no letter or digit follows or precedes (non-ASCII ones may be either)."""
    lead = (data & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(lead)])
    one = chars[ends] - chars[starts] == 1
    plain = np.zeros(256, bool)
    plain[48:58] = plain[65:91] = plain[97:123] = True
    second, before = data[np.minimum(starts + 1, len(data) - 1)] if len(data) else data, data[np.maximum(ends - 2, 0)] if len(data) else data
    return one, one | ~plain[second], one | ~plain[before]


def _suspects(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Rows that may hold a disguised token."""
    w, flag, near = _odd_words(data, off)
    return np.unique(np.searchsorted(w.first, np.flatnonzero(flag | near), side="right") - 1)


class Readings(dict):
    """Tokens (lower case, without white space) and how they are read: disguised ones restored, others that may be with what they may mean before them."""

    def __init__(self, model) -> None:
        self.model = model

    def __missing__(self, token: str) -> str:
        core = token.strip(_PLAIN_EDGES)
        if (core.isascii() and core.isalpha() and not _DOUBLED.search(core)) or not _LETTER.search(token):
            return token
        if DISGUISED.search(token):
            out = restore(token, self.model)
        else:
            out = self.either(_EDGES.sub("", token), token)
        if len(self) < 200_000 and len(token) <= 64:
            self[token] = out
        return out

    def either(self, core: str, token: str) -> str:
        if not _LETTER.search(core) or not _MAYBE.search(core):
            return token
        found = restore(core, self.model, True)
        return token if found == core or re.findall(f"{_L}+", found) == re.findall(f"{_L}+", core) else f"{found} {token}"


@dataclass
class Restorer:
    """Restores texts, keeping what it has found for short tokens."""

    model: np.ndarray

    def __post_init__(self) -> None:
        self.seen = Readings(self.model.tolist())

    def text(self, text: str) -> str:
        low = text.lower()
        now = self.singles(low)
        was = now.split()
        read = [self.seen[t] for t in was]
        return text if read == was and now == low else " ".join(read)

    def singles(self, low: str) -> str:
        """Runs of single characters read as words."""
        return _SINGLES.sub(lambda m: restore(m[0], self.seen.model) if _SPACED.fullmatch(m[0]) else self.seen.either(" ".join(m[0].split()), m[0]), low)

    def column(self, col: pa.Array) -> pa.Array:
        """Lower-case texts with disguised tokens restored; null texts are empty.

        Each different odd word of the column is read once; only texts whose readings differ are written anew.
        """
        low = pc.fill_null(pc.utf8_lower(col), "")
        data, off = string_bytes(low)
        w, flag, near = _odd_words(data, off)
        row_of = lambda k: np.searchsorted(w.first, k, side="right") - 1
        at = np.flatnonzero(flag)
        _, first, back = np.unique(word_hashes(w)[at], return_index=True, return_inverse=True)
        raw = data.tobytes()
        readings: list[str | None] = []
        for s, e in zip(w.starts[at[first]].tolist(), w.ends[at[first]].tolist()):
            token = raw[s:e].decode("utf-8", "replace")
            read = " ".join([self.seen[t] for t in token.split()])
            readings.append(read if read != token else None)
        new = np.array([r is not None for r in readings], bool)[back] if len(at) else np.zeros(0, bool)
        changed = {}
        for i in np.unique(row_of(np.flatnonzero(near))).tolist():
            was = raw[off[i] : off[i + 1]].decode("utf-8", "replace")
            now = self.singles(was)
            if now != was:
                changed[i] = " ".join([self.seen[t] for t in now.split()])
        rows = row_of(at[new])
        edges = np.append(np.flatnonzero(np.concatenate([[True], np.diff(rows) != 0])), len(rows)) if len(rows) else [0]
        of = back[new] if len(at) else back
        s, e = w.starts[at[new]], w.ends[at[new]]
        for a, b in zip(edges[:-1], edges[1:]):
            i = int(rows[a])
            if i in changed:
                continue
            parts, last = [], int(off[i])
            for k in range(a, b):
                parts += [raw[last : s[k]].decode("utf-8", "replace"), readings[of[k]]]
                last = int(e[k])
            changed[i] = "".join([*parts, raw[last : off[i + 1]].decode("utf-8", "replace")])
        if not changed:
            return low
        out = low.to_pylist()
        for i, text in changed.items():
            out[i] = text
        return pa.array(out, low.type)


def features(col: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, runs of letters: (row, hash) of each; and features: (word, hash) of it and of its first 4 to 7 bytes where it is longer."""
    data, off = string_bytes(col)
    letter = _IS_LETTER[data]
    st, en = letter.copy(), letter.copy()
    st[1:] &= ~letter[:-1]
    en[:-1] &= ~letter[1:]
    some = off[:-1] < off[1:]
    st[off[:-1][some]] = letter[off[:-1][some]]
    en[off[1:][some] - 1] = letter[off[1:][some] - 1]
    s, e = np.flatnonzero(st), np.flatnonzero(en) + 1
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BYTE_BASE, len(data)), out=total[1:])
    inverse = _powers(pow(_BYTE_BASE, -1, 1 << 64), len(data))
    whole = fmix64((total[e] - total[s]) * inverse[s])
    words, hashes = [np.arange(len(s))], [whole]
    for n in PREFIXES:
        at = np.flatnonzero(e - s > n)
        words.append(at)
        hashes.append(fmix64((total[s[at] + n] - total[s[at]]) * inverse[s[at]] + np.uint64(n)))
    return np.searchsorted(off, s, side="right") - 1, whole, np.concatenate(words), np.concatenate(hashes)


TOP = 3  # the model's evidence in a text is its strongest words, found anywhere in it: a long text isn't toxic for many weak ones


@dataclass
class Classifier:
    """Letter model; lexicon (feature hashes in order, toxic and clean documents of each, and of all); logistic weights."""

    model: np.ndarray
    hashes: np.ndarray
    ones: np.ndarray
    zeros: np.ndarray
    n1: float
    n0: float
    beta: np.ndarray

    def __post_init__(self) -> None:
        self.quick = np.zeros(1 << 20, bool)
        self.quick[(self.hashes & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def weights(self, at: np.ndarray, y: np.ndarray | float | None = None) -> np.ndarray:
        """Log-odds of features, 0 where the label may be chance; y: label of a document to leave out of the counts."""
        a, b, n1, n0 = self.ones[at], self.zeros[at], self.n1, self.n0
        if y is not None:
            a, b, n1, n0 = a - y, b - (1 - y), n1 - y, n0 - (1 - y)
        share = n1 / (n1 + n0)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(a > 0, a * np.log(a / (a + b) / share), 0) + np.where(b > 0, b * np.log(b / (a + b) / (1 - share)), 0)
        w = np.log((a + 0.5) / (n1 + 1)) - np.log((b + 0.5) / (n0 + 1))
        return np.where((a >= 2) & (gain > math.log(len(self.hashes) + 1)), np.maximum(w, 0), 0)

    def evidence(self, col: pa.Array, y: np.ndarray | None = None) -> np.ndarray:
        """Per restored text: 1, the weights of its TOP strongest different words, whether it has any, and the log of its words."""
        out = np.zeros((len(col), TOP + 3))
        out[:, 0] = 1
        row, word, of, h = features(col)
        out[:, -1] = np.log1p(np.bincount(row, minlength=len(col)))
        if len(self.hashes) and len(h):
            near = np.flatnonzero(self.quick[(h & np.uint64(0xFFFFF)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.hashes, h[near]), len(self.hashes) - 1)
            true = self.hashes[at] == h[near]
            at, of = at[true], of[near][true]
            r, k = row[of], word[of]
            w = self.weights(at, None if y is None else y[r])
            order = np.lexsort((-w, k, r))
            r, k, w = r[order], k[order], w[order]
            new = np.concatenate([[True], (np.diff(r) != 0) | (k[1:] != k[:-1])]) if len(r) else np.zeros(0, bool)
            r, w = r[new], w[new]
            order = np.lexsort((-w, r))
            r, w = r[order], w[order]
            rank = np.arange(len(r)) - np.searchsorted(r, r)
            for i in range(TOP):
                out[r[rank == i], 1 + i] = w[rank == i]
        out[:, -2] = out[:, 1] > 0
        return out

    def scores(self, col: pa.Array, restorer: Restorer) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(restorer.column(col)) @ self.beta, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the first column is the intercept."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (y - p) - penalty * beta
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), grad)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return beta


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0


def _sketches(batches) -> Iterator[pa.RecordBatch]:
    """doc_id and the smallest 5-word hash of its text, which near copies nearly always share."""
    for batch in batches:
        for part in chunks(batch, "text"):
            w = split_words(part.column("text"))
            h = word_hashes(w)
            at, doc = w.window_starts(5)
            low = np.full(part.num_rows, np.iinfo(np.uint64).max, np.uint64)
            np.minimum.at(low, doc, window_hashes(h, at, 5))
            short = np.flatnonzero(w.counts < 5)
            data, off = string_bytes(part.column("text"))
            for i in short.tolist():
                low[i] = xxhash.xxh64_intdigest(data[off[i] : off[i + 1]].tobytes())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(low.view(np.int64)), part.column("toxic")], names=["doc_id", "sketch", "toxic"])


def _counts(batches) -> Iterator[pa.RecordBatch]:
    """Feature hashes, with the toxic and clean documents that hold each; the documents of a kind under hash 0."""
    for batch in batches:
        for part in chunks(batch, "text"):
            toxic = part.column("toxic").to_numpy(zero_copy_only=False) > 0
            row, _, of, h = features(part.column("text"))
            row = row[of]
            order = np.lexsort((h, row))
            row, h = row[order], h[order]
            new = np.concatenate([[True], (np.diff(row) != 0) | (h[1:] != h[:-1])]) if len(h) else np.zeros(0, bool)
            u, inverse, n = np.unique(h[new], return_inverse=True, return_counts=True)
            ones = np.bincount(inverse, toxic[row[new]], len(u)).astype(np.int64)
            u, ones, zeros = np.append(u, np.uint64(0)), np.append(ones, int(toxic.sum())), np.append(n - ones, int((~toxic).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(ones), pa.array(zeros)], names=["h", "ones", "zeros"])


def learn(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> Classifier:
    """A classifier from documents outside the held-out fold, `bound` labelled ones at most.

    Near copies count once, or a toxic text that was copied would make all its words
    suspicious.  Null labels and labels of unknown documents don't count; several labels of one document count as
    the largest.  Without toxic labels every score is near 0.
    """
    model = letter_model(docs)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)  # 12 bytes a row: 240 kB at most by default
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text").isNotNull())
    votes = texts.join(F.broadcast(sample), "doc_id").mapInArrow(_sketches, "doc_id long, sketch long, toxic int").groupBy("sketch", "toxic").agg(F.min("doc_id").alias("doc_id"))

    def read(batches):
        restorer = Restorer(model)
        for batch in batches:
            for part in chunks(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("toxic"), restorer.column(part.column("text"))], names=["toxic", "text"])

    votes = staged(votes.select("doc_id", "toxic").coalesce(1), "votes")  # as many as the sample at most: one small file, not one a shuffle partition
    chosen = staged(texts.join(F.broadcast(votes), "doc_id").select("toxic", "text").mapInArrow(read, "toxic int, text string"), "read")
    counts = chosen.mapInArrow(_counts, "h long, ones long, zeros long")
    counts = counts.groupBy("h").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    rows = counts.where("h = 0 or ones >= 3").toPandas()  # words that three or more of `bound` labelled texts share
    whole = rows[rows["h"] == 0]
    n1, n0 = (float(whole["ones"].sum()), float(whole["zeros"].sum()))
    rows = rows[rows["h"] != 0]
    order = np.argsort(rows["h"].to_numpy(np.int64).view(np.uint64))
    h, ones, zeros = rows["h"].to_numpy(np.int64).view(np.uint64)[order], rows["ones"].to_numpy(np.float64)[order], rows["zeros"].to_numpy(np.float64)[order]
    beta = np.zeros(TOP + 3)
    beta[0] = 0.0 if n1 and n0 else (5.0 if n1 else -5.0)
    known = Classifier(model, h, ones, zeros, n1, n0, beta)
    if not n1 or not n0:
        return known

    def weigh(batches):  # the lexicon was counted on these texts too, so each is weighed without its own counts
        for batch in batches:
            for part in chunks(batch, "text"):
                y = (part.column("toxic").to_numpy(zero_copy_only=False) > 0).astype(np.float64)
                x = known.evidence(part.column("text"), y)
                yield pa.RecordBatch.from_arrays([pa.array(y), *[pa.array(c) for c in x.T]], names=["y", *[f"x{i}" for i in range(x.shape[1])]])

    seen = chosen.mapInArrow(weigh, "y double, " + ", ".join(f"x{i} double" for i in range(TOP + 3))).toPandas().to_numpy()
    known.beta = logistic(seen[:, 1:], seen[:, 0])
    return known


def toxicity(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; score only depends on the row's text.

    predicted is 1 from a score of 0.5.  Null and empty texts, and texts without a known
    feature, get the base score, below that of any text with one.  Repeated rows each get a row,
    a null doc_id stays null; other columns are ignored; an empty table gives no rows.
    """
    known = learn(docs, labels, bound)

    def run(batches):
        restorer = Restorer(known.model)
        for batch in batches:
            for part in chunks(batch, "text"):
                s = known.scores(part.column("text"), restorer)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double, predicted int")
    return rows.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def without_toxic(docs: DataFrame, labels: DataFrame, bound: int = LABELLED) -> DataFrame:
    """The rows of docs, with all their columns, that aren't predicted toxic."""
    known = learn(docs, labels, bound)

    def run(batches):
        restorer = Restorer(known.model)
        for batch in batches:
            for part in chunks(batch, "text"):
                yield part.filter(pa.array(known.scores(part.column("text"), restorer) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    return toxicity(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
