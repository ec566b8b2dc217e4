"""SimHash near-duplicates by the generalised pigeonhole principle (operator 10)."""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cluster import staged
from .components import connected_components, forest
from .textops import chunks, fmix64, joined, split_words

RADIUS = 4
SHINGLE = 4
BLOCK = 2048
PAIR_COST, ENTRY_COST = 1.0, 60.0
SAMPLED = 2048  # fingerprints whose pairs tell how far apart pairs are in a group of bits; only costs are estimated from them
_ONE = np.uint64(1)


def fingerprints_of(col: pa.Array, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints (uint64) of a string column; see near_duplicates for the rules."""
    w = split_words(col)
    text, starts, ends = joined(w, lower=True)
    counts, first = w.counts, w.first[:-1]
    per = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    doc = np.repeat(np.arange(len(per)), per)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per) + first[doc]
    s = starts[at] if len(at) else at
    e = ends[at + np.minimum(shingle, counts[doc]) - 1] if len(at) else at
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(text[x:y], 42) for x, y in zip(s.tolist(), e.tolist())), np.uint64, len(at))
    out = np.zeros(len(per), np.uint64)
    if not len(h):
        return out
    bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    some = np.flatnonzero(per)
    sums = np.add.reduceat(bits, (np.cumsum(per) - per)[some], axis=0, dtype=np.int32)
    packed = np.packbits(sums * 2 > per[some, None], axis=1, bitorder="little")
    out[some] = packed.view("<u8").reshape(-1)
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str | None = None) -> DataFrame:
    """(doc_id, fingerprint long) of every row, and its `key` if one is named; null texts have no words, so fingerprint 0."""
    names = ["doc_id", *([key] if key else [])]

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                fp = fingerprints_of(part.column("text"), shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([*[part.column(n).cast(pa.int64()) for n in names], pa.array(fp)], names=[*names, "fingerprint"])

    return docs.select(*[F.col(n).cast("long").alias(n) for n in names], "text").mapInArrow(run, ", ".join(f"{n} long" for n in [*names, "fingerprint"]))


# --- plan: partitions of correlated bits and their thresholds -----------------------------------------


def bit_moments(reps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together (4096 numbers at the driver, whatever the input)."""

    def run(batches):
        total = np.zeros((64, 64))
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            for i in range(0, len(fp), 65536):
                b = np.unpackbits(np.ascontiguousarray(fp[i : i + 65536]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += b.T @ b
        i, j = np.divmod(np.arange(4096), 64)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.reshape(-1))], names=["i", "j", "c"])

    rows = reps.select("fingerprint").mapInArrow(run, "i long, j long, c double").groupBy("i", "j").agg(F.sum("c").alias("c")).collect()
    both = np.zeros((64, 64))
    for r in rows:
        both[r.i, r.j] = r.c
    return reps.count(), both


def bit_partitions(n: int, both: np.ndarray, m: int) -> list[list[int]]:
    """64 bits in m groups; each group gathers the bits most correlated with those it has."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd)
    np.fill_diagonal(corr, 0)
    left, groups = set(range(64)), []
    for k in range(m):
        size = (64 - sum(map(len, groups))) // (m - k)
        order = sorted(left)
        seed = max(order, key=lambda b: (corr[b, order].max(), -b))
        group = [seed]
        left.discard(seed)
        while len(group) < size:
            b = max(sorted(left), key=lambda x: corr[x, group].sum())
            group.append(b)
            left.discard(b)
        groups.append(sorted(group))
    return groups


def sampled(reps: DataFrame, most: int = SAMPLED) -> np.ndarray:
    """The fingerprints of the smallest hashes, `most` at most."""
    rows = reps.select("fingerprint").orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(most).collect()
    return np.array([r.fingerprint for r in rows], np.int64).view(np.uint64)


def within(bits: list[int], most: int, sample: np.ndarray) -> np.ndarray:
    """Share of the sample's pairs that differ in <= t of these bits, t = 0..most; half a pair at least."""
    mask = np.uint64(sum(1 << b for b in bits))
    times = np.zeros(65, np.int64)
    for i in range(1, len(sample)):
        times += np.bincount(np.bitwise_count((sample[:i] ^ sample[i]) & mask), minlength=65)
    return np.cumsum(np.maximum(times[: most + 1], [0.5] + [0] * most)) / max(times.sum(), 1)


def allocate(cost: list[list[float]], radius: int) -> tuple[float, list[int]]:
    """Thresholds >= -1 that sum to radius - m + 1 at least cost; cost[i][t + 1] is that of threshold t."""
    m, top = len(cost), radius - len(cost) + 1
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in cost:
        new: dict[int, tuple[float, list[int]]] = {}
        for s, (c, chosen) in best.items():
            for t in range(-1, radius + 1):
                x = (c + row[t + 1], [*chosen, t])
                if s + t not in new or x < new[s + t]:
                    new[s + t] = x
        best = new
    assert all(len(x[1]) == m for x in best.values())
    return best[top]


def plan(n: int, both: np.ndarray, sample: np.ndarray, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Groups of bits and the threshold of each: if two fingerprints differ in <= radius bits, then in some group in <= its threshold.

    Bits of a group go together, so how many pairs meet in it is counted on sampled fingerprints.
    """
    found = []
    for m in range(1, radius + 2):
        groups = bit_partitions(n, both, m)
        cost = []
        for g in groups:
            near = within(g, radius, sample)
            cost.append([0.0] + [PAIR_COST * n * (n - 1) / 2 * near[t] + ENTRY_COST * n * comb(len(g), t) for t in range(radius + 1)])
        c, thresholds = allocate(cost, radius)
        found.append((c, m, [(g, t) for g, t in zip(groups, thresholds) if t >= 0]))
    return min(found, key=lambda x: x[:2])[2]


def probe_masks(groups: list[tuple[list[int], int]]) -> np.ndarray:
    """The bits each probe looks at: a group less any of its threshold-many bits."""
    masks = []
    for bits, t in groups:
        whole = sum(1 << b for b in bits)
        for skip in combinations(bits, min(t, len(bits))):
            masks.append(whole - sum(1 << b for b in skip))
    return np.array(masks, np.uint64)


# --- links ---------------------------------------------------------------------------------------------


def _pairs_in_runs(key: np.ndarray, fp: np.ndarray, rep: np.ndarray, side: np.ndarray, radius: int):
    """Forest edges between rows with equal keys; rows of side 0 and 1 meet each other only, rows of side 2 all."""
    a, b = [], []
    run = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
    longest = int(np.diff(run).max()) if len(key) else 0
    for d in range(1, longest):
        i = np.flatnonzero(key[d:] == key[:-d])
        if not len(i):
            break
        j = i + d
        near = (np.bitwise_count(fp[i] ^ fp[j]) <= radius) & ((side[i] == 2) | (side[i] != side[j]))
        if near.any():
            a.append(rep[i[near]])
            b.append(rep[j[near]])
            if sum(map(len, a)) > 500_000:
                x, y = forest(np.concatenate(a), np.concatenate(b))
                a, b = [x], [y]
    return forest(np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def links(reps: DataFrame, groups: list[tuple[list[int], int]], radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between representatives that connect all fingerprints within the radius.

    reps: (fingerprint, rep).  Each fingerprint enters one list per probe mask.
    A list of more than `block` entries is dealt out as pairs of blocks, so no task
    holds more than two blocks of a list; every pair of entries is still compared.
    """
    masks = probe_masks(groups)
    salts = fmix64(np.arange(1, len(masks) + 1, dtype=np.uint64))

    def enter(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            rep = batch.column(1).to_numpy(zero_copy_only=False)
            for i in range(0, len(fp), 20_000):
                f, r = fp[i : i + 20_000], rep[i : i + 20_000]
                keys = fmix64((f[:, None] & masks[None, :]) * np.uint64(0x9E3779B97F4A7C15) + salts[None, :])
                n = len(masks)
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(f, n).view(np.int64)), pa.array(np.repeat(r, n))], names=["key", "fp", "rep"])

    def compare(batches):
        kept: list[np.ndarray] = []
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if kept:
                cols = [np.concatenate(x) for x in zip(kept, cols)]
            last = (cols[0] == cols[0][-1]) & (cols[1] == cols[1][-1])
            cut = len(last) - int(last[::-1].argmin()) if not last.all() else 0
            kept = [c[cut:] for c in cols]
            if cut:
                yield found([c[:cut] for c in cols])
        if kept and len(kept[0]):
            yield found(kept)

    def found(cols):
        key, part, side, fp, rep = cols
        k = fmix64(key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + part.view(np.uint64))
        a, b = _pairs_in_runs(k, fp.view(np.uint64), rep, side, radius)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    entries = reps.select("fingerprint", "rep").mapInArrow(enter, "key long, fp long, rep long")
    shared = entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    rows = entries.join(shared.hint("merge"), "key").withColumn("blocks", F.ceil(F.col("n") / block))
    small = rows.where("blocks = 1").select("key", F.lit(0).cast("long").alias("part"), F.lit(2).alias("side"), "fp", "rep")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    large = (
        rows.where("blocks > 1")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("key", (F.least("own", "other") * F.col("blocks") + F.greatest("own", "other") + 1).alias("part"), F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"), "fp", "rep")
    )
    dealt = small.unionAll(large)
    return dealt.repartition("key", "part").sortWithinPartitions("key", "part").mapInArrow(compare, "a long, b long")


def groups_of(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(fingerprint, part): each fingerprint once, with the smallest one that it is linked to."""
    reps = staged(fps.select("fingerprint").distinct().withColumn("rep", F.col("fingerprint")), "reps")
    n, both = bit_moments(reps)
    parts = connected_components(links(reps, plan(n, both, sampled(reps), radius), radius, block))
    return staged(reps.join(parts, reps.rep == parts.id, "left").select("fingerprint", F.coalesce("component", "rep").alias("part")), "groups")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """(doc_id, fingerprint, component_id): documents whose fingerprints link at `radius` or fewer differing bits.

    The 64 bits are grouped so that correlated ones stand together, and dynamic
    programming on estimated candidate counts gives each group its own threshold; the
    thresholds sum to radius - groups + 1, so two fingerprints within the radius
    meet under some probe.  All pairs that meet are verified on the whole fingerprint.

    Texts of any length are read whole; null and empty ones have fingerprint 0 and link like any other.  A text
    with fewer words than a shingle is one shingle.  Equal texts are compared once.
    Rows without doc_id link, but name no component unless all its ids are null; a repeated doc_id gives
    one row per repetition.  Other columns are ignored, an empty table gives no rows.
    """
    fps = staged(fingerprints(docs, shingle), "fingerprints")
    named = fps.groupBy("fingerprint").agg(F.min("doc_id").alias("low")).join(groups_of(fps, radius, block), "fingerprint")
    low = named.groupBy("part").agg(F.min("low").alias("component_id"))
    named = named.join(low, "part").select("fingerprint", "component_id")
    return fps.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def without_near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE, block: int = BLOCK) -> DataFrame:
    """One row of docs, with all its columns, of each group of near_duplicates: one of the smallest doc_id, or of none if all are null."""
    key = "_row"
    while key in docs.columns:
        key += "_"
    rows = staged(docs.withColumn(key, F.monotonically_increasing_id()), "rows")  # written, so that a row keeps its number
    fps = staged(fingerprints(rows, shingle, key), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(key).alias("row"))).alias("x")
    named = fps.groupBy("fingerprint").agg(first).join(groups_of(fps, radius, block), "fingerprint")
    kept = named.groupBy("part").agg(F.min("x").alias("x")).select(F.col("x.row").alias(key))
    return rows.join(kept, key, "left_semi").select(*docs.columns)


def op10_simhash_neardup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
