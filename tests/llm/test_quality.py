"""Quality rules: statistics against brute force, trees' monotonicity, held-out accuracy, odd inputs."""

import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from graphloom.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string"
DATA = Path("/root/testdata/sf0.01")


def brute(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    times = Counter(windows)
    covered = {j for i, x in enumerate(windows) if times[x] > 1 for j in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)]


def texts(seed, n=60):
    r = random.Random(seed)
    parts = ["a", "the", "é漢", "x#", "|", "Ab1.", "$%", "end?", "word"]
    out = []
    for _ in range(n):
        lines = [" ".join(r.choices(parts[: r.randrange(1, 9)], k=r.randrange(14))) for _ in range(r.randrange(8))]
        out.append(r.choice(["\n", "\n", "\r\n", " \n\n"]).join(r.choices(lines, k=len(lines) * 2)) if lines else "")
    return [*out, None, "", "\n\n", " ", "\na\n", "a\na", "a b c d e f g h " * 2, "a b c d e f g h a b c d e f g", "w " * 5000, "x" * 100_000, "\x1c\x85"]


def test_counts(monkeypatch):
    rows = texts(3)
    counts, features = Q.statistics(pa.array(rows, pa.string()))
    assert counts.tolist() == [brute(t) for t in rows]
    assert np.isfinite(features).all() and features.shape == (len(rows), len(Q.FEATURES))
    alone = np.vstack([Q.statistics(pa.array([t], pa.string()))[1] for t in rows])
    assert np.array_equal(alone, features)  # a text's statistics don't depend on its neighbours
    monkeypatch.setattr(Q, "window_hashes", lambda h, at, n: np.zeros(len(at), np.uint64))  # all hashes collide
    assert Q.statistics(pa.array(rows, pa.string()))[0].tolist() == [brute(t) for t in rows]
    assert Q.statistics(pa.array([], pa.string()))[0].shape == (0, 5)


def test_trees_fit_and_stay_monotonic():
    r = np.random.default_rng(1)
    x = r.random((3000, 4))
    y = ((x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) - x[:, 2] + 0.2 * r.standard_normal(3000)) > 0).astype(float)
    y[x[:, 0] > 0.9] = r.random((x[:, 0] > 0.9).sum()) > 0.7  # against the sign
    trees = Q.fit_trees(x, y, [1, 0, -1, 0])
    assert ((trees.scores(x) > 0.5) == y)[x[:, 0] <= 0.9].mean() > 0.85
    for f, sign in ((0, 1), (2, -1)):
        for row in r.random((50, 4)):
            line = np.repeat(row[None], 200, axis=0)
            line[:, f] = np.linspace(0, 1, 200)
            assert (sign * np.diff(trees.scores(line)) >= -1e-12).all()
    free = Q.fit_trees(x, y, [0, 0, 0, 0])
    line = np.tile([0.0, 0.5, 0.2, 0.5], (200, 1))
    line[:, 0] = np.linspace(0, 1, 200)
    assert (np.diff(free.scores(line)) < 0).any()
    # node arrays against a walk down each tree
    def walk(v):
        s = trees.start
        for f, c, leaf in zip(trees.feature, trees.cut, trees.value):
            i = 0
            while i < len(f):
                i = 2 * i + (2 if v[f[i]] > c[i] else 1)
            s += leaf[i - len(f)]
        return 1 / (1 + np.exp(-s))
    assert np.allclose([walk(v) for v in x[:100]], trees.scores(x[:100]))


def test_one_kind_of_labels():
    for y, want in ((np.ones(5), 1), (np.zeros(5), 0), (np.zeros(0), 1)):
        s = Q.fit_trees(np.zeros((len(y), 2)), y, [0, 0]).scores(np.ones((3, 2)))
        assert ((s >= 0.5) == want).all()


def test_rows_and_columns(spark):
    rows = [(i, t) for i, t in enumerate(texts(8))] + [(None, "plain words " * 20), (0, "again")]
    docs = spark.createDataFrame(rows, DOCS).withColumn("quality", F.lit("clash")).withColumn("score", F.lit(1))
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, None), (None, 1), (9999, 0), (2, 0), (2, 1)], "doc_id long, quality int")
    got = Q.quality(docs, labels).collect()
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == sorted((str(i), *brute(t)) for i, t in rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and r.kept == (not r.base_failed and r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    kept = Q.without_poor(docs, labels)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in got if r.kept)
    empty = Q.quality(docs.limit(0), labels.limit(0))
    assert not empty.collect() and empty.columns[0] == "doc_id"
    assert all(r.kept != r.base_failed for r in Q.quality(docs, labels.limit(0)).collect())


@pytest.mark.skipif(not DATA.exists(), reason="driver tables are needed")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = Q.quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = [r.kept == (r.quality > 0) for r in rows if not r.base_failed]
    assert len(right) > 30 and sum(right) / len(right) > 0.9
    assert sum(r.kept for r in rows if r.quality > 0 and not r.base_failed) / sum(r.quality > 0 and not r.base_failed for r in rows) > 0.95
