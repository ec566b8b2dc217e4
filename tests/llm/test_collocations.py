"""Collocations against brute force and on odd inputs."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from graphloom.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, least, longest, covered, top):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        good = {p: a for p, a in counts.items() if a >= least and len(p) > 1}
        found = []
        for p, a in good.items():
            longer = [q for q in good if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * good[q] >= covered * a for q in longer):
                continue
            score, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


def texts(seed, n=120):
    r = random.Random(seed)
    words = ["the", "The", "of", "é", "ß", "漢字", "new", "york", "city", "a b", "x#", "NEW", "zürich"]
    fixed = ["new york city hall", "of the", "Zürich é ß", "x# x# x# x# x#"]
    rows = []
    for _ in range(n):
        parts = [r.choice(fixed) if r.random() < 0.4 else r.choice(words) for _ in range(r.randrange(40))]
        rows.append(("".join(p + r.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "?!", "\r\n"]) for p in parts), r.choice(["en", "en", "en", "de", "und", None])))
    return [*rows, (None, "en"), ("", None), ("...", "de"), ("  \t", "fr"), ("ÉCOLE École " * 50, "fr"), ("a" * 50_000, "fr")]


def collect(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_brute_force(spark, monkeypatch):
    for seed, least, longest, top, limit in ((1, 5, 4, 2000, 1 << 20), (2, 3, 4, 7, 300), (3, 8, 2, 50, 100)):
        rows = texts(seed)
        df = spark.createDataFrame([(i, *x) for i, x in enumerate([*rows, rows[0]])], SCHEMA).withColumn("n", F.lit("clash")).withColumn("id", F.lit(0)).withColumn("word", F.lit(1))
        cut = C.cut
        monkeypatch.setattr(C, "cut", lambda batches, limit=limit, cut=cut: cut(batches, limit))
        got = collect(C.collocations(df.repartition(3), least, longest, 80, top))
        monkeypatch.setattr(C, "cut", cut)
        assert got == brute([*rows, rows[0]], least, longest, 80, top) and got


def test_longer_phrases(spark):
    rows = texts(5)
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], SCHEMA)
    assert collect(C.collocations(df, 4, 6, 60, 100)) == brute(rows, 4, 6, 60, 100)


def test_hot_phrase_over_blocks(spark, monkeypatch):
    """One pair in every block, and a piece longer than a block."""
    rows = [("of the " * 400, "en")] * 60 + [("of the, " * 50, "en")] * 20
    cut = C.cut
    monkeypatch.setattr(C, "cut", lambda batches: cut(batches, 500))
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], SCHEMA)
    assert collect(C.collocations(df)) == brute(rows, 30, 4, 80, 2000)


def test_nothing_frequent(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.collocations(empty).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert not collect(C.collocations(empty))
    assert not collect(C.collocations(spark.createDataFrame([(1, "once only", "en"), (2, None, None)], SCHEMA)))


def test_scores_beyond_64_bits(spark):
    big = 4 * 10**18
    row = spark.range(1).select(F.lit(big).alias("f"), F.array(F.lit(big), F.lit(big)).alias("heads"), F.array(F.lit(big + 7), F.lit(big)).alias("tails"))
    assert row.select(C._weakest_cut(2).alias("x")).first().x.score == 2_000_000 * big // (2 * big + 7)
