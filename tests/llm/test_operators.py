"""Operators on small fixtures: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns; brute force."""

import base64
import hashlib
import math
import random
import re
import sys
import tracemalloc
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark import cloudpickle
from pyspark.sql import functions as F

from graphloom.llm import decontamination, extraction, mixing, secrets, simhash, substrings, textops, tokencounts, toxicity, vectors, warc
from graphloom.llm.components import connected_components, forest

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(n, seed, vocabulary=300):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}é" if r.random() < 0.1 else f"w{r.randrange(vocabulary)}" for _ in range(n)]


def frame(spark, rows, schema=DOCS, **more):
    rows = [(*r, *[None] * (5 - len(r))) if schema == DOCS else r for r in rows]
    df = spark.createDataFrame(rows, schema)
    for k, v in more.items():
        df = df.withColumn(k, F.lit(v))
    return df


def components(ids, links):
    low = {i: i for i in ids}
    moved = True
    while moved:
        moved = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                moved = True
    return low


# --- kernels ----------------------------------------------------------------------------------------


def test_words_and_hashes():
    texts = ["a bb\tccc", None, "", "  ", "ccc a", "\x1c\x85x", "é ü", "end"]
    w = textops.split_words(pa.array(texts))
    want = [WORD.findall(t or "") for t in texts]
    assert w.counts.tolist() == [len(x) for x in want]
    flat = [x for t in want for x in t]
    assert [bytes(w.data[s:e]).decode() for s, e in zip(w.starts, w.ends)] == flat
    h = textops.word_hashes(w)
    assert len({(x, y) for x, y in zip(flat, h.tolist())}) == len(set(flat)) == len(set(h.tolist()))
    text, s, e = textops.joined(w)
    assert [text[a:b].decode() for a, b in zip(s, e)] == flat
    sliced = pa.array(["x x", *texts]).slice(1)
    assert textops.word_hashes(textops.split_words(sliced)).tolist() == h.tolist()


def test_window_hashes_depend_on_words_alone():
    a, b = words(50, 1), words(20, 2)
    w = textops.split_words(pa.array([" ".join(a), " ".join(b + a[10:40])]))
    at, doc = w.window_starts(13)
    h = textops.window_hashes(textops.word_hashes(w), at, 13)
    seen = {}
    for x, d, v in zip(at.tolist(), doc.tolist(), h.tolist()):
        seen.setdefault(v, set()).add(tuple(([*a, *b, *a[10:40]])[x : x + 13]))
    assert all(len(v) == 1 for v in seen.values())
    assert len(seen) == len({t for v in seen.values() for t in v}) < len(h)


def test_components(spark):
    r = random.Random(3)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5)]
    got = {x.id: x.component for x in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {i for p in links for i in p}
    want = components(ids, links)
    assert all(got.get(i, i) == want[i] for i in ids)
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    u, v = forest(np.array([3, 2, 9]), np.array([2, 1, 8]))
    assert dict(zip(u.tolist(), v.tolist())) == {3: 1, 2: 1, 9: 8}


# --- 1 token counts -----------------------------------------------------------------------------------


def by_length():
    return lambda texts: [len(t.split()) for t in texts]


def test_token_rollup(spark, tmp_path):
    roll = tokencounts.TokenRollup(spark, str(tmp_path / "roll"), {"v1": by_length, "v2": lambda: lambda ts: [len(t) for t in ts]})
    assert roll.totals().count() == 0
    change = "op string, doc_id long, source string, lang string, text string"
    first = spark.createDataFrame([("insert", 1, "s", "en", "a b c"), ("insert", 2, "s", None, None), ("insert", None, "t", "en", "x")], change)
    assert roll.commit("b1", first) and not roll.commit("b1", first)
    second = spark.createDataFrame([("revise", 1, "s", "de", "a"), ("delete", 2, None, None, None), ("delete", 99, None, None, None), ("insert", 3, "s", "de", "q w")], change)
    assert roll.commit("b2", second) and not roll.commit("b2", second)
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens, r.n_chars) for r in roll.totals().collect()}
    assert got == {("s", "de", "v1"): (2, 3, 4), ("s", "de", "v2"): (2, 4, 4), ("t", "en", "v1"): (1, 1, 1), ("t", "en", "v2"): (1, 1, 1)}
    assert roll.compact() and not roll.compact() and not roll.commit("b1", first)
    assert {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens, r.n_chars) for r in roll.totals().collect()} == got
    assert len(list((tmp_path / "roll" / "data").iterdir())) == 1 and roll._read("entries").where("n_docs < 0").count() == 0
    assert roll.commit("b3", spark.createDataFrame([("delete", 1, None, None, None), ("revise", 3, "u", "de", "q")], change)) and roll.committed("b3")
    assert roll._read("entries").where("n_docs < 0").count() == 4
    last = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in roll.totals().collect()}
    assert last == {("u", "de", "v1"): (1, 1), ("u", "de", "v2"): (1, 1), ("t", "en", "v1"): (1, 1), ("t", "en", "v2"): (1, 1)}
    with pytest.raises(ValueError):
        roll.commit("../x", first)


@pytest.mark.skipif(not Path(tokencounts.TOKENIZERS, "byte_bpe_50k.tiktoken").exists() or not Path("/root/testdata/sf0.001").exists(), reason="vocabulary and tables needed")
def test_token_query_by_brute_force(spark):
    """The whole query against a loop over the rows."""
    want = Counter()
    count = tokencounts.bpe_counter()()
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        key = (r.source, r.lang, "byte_bpe_50k")
        want[(key, 0)] += 1
        want[(key, 1)] += count([r.text or ""])[0]
        want[(key, 2)] += len(r.text or "")
    got = Counter()
    for r in tokencounts.op1_token_counts(spark, "/root/testdata/sf0.001").collect():
        for i, n in enumerate((r.n_docs, r.n_tokens, r.n_chars)):
            got[((r.source, r.lang, r.tokenizer), i)] += n
    assert got == want


def test_token_totals(spark):
    rows = [(1, "a b", "en", "s"), (1, "a b", "en", "s"), (2, None, None, None), (3, "", "en", "s")]
    got = {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in tokencounts.token_totals(frame(spark, rows, tokenizer="x", op="delete"), {"v": by_length}).collect()}
    assert got == {("s", "en"): (3, 4), (None, None): (1, 0)}
    assert tokencounts.token_totals(frame(spark, []), {"v": by_length}).count() == 0


@pytest.mark.skipif(not Path(tokencounts.TOKENIZERS, "byte_bpe_50k.tiktoken").exists(), reason="vocabulary needed")
def test_bpe_round_trip():
    assert tokencounts.bpe_counter()()(["", "hello world", "é" * 3, "<|endoftext|>"])[:2] == [0, 2]


@pytest.mark.skipif(not Path(tokencounts.TOKENIZERS, "byte_bpe_50k.tiktoken").exists(), reason="vocabulary needed")
def test_bpe_of_long_white_space(monkeypatch):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(tokencounts.TOKENIZERS, "byte_bpe_50k.tiktoken").read_bytes().splitlines())}
    coder = tiktoken.Encoding("x", pat_str=tokencounts.PATTERN, mergeable_ranks=ranks, special_tokens={})
    count = tokencounts.bpe_counter()()
    r = random.Random(3)
    texts = ["".join(r.choice([" ", "\n", "\t", "\xa0", "\u2003", "a", "é", "1", ".", "'s", " x", "\x1c"]) * r.choice([1, 1, 2, 9, 30]) for _ in range(60)) for _ in range(200)] + ["a" + " " * 50_000 + "b", "\n" * 20_000]
    monkeypatch.setattr(tokencounts, "LONG", 5)
    monkeypatch.setattr(tokencounts, "_GAP", re.compile(f"[{tokencounts._SPACE}]{{5,}}"))
    assert count(texts) == [len(coder.encode_ordinary(t)) for t in texts]
    monkeypatch.undo()
    assert all(x > 0 for x in count([" " * 1_000_000, "a" * 1_000_000, "x \n" * 300_000, "word" + "\n" * 1_000_000 + " end", "é" * 500_000]))


def test_marker_of_a_lost_driver(spark, tmp_path):
    """An empty marker is none: the batch can be committed; a whole one isn't replaced."""
    roll = tokencounts.TokenRollup(spark, str(tmp_path / "roll"), {"v1": lambda: lambda ts: [len(t) for t in ts]})
    (tmp_path / "roll" / "markers").mkdir(parents=True)
    (tmp_path / "roll" / "markers" / "batch-x").touch()
    assert not roll.committed("x")
    rows = spark.createDataFrame([("insert", 1, "s", "en", "abc")], "op string, doc_id long, source string, lang string, text string")
    assert roll.commit("x", rows) and roll.committed("x") and not roll.commit("x", rows)
    assert not roll._mark("batch-x", id="x", path="other") and [r.n_tokens for r in roll.totals().collect()] == [3]
    assert not list((tmp_path / "roll" / "claims").glob("[!.]*"))


# --- 2 embeddings ---------------------------------------------------------------------------------------


def brute_links(ids, x, cosine=0.95):
    links, n = [], Counter()
    for i in range(len(ids)):
        for j in range(i):
            if x[i] is not None and x[j] is not None and len(x[i]) == len(x[j]):
                c = float(x[i] @ x[j]) / math.sqrt(float(x[i] @ x[i])) / math.sqrt(float(x[j] @ x[j]))
                if c >= cosine:
                    links.append((i, j))
                    n[i] += 1
                    n[j] += 1
    return links, n


def test_vectors(spark):
    r = np.random.default_rng(5)
    x = []
    for k in range(12):  # clusters with spreads on both sides of the threshold
        c = r.normal(size=16)
        x += [c + r.normal(size=16) * s for s in [0.02] * 6 + [0.15] * 8 + [0.3] * 3]
    x += [r.normal(size=16) for _ in range(60)] + [r.normal(size=8)] * 2
    x = [v.astype(np.float32).astype(np.float64) for v in x]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None], [float("inf")] * 16]
    rows = [(100 + i, [float(t) for t in v], 0) for i, v in enumerate(x)] + [(i, v, 1) for i, v in enumerate(bad)]
    df = frame(spark, rows, "vec_id long, embedding array<float>, label int", n_links="x", node=1, part=2, kept=0)
    got = {r.vec_id: r for r in vectors.near_vectors(df, shard_rows=64).collect()}
    links, n = brute_links(range(len(x)), x)
    low = components(range(len(x)), links)
    assert len(got) == len(rows) and len(links) > 100
    for i in range(len(x)):
        g = got[100 + i]
        assert (g.n_links, g.component_id, g.kept) == (n[i], 100 + low[i], low[i] == i)
    for i in range(len(bad)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_small_world_recall():
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph, leaders, of = vectors.build(np.arange(3000), x)
    assert len(leaders) == 3000
    true = np.argsort(-(x[:200] @ x.T), axis=1)[:, :10]
    node = np.empty(3000, np.int64)
    node[leaders] = np.arange(3000)
    found, _ = vectors.SmallWorld.unpacked(graph.packed()).search(x[:200], 128)
    assert np.mean([np.isin(node[t], f).mean() for t, f in zip(true, found)]) >= 0.9


def test_near_vectors_search_graphs(spark, monkeypatch):
    """Links come from searches of the shards' graphs; brute force only answers audits; recall of the query is whole against brute force."""
    counted = Counter()
    search, everything = vectors.SmallWorld.search, vectors._all_near
    monkeypatch.setattr(vectors.SmallWorld, "search", lambda self, q, beam, block=256: (counted.update(searched=len(q)), search(self, q, beam, block))[1])
    monkeypatch.setattr(vectors, "_all_near", lambda graph, q, rows, least, block=512: (counted.update(compared=len(rows)), everything(graph, q, rows, least, block))[1])
    r = np.random.default_rng(2)
    x = r.normal(size=(4000, 24))
    x /= np.linalg.norm(x, axis=1)[:, None]
    graph, leaders, _ = vectors.build(np.arange(4000), x)
    counted.clear()
    q = x[:1000] + 0.05 * r.normal(size=(1000, 24))
    q /= np.linalg.norm(q, axis=1)[:, None]
    a, b = vectors.near_leaders(graph, q, 0.8)
    true = set(zip(*(y.tolist() for y in np.nonzero(q @ graph.x[: graph.n].astype(np.float64).T >= 0.8))))
    assert counted["searched"] >= 1000 + vectors.AUDIT and counted["compared"] == 0
    assert len(true & set(zip(a.tolist(), b.tolist()))) >= 0.99 * len(true) and len(true) > 900


# --- 3 archives -----------------------------------------------------------------------------------------


class Lossy(vectors.SmallWorld):
    """A graph whose searches miss nodes: up to a beam of `poor`, the last eight entries are far ones or unfilled."""

    def search(self, q, beam, block=256):
        sims = q.astype(np.float32) @ self.x.T
        ids = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
        if beam <= self.poor:
            ids[:, -8:] = np.argsort(sims, axis=1, kind="stable")[:, :8] if self.fill else -1
            if self.blind:
                ids = np.argsort(sims, axis=1, kind="stable")[:, :beam]
        got = np.take_along_axis(sims, np.maximum(ids, 0), 1)
        return ids, np.where(ids >= 0, got, -np.inf)


def lossy(x, poor, fill=True, blind=False):
    g = Lossy(x.shape[1], len(x))
    g.x[:], g.n, g.poor, g.fill, g.blind = x, len(x), poor, fill, blind
    return g


@pytest.mark.parametrize("dense", [60, 200])
@pytest.mark.parametrize("poor,fill", [(48, True), (48, False)])
def test_audit_of_dense_queries(dense, poor, fill):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((30_000, 32))
    x[:dense] = np.eye(32)[0] * 8 + 0.3 * rng.standard_normal((dense, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = x[:dense] @ x.T >= 0.806
    assert (true.sum(1) >= dense).all()
    q, n = vectors.near_leaders(lossy(x, poor, fill), x[:dense], 0.806)
    assert {(a, b) for a, b in zip(q.tolist(), n.tolist())} >= set(zip(*(y.tolist() for y in np.nonzero(true))))


def test_audit_without_pairs_in_reach():
    x = np.random.default_rng(6).standard_normal((30_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    g = lossy(x[100:], 48, blind=True)
    q, n = vectors.near_leaders(g, x[100:200], 0.999)
    assert set(zip(q.tolist(), n.tolist())) >= {(i, i) for i in range(100)}
    assert not len(vectors.near_leaders(g, x[:100], 0.999)[0])
    assert not vectors._passes(x[:100] @ x[100:].T, g.search(x[:100], 48)[0], 0.999)


def test_archives(spark, tmp_path):
    rows = [(4, "http://a/\n x", "same"), (2, None, "same"), (9, "u", None), (8, "u", ""), (7, "v", "é" * 1000), (6, "w", "other"), (None, "z", "same")]
    df = frame(spark, rows, "page_id long, url string, html string", content="c", archive="a")
    archives = warc.write_archives(df, limit=300)
    read = {r.page_id: r for r in warc.read_archives(archives).collect()}
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    for i, _, t in rows:
        assert (read[i].payload_bytes, read[i].payload_digest) == (len((t or "").encode()), sha(t))
    assert {i: (r.record_type, r.refers_to) for i, r in read.items()} == {2: ("response", None), 4: ("revisit", 2), None: ("revisit", 2), 8: ("response", None), 9: ("revisit", 8), 7: ("response", None), 6: ("response", None)}
    assert warc.write_archives(df.limit(0)).count() == 0
    names = [r.archive for r in warc.export_archives(archives, f"file://{tmp_path}").collect()]
    files = spark.read.format("binaryFile").load(f"{tmp_path}/*.warc.zst")
    assert files.count() == len(names) and {r.page_id for r in warc.read_archives(files).collect()} == set(read)
    # payloads under the least size are all responses
    small = warc.read_archives(warc.write_archives(df, least=5))
    assert {r.page_id for r in small.where("record_type = 'revisit'").collect()} == set()


def test_broken_archives():
    dictionary = warc.train_dictionary([f"sample {i} <html><body>{i * 7}</body></html>".encode() * 9 for i in range(200)], 2048)
    import zstandard as zstd

    pack = zstd.ZstdCompressor(dict_data=zstd.ZstdCompressionDict(dictionary), write_checksum=True)
    good = warc.record(5, "u", b"payload", None, False)
    head = warc.leading_frame(dictionary)
    assert [r.payload for r in warc.read_archive(head + pack.compress(good) * 2)] == [b"payload"] * 2
    broken = [good.replace(b"Content-Length: 7", b"Content-Length: 8"), good.replace(b"payload", b"paylord"), good[:-2], good.replace(b"WARC/1.1", b"WARC/9.9"), good.replace(b"WARC-Date", b"WARC Date"), good.replace(b"WARC-Record-ID", b"X-Record-ID")]
    for b in broken:
        with pytest.raises(warc.InvalidArchive):
            list(warc.read_archive(head + pack.compress(b)))
    for raw in (head + pack.compress(good)[:-3], b"junkjunkjunk", head[:-1], pack.compress(good)):
        with pytest.raises(warc.InvalidArchive):
            list(warc.read_archive(raw))


# --- 4 toxicity -----------------------------------------------------------------------------------------


def toxic_corpus(n=600, seed=2):
    r, docs, labels = random.Random(seed), [], []
    base = ["".join(r.choice("aeioust") + r.choice("lnrbd") for _ in range(r.randrange(2, 4))) for _ in range(400)]
    bad = ["stupid", "moron", "worthless"]
    for i in range(n):
        t = [r.choice(base) for _ in range(60)]
        toxic = int(r.random() < 0.25)
        if toxic:
            for _ in range(3):
                t.insert(r.randrange(60), r.choice(bad))
        docs.append((i, " ".join(t), "en", f"s{i % 3}", 0))
        labels.append((i, 1, toxic))
    return docs, labels


def test_toxicity(spark):
    docs, labels = toxic_corpus()
    more = [(10_000, "you stup1d m0r0n", "en", "x", 0), (10_001, "such a s t u p i d thing", "en", "x", 0), (10_002, "sooo stuuuupid", "en", "x", 0), (10_003, None, None, None, None), (10_004, "", None, None, None), (None, "plain", None, None, None), (10_005, "al " * 50_000, "en", "x", 0)]
    d = frame(spark, docs + more, score="x", predicted=7, toxic=1, sketch=3)
    l = frame(spark, labels + [(3, 1, None), (None, 1, 1), (77_777, 1, 1)], "doc_id long, quality int, toxic int", text="label text")
    got = {r.doc_id: r for r in toxicity.toxicity(d, l).collect()}
    truth = dict((i, t) for i, _, t in labels)
    held = [i for i in truth if got[i].held_out]
    assert 60 < len(held) < 200 and np.mean([got[i].predicted == truth[i] for i in held]) >= 0.95
    assert [got[i].predicted for i in range(10_000, 10_006)] == [1, 1, 1, 0, 0, 0] and got[None].predicted == 0 and not got[None].held_out
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    kept = toxicity.without_toxic(d, l)
    assert kept.columns == d.columns and kept.count() == sum(r.predicted == 0 for r in got.values())
    none = toxicity.toxicity(d, l.limit(0))
    assert none.where("predicted = 1").count() == 0 and toxicity.toxicity(d.limit(0), l).count() == 0


def test_votes_are_one_file(spark):
    docs, labels = toxic_corpus()
    folder = Path(toxicity.staged(spark.range(1), "here").inputFiles()[0].removeprefix("file://")).parents[1]
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    before = set(folder.glob("votes-*"))
    try:
        for k, v in zip(was, ("40", "false")):
            spark.conf.set(k, v)
        known = toxicity.learn(frame(spark, docs), frame(spark, labels, "doc_id long, quality int, toxic int"))
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    (votes,) = set(folder.glob("votes-*")) - before
    assert len(list(votes.glob("*.parquet"))) == 1 and known.n1 and known.n0  # for each file the executor starts processes


def test_counts_of_a_batch_take_little_memory():
    docs, labels = toxic_corpus()
    batch = pa.table({"text": [t for _, t, *_ in docs] * 24, "toxic": [t for *_, t in labels] * 24}).combine_chunks().to_batches()[0]
    assert batch.column("text").nbytes > 4 << 20
    sums = lambda out: {h: (a, b) for h, a, b in pa.Table.from_batches(out).group_by("h").aggregate([("ones", "sum"), ("zeros", "sum")]).select(["h", "ones_sum", "zeros_sum"]).to_pandas().itertuples(index=False)}
    one = sums(toxicity._counts([batch.slice(0, len(docs))]))
    tracemalloc.start()
    out = list(toxicity._counts([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sums(out) == {h: (24 * a, 24 * b) for h, (a, b) in one.items()} and peak < 96 << 20, peak


def test_restore(spark):
    docs, labels = toxic_corpus()
    model = toxicity.letter_model(frame(spark, docs))
    r = toxicity.Restorer(model)
    assert r.text("m0r0n W0rthless s.t.u.p.i.d") == "moron worthless stupid"
    assert r.text("plain words, and 2024 numbers; x9") == "plain words, and 2024 numbers; x9"
    texts = ["a m0ron", "s t u p i d", "stuuupid", "plain text here", "ééé", "x.y.z w", "$tupid", "idi0", "", None, "a1b", "12345 678", "the end."]
    data, off = textops.string_bytes(pa.array(texts))
    suspects = set(toxicity._suspects(data, off).tolist())
    assert {i for i, t in enumerate(texts) if t and toxicity.DISGUISED.search(t.lower())} <= suspects


def test_restore_mixed_disguises(spark):
    docs, labels = toxic_corpus()
    r = toxicity.Restorer(toxicity.letter_model(frame(spark, docs)))
    for t in ["stuupid", "stu-pid", "st*pid", '"$tupid"', "s.t.u.p.1.d", "s t u p 1 d", "s  t\nu  p i d.", "$tup1d,", "stup!d", "m0r0n,", "mor.on", "(m o r 0 n)", "worthle$$", "worthle55,", "w.o.r.t.h.l.e.5.5"]:
        out = re.findall(r"[a-z]+", r.column(pa.array([f"you {t} there"]))[0].as_py())
        assert {"stupid", "moron", "worthless"} & set(out), (t, out)
    kept = "well known numbers 2024, x9 worthless (stupid) end."
    assert {"worthless", "stupid", "known"} <= set(re.findall("[a-z]+", r.text(kept)))


def test_suspects_hold_random_disguises(spark):
    rng = random.Random(8)
    signs = {"s": "$5", "i": "1!", "o": "0", "e": "3", "a": "@4"}
    texts = ["a.s.s, b", "plain words", "", "words"]
    for _ in range(400):
        w = [rng.choice(signs[c]) if c in signs and rng.random() < 0.4 else c * rng.choice([1, 1, 2]) for c in rng.choice(["stupid", "moron", "idiot", "loser"])]
        texts.append(rng.choice(["", "see "]) + rng.choice([".", "-", " ", "  ", "\n", ""]).join(w) + rng.choice(["", ",", '"', " x"]))
    docs, _ = toxic_corpus(100)
    r = toxicity.Restorer(toxicity.letter_model(frame(spark, docs)))
    data, off = textops.string_bytes(pa.array(texts))
    suspects = set(toxicity._suspects(data, off).tolist())
    assert {i for i, t in enumerate(texts) if toxicity.DISGUISED.search(t.lower()) or r.text(t) != t} <= suspects and not suspects & {1, 2, 3}


# --- 5 substrings ---------------------------------------------------------------------------------------


def brute_repeats(rows):
    first, out = {}, {}
    for i, t in sorted((r for r in rows), key=lambda r: r[0]):
        w = WORD.findall(t or "")
        for p in range(len(w) - 12):
            first.setdefault(tuple(w[p : p + 13]), i)
    for i, t in rows:
        w, gone = WORD.findall(t or ""), set()
        for p in range(len(w) - 12):
            if first[tuple(w[p : p + 13])] < i:
                gone.update(range(p, p + 13))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.setdefault(i, []).append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("batches", [1, 3])
def test_repeats(spark, batches):
    long = words(400, 1)
    hot = words(60, 9)
    rows = [(i * 3, " ".join(words(40, 100 + i) + (hot if i % 3 == 0 else []) + words(30, 200 + i))) for i in range(60)]
    rows += [(1, " ".join(long)), (2, "\n".join(long)), (500, " ".join(long[100:112])), (501, " ".join(long[100:113])), (502, " ".join(long[50:90] + ["x"] + long[91:140]))]
    rows += [(600, None), (601, ""), (602, " \t "), (603, "é" * 20 + " " + " ".join(long[:20])), (700, " ".join(["same"] * 40)), (701, " ".join(["same"] * 14))]
    df = frame(spark, rows, "doc_id long, text string", bucket=1, kind=0, n=5, pos=2)
    got = {r.doc_id: [(r.n_words, r.n_removed, r.kept_sha256)] for r in substrings.without_repeats(df, batches).collect()}
    assert got == brute_repeats(rows)


def test_repeats_of_one_id_and_null_ids(spark):
    a, b = words(60, 1), words(60, 2)
    rows = [(5, " ".join(a)), (5, " ".join(a)), (5, " ".join(b[:5] + a[10:40])), (6, " ".join(b)), (6, " ".join(b[3:] + a[:30])), (None, " ".join(a))]
    out = substrings.without_repeats(frame(spark, rows, "doc_id long, text string"))
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.kept_sha256))
    want = brute_repeats([r for r in rows if r[0] is not None])
    assert {k: sorted(v) for k, v in got.items() if k is not None} == {k: sorted(v) for k, v in want.items()}
    assert got[None][0][:2] == (60, 0)
    assert substrings.without_repeats(frame(spark, [], "doc_id long, text string")).count() == 0


def test_index_batches_and_compaction(spark):
    parts = [words(80, 300 + i) for i in range(8)]
    rows = [(i, " ".join(p + parts[i - 1][:30] if i else p)) for i, p in enumerate(parts)]
    df = frame(spark, rows, "doc_id long, text string")
    index = substrings.WindowIndex.sized_for(df)
    claims = [index.add(df.where(F.col("doc_id") == i)).collect() for i in range(8)]
    assert index.runs <= substrings.MAX_RUNS and index.made > 8
    index.close()
    assert [len(c) for c in claims] == [0] + [1] * 7
    assert all(c[0].src == c[0].doc - 1 and c[0].words == 30 for c in claims[1:])


def test_hot_anchors_are_dealt_by_window(spark, monkeypatch):
    monkeypatch.setattr(substrings, "HOT_LEAST", 20)
    line = words(7, 77)
    rows = [(i, " ".join(words(20, 500 + i) + line + words(20, 900 + i % 40))) for i in range(80)]
    df = frame(spark, rows, "doc_id long, text string")
    assert len(substrings.WindowIndex.sized_for(df).hot)
    got = {r.doc_id: [(r.n_words, r.n_removed, r.kept_sha256)] for r in substrings.without_repeats(df, 2).collect()}
    assert got == brute_repeats(rows)


def test_windows_of_equal_hash(spark, monkeypatch):
    """Hashes cut to a few bits: most claims fail, and what repeats all the same is found by the words."""
    whole = substrings.groups_of

    def short(batch):
        g = whole(batch)
        return substrings.Groups(g.anchor & np.uint64(3), g.doc, g.pos, g.cnt, g.wins & np.uint64(7))

    monkeypatch.setattr(substrings, "groups_of", short)
    monkeypatch.setattr(substrings, "ASKS", 50)
    shared = words(30, 9)
    rows = [(i, " ".join(words(30, 40 + i) + (shared[: 14 + i % 9] if i % 3 else []) + words(15, 90 + i % 11))) for i in range(40)]
    df = frame(spark, rows, "doc_id long, text string")
    got = {r.doc_id: [(r.n_words, r.n_removed, r.kept_sha256)] for r in substrings.without_repeats(df, 3).collect()}
    assert got == brute_repeats(rows)


def test_history_does_not_move(spark):
    df = frame(spark, [(i, " ".join(words(60, i))) for i in range(30)], "doc_id long, text string")
    index = substrings.WindowIndex.sized_for(df)
    index.add(df.where("doc_id < 20"))
    old = index._rows(2).select(*substrings._NAMES)
    new = substrings._pieces(df.where("doc_id >= 20"), False).mapInArrow(substrings._map(index.buckets, index.hot), substrings._ROW)
    plan = new.groupBy("bucket").cogroup(old.groupBy("bucket")).applyInArrow(substrings._merge(True, index.buckets), substrings._ROW)
    text = plan._jdf.queryExecution().executedPlan().toString()
    index.close()
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text


# --- 6 extraction ---------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var x="</p>"</script></head><body class=home><nav><ul><li><a href=/>Menu</a></ul></nav>
<div class="ad slot1">Buy!</div><div class="layout"><div class="col-main c%d"><h1>Head &amp; line</h1><p>First   para <b>bold</b><br>more<p>Second &eacute;&#233; para with enough words to count as the main text of this page
<form>name <input></form><!-- note <p>x --><section id="comments"><p>I disagree</p></section></div><aside>side</aside></div><footer>&copy; us</footer></body></html>"""
TEXT = "Head & line\n\nFirst para bold more\n\nSecond éé para with enough words to count as the main text of this page"


def test_extract(spark):
    rows = [(i, f"https://User@Host.example:80/{i}", PAGE % i) for i in range(4)] + [(4, "https://host.example/x", None), (5, None, ""), (6, "nonsense", "no markup & none"), (7, "https://host.example/y", "<html><body><article><p>Other layout</article><p cut")]
    df = frame(spark, rows, "page_id long, url string, html string", text="t", host="h", path="p", n_chars=3)
    got = {r.page_id: r for r in extraction.extracted(df).collect()}
    assert [got[i].text for i in range(8)] == [TEXT] * 4 + ["", "", "no markup & none", "Other layout"]
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert extraction.extracted(df.limit(0)).count() == 0


def test_host_votes_decide(spark):
    main = "<html><body><div class=story{0}><p>{1}</div><div class=more{0}><p>{2}</div></body></html>"
    good = "the main story of the page " * 9
    rows = [(i, "http://h/", main.format(i, good, "x y")) for i in range(5)] + [(9, "http://h/", main.format(9, "short", "a longer teaser than the story " * 9))]
    got = {r.page_id: r.text for r in extraction.extracted(frame(spark, rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "short" and got[0] == good.strip()


@pytest.mark.parametrize(
    "body,want",
    [
        ("<article><h1>Head</h1><p>Lead</p><div class=body><p>{0}</p></div></article>", "Head Lead {0}"),
        ("<article><h1><a href=x>Head</a></h1><div class=body><p>{0}</p></div></article>", "Head {0}"),
        ("<article><div class=first>{0}{0}</div><div class=second>{0}</div></article>", "{0}{0} {0}"),
        ("<table><tr><td class=a>{0}{0}<td>{0}</table>", "{0}{0} {0}"),
        ("<div class=wrap>\n<article>\n<p>{0}</article> |</div>", "{0}"),
    ],
)
def test_extract_leaves_no_text_outside(body, want):
    text = "a long part of the story. " * 20
    got = extraction.extract("<html><body><nav>menu</nav>" + body.format(text) + "<footer>us</footer></body></html>")
    assert got.split() == want.format(text).split()


@pytest.mark.parametrize("kind", ["content-sidebar-wrap", "has-sidebar", "menu-open page", "post category-social", "widget", "sidebar post"])
def test_extract_wrappers_hold_the_article(kind):
    body = "<p>the story of the page in many words</p><div class=market-share><p>its market share</p></div><div class='share ad-2'>tweet</div>"
    comments = "<div id=comments><p>" + "readers write much more than the page has " * 9 + "</div>"
    assert extraction.extract(f"<body><div class='{kind}'>{body}</div><div class='menu'><a href=x>{'link ' * 90}</a></div>") == "the story of the page in many words\n\nits market share"
    assert extraction.extract(f"<body>{body}{comments}") == "the story of the page in many words\n\nits market share"


def test_parse_is_linear():
    import time

    begin = time.time()
    deep = "<div class=a1>" * 60_000 + "text"
    assert extraction.extract(deep) == "text" and extraction.extract(deep, extraction.best_path(extraction.parse(deep))) == "text"
    for attribute in ("data-x=it's", "x=a\"b", "x='it\"s'", "it's", '"', "=", "x=", "x = 'a>b'", "checked x=1/", "x='a'y='b'"):
        assert extraction.extract(f"<div class='content'><p {attribute}>Hello world</p><p>and more</p></div>") == "Hello world\n\nand more", attribute
    assert extraction._attributes(" Class='a b' id=x's data= \"q\" hidden href=/a/b") == {"class": "a b", "id": "x's", "data": "q", "hidden": "", "href": "/a/b"}
    for long in ("a" * 300_000, "a=" * 150_000, "a " * 150_000, "'" * 300_000, "a='" * 100_000, " " * 300_000, "=" * 300_000, "/" * 300_000):
        begin = time.time()
        extraction.extract(f"<div class='content'><p {long}>text</p></div>")
        assert time.time() - begin < 5, long[:4]
    assert extraction.extract("<b>" * 20_000 + "</i>" * 40_000 + "x") == "x"
    assert extraction.extract("<table><tr><td><p>" + "<td>" + "<b>" * 8000 + "<div>y</div>" * 8000).count("y") == 8000
    assert len(extraction.extract("<article><p>" + "many words " * 100_000)) == 1_099_999
    assert extraction.extract("<p>a<li>b</p>" * 20_000).count("a") == 20_000
    assert time.time() - begin < 60


def test_parse_survives_anything():
    for t in ["<", "<p", "</", "<!--", "<a b='", "</p></p></div>", "<b><i></b></i>", "<" * 500, "<p>" * 3000, "<a href=\"" * 50, "&#x110000;&bogus;", "<td>a<td>b", "\x00<p>\x00"]:
        extraction.extract(t)


# --- 7 secrets ------------------------------------------------------------------------------------------


def brute_base(t):
    assign = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(found)


def test_secrets(spark):
    r = random.Random(4)
    b64 = "".join(r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(44))
    texts = [
        "é password = 'abcdef12' and Token:\"x.y=z-9/+\" secret=12345", "PassWord==abcdefg api_key : zzzzzz apikey:q", "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + "xAKIAAKIA" + "C" * 14, "0" * 23 + " " + "deadbeef" * 3 + "G" + "a1" * 30,
        "𝒳 token=" + "f" * 30 + "\npasswd:  'hunter22'", f"key {b64} here", "abababababababababababab0 1111111111111111111111111111x", "antidisestablishmentarianism" * 2, "", None, "secret" * 2000, "password=aaaaaa " * 300, " ".join(words(500, 8)),
    ]
    df = frame(spark, [(i, t) for i, t in enumerate(texts)] + [(0, texts[0])], base="b", spans="s", kind="k", _x=1)
    rows = secrets.with_spans(df).collect()
    assert len(rows) == len(texts) + 1
    for x in rows:
        assert [tuple(s) for s in x.base] == brute_base(texts[x.doc_id] or "")
        assert set(map(tuple, x.base)) <= set(map(tuple, x.spans)) and x.spans == sorted(x.spans)
    by = {x.doc_id: x for x in rows}
    assert [(s.start, s.kind, s.end) for s in by[5].spans] == [(4, 3, 4 + 44)]
    assert [s for s in by[6].spans if s.kind == 3] == [] and by[7].spans == []
    clean = {x.doc_id: x.text for x in secrets.redacted(df).collect()}
    assert clean[5] == "key [SECRET] here" and clean[9] is None and clean[7] == texts[7] and clean[4] == "𝒳 [SECRET]\n[SECRET]'"
    assert secrets.redacted(df).columns == df.columns and secrets.with_spans(df.limit(0)).count() == 0


def test_columns_of_secrets_stay(spark):
    df = frame(spark, [(1, "api_key='s3cr3tv4lue' 3f2b8c1e9d4a4e6f8a7b5c0d1e2f3a4b5c6d7e8f")], _tokens="a", _cut="b", _Tests="c", x="d")
    for out in (secrets.with_spans(df), secrets.redacted(df)):
        row = out.first()
        assert (row["_tokens"], row["_cut"], row["_Tests"], row["x"]) == ("a", "b", "c", "d")
    assert len(secrets.with_spans(df).first().spans) == 2


def test_secrets_of_every_alphabet(spark):
    r = random.Random(9)
    low, up, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    keys = ["".join(r.choice(x) for _ in range(40)) for x in (low, up, low + up, low + digits + "-_", up + digits + "-_")]
    h = "".join(r.choice("0123456789abcdef") for _ in range(32))
    keys.append("-".join([h[:8], h[8:12], h[12:16], h[16:20], h[20:]]))
    df = frame(spark, [(i, f"key {k} here") for i, k in enumerate(keys)] + [(90, "-" * 60), (91, "xy" * 30)])
    got = {x.doc_id: [tuple(s) for s in x.spans] for x in secrets.with_spans(df).collect()}
    assert all(got[i] == [(4, 3, 4 + len(k))] for i, k in enumerate(keys)) and got[90] == got[91] == []


def test_identifiers_are_no_secrets(spark):
    names = "UnsupportedOperation parse_format_specifier ConnectionRefusedError int_to_decimal_string warn_default_encoding CO_FUTURE_BARRY_AS_BDFL ensure_directory_exists getElementsByTagNameNS maximum-transmission-unit src/main/resources/config".split()
    df = frame(spark, [(i, f"use {n} here") for i, n in enumerate(names)])
    assert {names[x.doc_id] for x in secrets.with_spans(df).collect() if x.spans} == set()


def test_battery_is_calibrated(spark):
    r = random.Random(6)
    good = ["".join(r.choice("0123456789abcdef") for _ in range(64)) for _ in range(300)]
    bad = ["".join(r.choice("01ab") for _ in range(64)) for _ in range(50)] + ["0123456789abcdef" * 4]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "i int, text string")
    p = {x.i: x.p for x in df.select("i", secrets._tokens("text").alias("_tokens")).select("i", F.expr("1").alias("_o"), "_tokens").select("i", F.explode(secrets.random_tests("text")).alias("x")).select("i", "x.p").collect()}
    own = np.array([p[i] for i in range(300)])
    assert 0.01 <= (own < 0.05).mean() <= 0.12 and (own < 1e-4).mean() <= 0.01
    assert all(p[300 + i] < 1e-4 for i in range(len(bad)))


def test_secrets_in_long_texts(spark):
    import time

    r = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    many = " é ".join("".join(r.choice(letters) for _ in range(24)) for _ in range(16_000)) + " password=abc123def"
    texts = ["".join(r.choice(letters) for _ in range(1_000_000)), many, "secret: hunter22 " * 60_000, " " * 1_000_000, "x" * 1_000_000]
    begin = time.time()
    df = frame(spark, list(enumerate(texts)))
    got = {x.doc_id: x for x in secrets.with_spans(df).collect()}
    took = time.time() - begin
    assert [tuple(s) for s in got[0].spans] == [(0, 3, 1_000_000)] and len(got[2].base) == 60_000 and got[3].spans == []
    assert [tuple(s) for s in got[1].base] == brute_base(many) and len(got[1].spans) > 15_000
    for x in (got[1], got[2]):
        assert all(re.fullmatch(r"[A-Za-z0-9+/]{24}|password=abc123def|secret: hunter22", texts[x.doc_id][s.start : s.end]) for s in x.spans)
    clean = {x.doc_id: x.text for x in secrets.redacted(df).collect()}
    assert clean[0] == "[SECRET]" and clean[2] == "[SECRET] " * 60_000
    spans, want, at = got[1].spans, [], 0
    for s in spans:
        want += [many[at : s.start], "[SECRET]"]
        at = s.end
    assert clean[1] == "".join([*want, many[at:]]) and took < 100, took


# --- 8 decontamination ----------------------------------------------------------------------------------


def lower(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute_hits(docs, items):
    out = {}
    for i, t in docs:
        w = lower(t)
        for j, u in items:
            v = lower(u)
            if not v or not w:
                continue
            n, k = len(v), min(5, len(v))
            b = Counter(tuple(v[p : p + k]) for p in range(n - k + 1))
            for s in range(max(1, len(w) - n + 1)):
                x = w[s : s + n]
                a = Counter(tuple(x[p : p + k]) for p in range(len(x) - k + 1))
                both = sum((a & b).values())
                if both and (c := both / (sum(a.values()) + sum(b.values()) - both)) >= 0.8:
                    out[(i, j)] = max(c, out.get((i, j), 0))
    return out


def test_decontamination(spark):
    items = [(j, " ".join(words(15 + 3 * j, 40 + j, 2000))) for j in range(14)] + [(20, None), (21, ""), (22, "tiny Item"), (23, " ".join(words(21, 42, 2000)))]
    docs = []
    for i in range(60):
        w = words(120, 700 + i, 2000)
        v = items[i % 14][1].split()
        if i % 3 == 0:
            v = [x for k, x in enumerate(v) if k != len(v) - 1 - i % 2] if i % 2 else [*v[:-1], "changed"]
        if i % 4:
            w[50:50] = [x.upper() if i % 5 == 0 else x for x in v]
        docs.append((i, "\n".join(w)))
    docs += [(100, items[3][1]), (101, " ".join(items[9][1].split()[:-3])), (102, None), (103, ""), (104, "a Tiny item!"), (105, "a tiny item b"), (100, items[3][1])]
    d = frame(spark, docs, "doc_id long, text string", item_id=1, similarity="s")
    b = frame(spark, items, "item_id long, text string", doc_id=3)
    rows = decontamination.contaminated(d, b).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in rows}
    assert got == pytest.approx(brute_hits(docs, items)) and len(got) >= 40
    assert sum(r.doc_id == 100 for r in rows) == 2 and (105, 22) in got and (104, 22) not in got
    left = decontamination.decontaminated(d, b)
    assert left.columns == d.columns and {r.doc_id for r in left.collect()} == {i for i, _ in docs} - {i for i, _ in got}
    for x, y in ((d.limit(0), b), (d, b.limit(0))):
        assert decontamination.contaminated(x, y).count() == 0


def test_blocks_find_all_within_radius():
    r = np.random.default_rng(2)
    own = r.integers(0, 2**64, 40, dtype=np.uint64)
    none = np.zeros(0, np.int64)
    items = decontamination.Items(list(range(40)), [0] * 40, [9] * 40, b"", none, none, np.zeros(0, np.uint64), {9: (np.arange(40), own, decontamination._block_tables(own))})
    flips = np.array([sum(1 << int(k) for k in r.choice(64, int(n), replace=False)) for n in r.integers(10, 40, 400)], np.uint64)
    probe = own[r.integers(0, 40, 400)] ^ flips
    want = {(i, j) for i in range(400) for j in range(40) if int(np.bitwise_count(probe[i] ^ own[j])) <= decontamination.RADIUS}
    assert set(items.within(9, probe)) == want and len(want) > 100
    assert sum(decontamination.THRESHOLDS) == decontamination.RADIUS - decontamination.BLOCKS + 1


def test_similar_windows_lie_within_the_radius():
    """Pairs of windows of 12 to 200 words with similarity 0.8 or more, at its lower end mostly: none is beyond the radius."""
    r, far, n = random.Random(5), [], 0
    for seed in range(3000):
        size = r.randrange(12, 200)
        a = words(size, seed, 4000)
        b = list(a)
        for _ in range(max(1, int(size * r.choice([0.01, 0.02, 0.022])))):
            k, how = r.randrange(len(b)), r.randrange(3)
            b[k : k + 1] = [["x"], [], [b[k], "y"]][how]
        x, y = (Counter(tuple(t[p : p + 5]) for p in range(len(t) - 4)) for t in (a, b))
        if decontamination._similarity(x, y) >= 0.8:
            prints = []
            for t in (a, b):
                w = textops.split_words(pa.array([" ".join(t)]))
                g = textops.window_hashes(textops.word_hashes(w), np.arange(len(t) - 4), 5)
                prints.append(decontamination._fingerprints(g, np.zeros(1, np.int64), len(g))[0])
            far.append(int(np.bitwise_count(prints[0] ^ prints[1])))
            n += 1
    assert n > 1500 and max(far) <= decontamination.RADIUS - 2
    print("pairs", n, "mean", np.mean(far), "deviation", np.std(far), "most", max(far))


def test_benchmark_in_passes(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "ITEM_BYTES", 200)
    items = [(j, " ".join(words(20, 40 + j, 2000))) for j in range(6)]
    docs = [(i, " ".join(words(50, 700 + i, 2000)) + " " + items[i][1]) for i in range(6)] + [(9, " ".join(words(50, 1, 2000)))]
    d, b = frame(spark, docs, "doc_id long, text string"), frame(spark, items, "item_id long, text string")
    assert len(list(decontamination.item_passes(b, 200))) > 2
    passes = decontamination.item_passes
    monkeypatch.setattr(decontamination, "item_passes", lambda x: passes(x, 200))
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(d, b).collect()} == {(i, i) for i in range(6)}
    assert [r.doc_id for r in decontamination.decontaminated(d, b).collect()] == [9]


# --- 9 mixing -------------------------------------------------------------------------------------------


def test_mixing(spark):
    import duckdb

    r = random.Random(8)
    rows = [(i, " ".join(["w"] * r.randrange(0, 60)), "en", ["a", "B", "é", None, "tiny"][min(4, int(r.expovariate(0.7)))], 0) for i in range(400)]
    rows += [(400, None, None, "a", 0), (3, "dup dup", "en", "a", 0), (None, "x y z", None, "void", 0), (401, "q", None, "zero", 0), (402, "", None, "nothing", 0)]
    df = frame(spark, rows, size="x", rank=3, target="t", taken=1, weight=5, key="k")
    got = mixing.mixed(df).select("doc_id", "size", "source_size", "target", "taken").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    want = con.execute(mixing.OP9_SQL).fetchall()
    key = lambda t: tuple((x is None, x) for x in (*t[:3], t[4]))
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert (*a[:3], a[4]) == (*b[:3], b[4]) and a[3] == pytest.approx(b[3])
    assert all(x.taken <= 3 * x.size for x in got)
    assert sum({(x.source_size, x.target): x.target for x in got}.values()) == pytest.approx(sum(x.size for x in got))
    assert mixing.mixed(df.limit(0)).count() == 0
    assert all(x.taken == 0 for x in mixing.mixed(df.withColumn("text", F.lit(None).cast("string"))).collect())


# --- 10 SimHash -----------------------------------------------------------------------------------------


def brute_fingerprint(t):
    w = lower(t)
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash(spark):
    texts = []
    for i in range(40):
        w = words(150, i)
        texts.append(" ".join(w))
        for k in range(3):
            v = list(w)
            v[random.Random(i * 9 + k).randrange(150)] = "Changed"
            texts.append("\n".join(v))
    texts += [None, "", " ", "one", "ONE", "one two three", "ÄB c", "x " * 5000]
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(5000, texts[0]), (1000, texts[0])]
    df = frame(spark, rows, fingerprint="f", rep=3, key="k", component_id="c")
    got = simhash.near_duplicates(df, block=3).collect()
    prints = {}
    for i, t in rows:
        prints[i] = brute_fingerprint(t)
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and bin(prints[a] ^ prints[b]).count("1") <= 4]
    low = components(ids, links)
    assert len(got) == len(rows) and len(links) > 30
    for x in got:
        assert x.fingerprint % 2**64 == prints[x.doc_id] and x.component_id == low[x.doc_id]
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_plan_is_complete():
    r = np.random.default_rng(3)
    fp = r.integers(0, 2**64, 500, dtype=np.uint64)
    bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(float)
    for n, m in ((500, None), (10**7, None), (10**9, None), (500, 3)):
        both = bits.T @ bits * n / 500
        groups = simhash.plan(n, both, fp) if m is None else [(g, t) for g, t in zip(simhash.bit_partitions(n, both, m), (1, 0, 1))]
        assert sorted(b for g, _ in groups for b in g) == sorted(set(b for g, _ in groups for b in g))
        masks = simhash.probe_masks(groups)
        a = fp[:200]
        b = a ^ np.array([sum(1 << int(k) for k in r.choice(64, 4, replace=False)) for _ in a], np.uint64)
        assert ((a[:, None] & masks) == (b[:, None] & masks)).any(1).all()
