"""The pipeline on a small corpus: every stage against brute force over what its predecessor kept."""

import random

import duckdb
import pytest

import corpus_pipeline
from graphloom.llm import mixing, simhash, toxicity

from .test_operators import brute_base, brute_fingerprint, brute_hits, components, frame, toxic_corpus, words

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs, labels = toxic_corpus(300)
    docs = [(i, t, lang, s, len(t)) for i, t, lang, s, _ in docs]
    items = [(j, " ".join(words(25, 40 + j, 2000))) for j in range(4)]
    plain = [" ".join(words(150, 900 + i, 3000)) for i in range(40)]
    more = plain + plain[:5] + [p + " end" for p in plain[5:9]]
    more += [p + " " + items[i % 4][1] for i, p in enumerate(" ".join(words(90, 1900 + i, 3000)) for i in range(8))]
    more += [p + " password=abc123def" for p in (" ".join(words(80, 2900 + i, 3000)) for i in range(6))] + [None, "", ""]
    docs += [(1000 + i, t, "en", f"s{i % 4}", len(t or "")) for i, t in enumerate(more)]
    random.Random(1).shuffle(docs)
    frame(spark, docs).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def test_stages(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-dedup", "benchmark decontamination", "secret scans", "mixing"]
    stage = [f for _, f in corpus_pipeline.STAGES]
    rows = {r.doc_id: tuple(r) for r in docs.collect()}

    toxic = {r.doc_id for r in toxicity.toxicity(docs, spark.read.parquet(f"{path}/labels.parquet")).where("predicted = 1").collect()}
    one = stage[0](spark, docs, path).cache()
    assert one.columns == COLUMNS and 40 < len(toxic) < 120
    assert {r.doc_id: tuple(r) for r in one.collect()} == {k: v for k, v in rows.items() if k not in toxic}

    kept = {r.doc_id: r.text for r in one.collect()}
    prints = {i: brute_fingerprint(t) for i, t in kept.items()}
    ids = sorted(prints)
    low = components(ids, [(a, b) for a in ids for b in ids if a < b and bin(prints[a] ^ prints[b]).count("1") <= 4])
    two = stage[1](spark, one, path).cache()
    assert two.columns == COLUMNS and {r.doc_id for r in two.collect()} == {i for i in ids if low[i] == i} and two.count() < len(ids)

    kept = [(r.doc_id, r.text) for r in two.collect()]
    hit = {i for i, _ in brute_hits(kept, items)}
    three = stage[2](spark, two, path).cache()
    assert three.columns == COLUMNS and {r.doc_id for r in three.collect()} == {i for i, _ in kept} - hit and len(hit) == 8

    four = stage[3](spark, three, path).cache()
    was = {r.doc_id: r.text for r in three.collect()}
    now = {r.doc_id: r for r in four.collect()}
    assert four.columns == COLUMNS and set(now) == set(was)
    for i, t in was.items():
        if brute_base(t or ""):
            assert "password" not in now[i].text and "[SECRET]" in now[i].text and now[i].n_chars == len(now[i].text)
        else:
            assert now[i].text == t
    assert sum("[SECRET]" in (r.text or "") for r in now.values()) == 6

    con = duckdb.connect()
    con.execute("CREATE TABLE d (doc_id BIGINT, source VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO d VALUES (?, ?, ?)", [(r.doc_id, r.source, r.text) for r in now.values()])
    want = {i: k for i, *_, k in con.execute(mixing.mix_sql("d")).fetchall() if k}
    five = {r.doc_id: r for r in stage[4](spark, four, path).collect()}
    assert {i: r.taken for i, r in five.items()} == want and all(tuple(r)[:5] == tuple(now[i]) for i, r in five.items())


def test_run_of_empty_table_and_null_ids(spark, folder, tmp_path):
    path, _ = folder
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{path}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    docs = spark.read.parquet(f"{path}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    text = " ".join(words(60, 77, 3000))
    frame(spark, [(None, text, "en", "s", 1), (None, text, "en", None, 1), (None, None, None, None, None), (7007, "", "en", "s", 0), (8008, text.replace("w", "W"), "en", "s", 1)]).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.drop_near_duplicates(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), "")
    assert {r.doc_id for r in kept.collect()} == {7007, 8008}
    assert [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()] == [8008]


def test_near_duplicates_without_or_with_repeated_ids(spark):
    a, b, c, d, e = (" ".join(words(90, 50 + i, 3000)) for i in range(5))
    docs = frame(spark, [(1, a), (1, a), (1, a), (2, b), (3, b), (2, c), (5, d), (None, d), (None, e), (None, e)])
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(1, a), (2, b), (2, c), (5, d), (None, e)], key=str)
    rows = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(rows, key=str) == sorted([(1, 1)] * 3 + [(2, 2), (3, 2), (2, 2), (5, 5), (None, 5), (None, None), (None, None)], key=str)


def test_run(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, path)
    got = corpus_pipeline.run(spark, path)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))
