"""Token counts kept as delta-maintained rollups (operator 1).

Every committed batch is one folder with signed entries per document and their sums by
source, language and tokenizer version.  Totals are the sums of all batches' sums, so
they never need the texts again.  A batch counts from when its marker, a small file written last
and never over another, names its folder: a batch that is committed twice, or whose job is
repeated, counts once, on object stores too.  Compaction sums up the batches so far in one folder.
"""

from __future__ import annotations

import base64
import json
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cluster import new_path, remove
from .textops import chunks

TOKENIZERS = "/opt/tokenizers"
# Fixed value: how byte-level BPE of this family splits text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

LONG = 10_000  # white space of so many characters is cut off where PATTERN splits, and counted as the one piece it is
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # fixed value: characters that \s stands for in PATTERN
_GAP = re.compile(f"[{_SPACE}]{{{LONG},}}")

_KEYS = ["source", "lang", "tokenizer"]
_SUMS = ["n_docs", "n_tokens", "n_chars"]
_ENTRY = "doc_id long, source string, lang string, tokenizer string, n_docs long, n_tokens long, n_chars long"


def bpe_counter(name: str = "byte_bpe_50k", folder: str = TOKENIZERS) -> Callable[[], Callable[[list[str]], list[int]]]:
    """Counts tokens of whole texts of any length under a vocabulary of ranks; the file is read here and travels with the job."""
    raw = (Path(folder) / f"{name}.tiktoken").read_bytes()

    def make():
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
        coder = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

        def count(text: str) -> int:
            """Long white space up to its last character is one piece; the pattern would step back through all of it, in a stack that has an end."""
            total, at = 0, 0
            for m in _GAP.finditer(text) if len(text) >= LONG else ():
                end = m.end() if m.end() == len(text) else m.end() - 1
                total += len(coder.encode_ordinary(text[at : m.start()])) + len(coder._encode_single_piece(text[m.start() : end]))
                at = end
            return total + len(coder.encode_ordinary(text[at:]))

        return lambda texts: [count(t) for t in texts]

    return make


def entries(docs: DataFrame, counters: dict[str, Callable]) -> DataFrame:
    """One entry per row of docs and tokenizer version; a null text has no tokens and no characters."""

    def run(batches):
        ready = {k: make() for k, make in counters.items()}
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                for name, count in ready.items():
                    n = part.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), part.column("source"), part.column("lang"), pa.array([name] * n), pa.array([1] * n), pa.array(count(texts), pa.int64()), pa.array([len(t) for t in texts])],
                        names=["doc_id", *_KEYS, *_SUMS],
                    )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), "text")
    return rows.mapInArrow(run, _ENTRY)


@dataclass
class TokenRollup:
    """Rollup in a folder that the cluster shares; counters: per tokenizer version a maker of a counting function."""

    spark: SparkSession
    folder: str
    counters: dict[str, Callable]

    def _mark(self, name: str, **content) -> bool:
        """Writes a marker; False if there is one of that name.

        It is written under another name and then renamed, which fails if the name is taken: a marker is there whole or not at all (on HDFS and
        local disks; on stores without such a rename one driver at a time may write).  A marker without content, as a driver may have
        left that was lost between creating and writing one, counts as none.
        """
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/markers/{name}")
        fs = p.getFileSystem(conf)
        if fs.exists(p) and not fs.getFileStatus(p).getLen():
            fs.delete(p, False)
        t = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/claims/{uuid.uuid4().hex}")
        out = fs.create(t, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        fs.mkdirs(p.getParent())
        plain = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf).rename(fs.makeQualified(t), fs.makeQualified(p), plain)
        except Py4JJavaError:
            fs.delete(t, False)
            if fs.exists(p):
                return False
            raise
        return True

    def _state(self) -> tuple[list[str], set[str], int]:
        """Folders that count, ids of all committed batches, and compactions so far."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/markers")
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return [], set(), 0
        rows = self.spark.read.option("wholetext", "true").text(f"{self.folder}/markers").collect()  # one small row a batch
        marks = [json.loads(r.value) for r in rows if r.value]
        bases = [m for m in marks if "covers" in m]
        base = max(bases, key=lambda m: m["number"], default={"covers": [], "number": 0})
        covered = set(base["covers"])
        loose = [m for m in marks if "covers" not in m]
        return [*([base["path"]] if bases else []), *(m["path"] for m in loose if m["id"] not in covered)], {m["id"] for m in loose}, base["number"]

    def _read(self, kind: str, folders: list[str] | None = None) -> DataFrame | None:
        paths = [f"{self.folder}/{b}/{kind}" for b in (self._state()[0] if folders is None else folders)]
        return self.spark.read.schema(_ENTRY if kind == "entries" else _ENTRY.partition(", ")[2]).parquet(*paths) if paths else None

    def committed(self, batch_id: str) -> bool:
        return batch_id in self._state()[1]

    def _write(self, entries: DataFrame) -> str:
        path = f"data/{uuid.uuid4().hex}"
        entries.write.option("compression", "zstd").parquet(f"{self.folder}/{path}/entries")
        done = self.spark.read.schema(_ENTRY).parquet(f"{self.folder}/{path}/entries")
        done.groupBy(*_KEYS).agg(*[F.sum(c).alias(c) for c in _SUMS]).write.parquet(f"{self.folder}/{path}/sums")
        return path

    def compact(self) -> bool:
        """Sums up all batches in one folder, entries that cancel out left out; False if there is one folder or another compaction came first."""
        paths, ids, number = self._state()
        if len(paths) < 2:
            return False
        have = self._read("entries", paths).groupBy("doc_id", *_KEYS).agg(*[F.sum(c).alias(c) for c in _SUMS]).where("n_docs <> 0")
        path = self._write(have.select("doc_id", *_KEYS, *_SUMS))
        if not self._mark(f"base-{number + 1}", path=path, covers=sorted(ids), number=number + 1):
            remove(self.spark, f"{self.folder}/{path}")
            return False
        for old in paths:
            remove(self.spark, f"{self.folder}/{old}")
        return True

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Applies a batch of changes (op, doc_id, source, lang, text); False if this batch was committed before.

        op is insert, revise or delete.  A revision takes back what the document counted before
        this batch and counts its new row, under its new source and language too; so does
        an insert of a document that is there.  A delete takes back only, and is nothing for an unknown
        document.  Rows of one document in one batch all count.  A null doc_id is counted
        but can't be revised or deleted.
        """
        if not re.fullmatch(r"[A-Za-z0-9_-]+", batch_id):
            raise ValueError(f"batch ids are letters, digits, _ and -: {batch_id!r}")
        if self.committed(batch_id):
            return False
        new = entries(changes.where("op in ('insert', 'revise')"), self.counters)
        have = self._read("entries")
        if have is not None:
            ids = changes.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
            old = have.join(ids, "doc_id", "left_semi").groupBy("doc_id", *_KEYS).agg(*[(-F.sum(c)).alias(c) for c in _SUMS]).where("n_docs <> 0")
            new = new.unionAll(old)
        path = self._write(new)
        if not self._mark(f"batch-{batch_id}", id=batch_id, path=path):
            remove(self.spark, f"{self.folder}/{path}")
            return False
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens, n_chars) of the documents that are there; groups without any are left out."""
        sums = self._read("sums")
        if sums is None:
            return self.spark.createDataFrame([], _ENTRY.partition(", ")[2])
        return sums.groupBy(*_KEYS).agg(*[F.sum(c).alias(c) for c in _SUMS]).where("n_docs <> 0")


def token_totals(docs: DataFrame, counters: dict[str, Callable]) -> DataFrame:
    """Totals of a whole table, committed as two batches of inserts, the first one twice, with changes that cancel out.

    The second batch also deletes a 32nd of the documents of the first; a third inserts these again and revises
    a 32nd of those of the second; then the batches are compacted.

    Null sources and languages are groups of their own, null and empty texts count as documents
    without tokens, repeated rows all count; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rollup = TokenRollup(spark, new_path(spark, "token-rollup"), counters)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(64))  # a document's rows are in one part
    rows = docs.select("doc_id", "source", "lang", "text")
    change = lambda op, which: rows.where(which).select(F.lit(op).alias("op"), "*")
    known = F.col("doc_id").isNotNull()
    first, gone, again = part < 32, known & (part == 0), known & (part == 32)
    load = {
        "load-0": change("insert", first),
        "load-1": change("insert", ~first).unionAll(rows.where(gone).select(F.lit("delete").alias("op"), "doc_id", "source", "lang", F.lit(None).cast("string"))),
        "load-2": change("insert", gone).unionAll(change("revise", again)),
    }
    for name, batch in [*load.items(), ("load-0", load["load-0"])]:
        rollup.commit(name, batch)
    rollup.compact()
    return rollup.totals()


def op1_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_totals(spark.read.parquet(f"{sf_dir}/documents.parquet"), {"byte_bpe_50k": bpe_counter()})
