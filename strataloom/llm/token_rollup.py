"""Token counts: rollups by source, language and tokenizer version, maintained by signed deltas.

State is two tables under one folder:

* ``deltas``: what each committed batch added to each group, one row per (batch_id, source, lang,
  tokenizer) with signed n_docs, n_tokens, n_words, n_chars. Totals are sums over it: additive,
  order-free, never rewritten.
* ``counts``: signed per-document count rows of each batch, from which a deletion or revision takes
  back exactly what an earlier batch had added, without the text.

A batch is a set of operations: ``insert`` (+ counts of the text), ``delete`` (- the present
counts), ``revise`` (- the present counts, + the new ones; also with a new tokenizer version).
Commit: both tables are written to a folder of their own under ``data``, then a small file named by
the batch id is renamed into ``commits``; this rename, which never replaces a file, is the commit point,
and the file says which folder holds the batch. A batch id that is already there is skipped, so that a
replayed batch changes nothing; a folder that no commit names is never read. ``compact`` folds all
committed batches into one base (live rows and totals only); their ids stay known. Batches that touch the same documents are not to be applied at
once. Inserting a
document that is present is a revision, and deleting one that is not changes nothing.

Scale: tokenizing is a narrow scan of the batch; its counts are aggregated partially before the
shuffle (a hot source adds one row per task). Applying a batch reads the narrow count rows once and
aggregates those of its own doc_ids only, a uniform key; a small batch is broadcast to them. Runs of
more than ``MAX_SPACES`` white-space characters are encoded in pieces of that many (the encoder's pattern
would recurse over a whole run), so their tokens are those of the pieces.

Defined results: null texts count 0; null source or language are groups of their own. A null
doc_id can be inserted but not found again, hence not deleted or revised. Rows of a batch that
repeat a doc_id are counted each. Empty batches commit and change nothing; an empty batch id is refused. Extra columns are
ignored.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm.common import cut, shared_dir, table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
GROUP = ["source", "lang", "tokenizer"]
MEASURES = ["n_docs", "n_tokens", "n_words", "n_chars"]
BROADCAST_IDS = 1_000_000
MAX_SPACES = 4096
#: Length of a file name that stores allow, less some.
MAX_NAME = 240
_DELTA_SCHEMA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, n_words bigint, n_chars bigint"
_COUNT_SCHEMA = f"doc_id bigint, {_DELTA_SCHEMA}"


#: Fixed value: the split pattern that belongs to the byte-level vocabulary file.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=4)
def _encoder(path: str):
    """The encoder of a vocabulary file of base64 pieces and ranks; control strings are ordinary text."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str) -> list[str]:
    """The text, cut inside its runs of more than MAX_SPACES white-space characters."""
    if len(text) <= MAX_SPACES:
        return [text]
    cuts = [c for m in re.finditer(rf"\s{{{MAX_SPACES + 1},}}", text) for c in range(m.start() + MAX_SPACES, m.end(), MAX_SPACES)]
    return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)], strict=True)]


def token_counts(texts: list[str | None], path: str) -> list[int]:
    e = _encoder(path)
    return [sum(len(e.encode_ordinary(p)) for p in pieces(x)) if x else 0 for x in texts]


def count_documents(docs: DataFrame, version: str, path: str = TOKENIZER) -> DataFrame:
    """One count row per row of docs (doc_id, source, lang, text) under a tokenizer version."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            n = len(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("source"), b.column("lang"), pa.array([version] * n, pa.string()), pa.array([1] * n, pa.int64()),
                 pa.array(token_counts(texts, path), pa.int64()), pa.array([len((x or "").encode("utf-8", "surrogatepass").split()) for x in texts], pa.int64()), pa.array([len(x or "") for x in texts], pa.int64())],
                ["doc_id", *GROUP, *MEASURES],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), "text").mapInArrow(rows, _COUNT_SCHEMA)


def _file_name(batch_id: str) -> str:
    """The id with all but letters, digits and - percent-encoded: an id that begins with _ or . or holds
    a / would be hidden, or nested, under its own name."""
    raw = batch_id.encode("utf-8", "surrogatepass")
    name = re.sub(rb"[^A-Za-z0-9-]", lambda m: b"%%%02X" % ord(m[0]), raw).decode()
    if not 0 < len(name) <= MAX_NAME:
        raise ValueError(f"a batch id has 1 to {MAX_NAME} characters (others than letters, digits and - count three), not {len(name)}")
    return name


class TokenRollup:
    """The rollup in a folder (by default a new one in the session's shared folder)."""

    def __init__(self, spark: SparkSession, path: str, tokenizer_path: str = TOKENIZER):
        self.spark, self.path, self.tokenizer_path = spark, path.rstrip("/"), tokenizer_path

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        """Names of the files in a folder of small files, in order; staged ones left out."""
        jvm, fs = self._fs()
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        return sorted(n for s in fs.listStatus(p) if not (n := s.getPath().getName()).startswith((".", "_"))) if fs.exists(p) else []

    def _load(self, name: str) -> dict:
        jvm, fs = self._fs()
        f = fs.open(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}"))
        try:
            return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(f)))
        finally:
            f.close()

    def _put(self, name: str, content: dict) -> bool:
        """Creates a small file whole, by one rename that replaces nothing; False if it is there."""
        jvm, fs = self._fs()
        Path = jvm.org.apache.hadoop.fs.Path
        staged, final = Path(f"{self.path}/_staged/{uuid.uuid4().hex}"), Path(f"{self.path}/{name}")
        fs.mkdirs(final.getParent())
        out = fs.create(staged, False)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(staged, final, options)
        except Exception as e:
            if not fs.exists(final):
                raise OSError(f"{name} could not be committed in {self.path}") from e
            fs.delete(staged, False)
            return False
        return True

    def committed(self) -> list[str]:
        """Ids of the committed batches, in order."""
        return sorted(unquote(n, errors="surrogatepass") for n in self._names("commits"))

    def _base(self) -> dict:
        """The newest base: its number, its folder (null at first), and the batches it holds."""
        found = self._names("bases")
        return self._load(f"bases/{found[-1]}") if found else {"number": 0, "folder": None, "batches": []}

    def _read(self, part: str, schema: str, done: list[str] | None = None) -> DataFrame:
        """Rows of a table, of all committed batches or of the given ones (which hold those of the base)."""
        base = self._base()
        later = sorted(set(self.committed() if done is None else done) - set(base["batches"]))
        folders = [base["folder"]] * bool(base["folder"]) + [self._load(f"commits/{_file_name(b)}")["folder"] for b in later]
        found = [f"{self.path}/data/{f}/{part}" for f in folders]
        return self.spark.read.schema(schema).parquet(*found) if found else self.spark.createDataFrame([], schema)

    def counts(self, ids: DataFrame | None = None) -> DataFrame:
        """The present count row of each document (of the given doc_ids) and tokenizer version (zero rows left out)."""
        rows = self._read("counts", _COUNT_SCHEMA)
        if ids is not None:
            rows = rows.join(ids, "doc_id", "left_semi")
        live = rows.groupBy("doc_id", *GROUP).agg(*[F.sum(m).alias(m) for m in MEASURES])
        return live.where("n_docs <> 0")

    def totals(self) -> DataFrame:
        """n_docs, n_tokens, n_words, n_chars by source, lang and tokenizer version."""
        rows = self._read("deltas", _DELTA_SCHEMA)
        return rows.groupBy(*GROUP).agg(*[F.sum(m).alias(m) for m in MEASURES]).where("n_docs <> 0")

    def apply(self, batch_id: str, upserts: DataFrame | None = None, deletes: DataFrame | None = None, version: str = "v1") -> bool:
        """Commits one batch: upserts (documents to insert or revise), deletes (a doc_id column).

        Returns False, and changes nothing, if the batch id is committed already.
        """
        name = _file_name(batch_id)
        if batch_id in self.committed():
            return False
        folder = f"batch-{uuid.uuid4().hex}"
        signed = self.spark.createDataFrame([], _COUNT_SCHEMA)
        touched = [d.select(F.col("doc_id").cast("bigint").alias("doc_id")) for d in (upserts, deletes) if d is not None]
        if touched and self.committed():
            ids = cut((touched[0] if len(touched) == 1 else touched[0].unionByName(touched[1])).distinct())
            old = self.counts(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids)
            signed = signed.unionByName(old.select("doc_id", *GROUP, *[(-F.col(m)).alias(m) for m in MEASURES]))
        if upserts is not None:
            signed = signed.unionByName(count_documents(upserts, version, self.tokenizer_path))
        signed.write.parquet(f"{self.path}/data/{folder}/counts")
        rows = self.spark.read.schema(_COUNT_SCHEMA).parquet(f"{self.path}/data/{folder}/counts")
        rows.groupBy(*GROUP).agg(*[F.sum(m).alias(m) for m in MEASURES]).write.parquet(f"{self.path}/data/{folder}/deltas")
        return self._put(f"commits/{name}", {"folder": folder})

    def compact(self) -> bool:
        """Folds all committed batches into a new base; False if there are none, or another run was first."""
        base, done = self._base(), self.committed()
        if set(done) == set(base["batches"]):
            return False
        folder = f"base-{uuid.uuid4().hex}"
        live = self._read("counts", _COUNT_SCHEMA, done).groupBy("doc_id", *GROUP).agg(*[F.sum(m).alias(m) for m in MEASURES]).where("n_docs <> 0")
        live.write.parquet(f"{self.path}/data/{folder}/counts")
        kept = self.spark.read.schema(_COUNT_SCHEMA).parquet(f"{self.path}/data/{folder}/counts")
        kept.groupBy(*GROUP).agg(*[F.sum(m).alias(m) for m in MEASURES]).write.parquet(f"{self.path}/data/{folder}/deltas")
        return self._put(f"bases/{base['number'] + 1:012d}", {"number": base["number"] + 1, "folder": folder, "batches": done})


def rows_of_language(docs: DataFrame, lang: str) -> DataFrame:
    """All rows, of any language, of the non-null doc_ids that have a row in lang."""
    known, own = docs.where("doc_id is not null"), F.coalesce(F.col("lang") == lang, F.lit(False))
    both = cut(known.groupBy("doc_id").agg(F.max(own).alias("some"), F.min(own).alias("all")).where("some and not all").select("doc_id"))
    n = both.count()
    if not n:
        return known.where(own)
    ids = F.broadcast(both) if n <= BROADCAST_IDS else both  # few: the texts need no shuffle
    return known.where(own).unionByName(known.where(~own).join(ids, "doc_id", "left_semi").select(*docs.columns))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four commits: all documents in, those of one language out, the first batch
    replayed, the same rows in again. They equal the counts of the whole table."""
    docs = table(spark, sf_dir, "documents")
    rollup = TokenRollup(spark, f"{shared_dir(spark)}/token-rollup-{uuid.uuid4().hex}")
    moved = rows_of_language(docs, "es")
    rollup.apply("000-load", upserts=docs, version="byte_bpe_50k")
    rollup.apply("001-withdraw", deletes=moved.select("doc_id"))
    rollup.apply("000-load", upserts=docs, version="byte_bpe_50k")
    rollup.apply("002-restore", upserts=moved, version="byte_bpe_50k")
    return rollup.totals()


# The tokenizer is not in SQL; documents, words and characters are.
OP6_COUNT_SQL = r"""
SELECT source, lang, 'byte_bpe_50k' AS tokenizer, count(*) AS n_docs,
       sum(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')))::BIGINT AS n_words, sum(length(coalesce(text, '')))::BIGINT AS n_chars
FROM documents GROUP BY source, lang
"""
