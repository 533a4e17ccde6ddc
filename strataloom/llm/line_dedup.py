"""Line dedup: exact reference counts per line key, fronted by sharded cuckoo filters.

A line's key is the line without the ASCII white space at its ends, A-Z lower-cased; keys of at
least ``min_chars`` code points take part. A key that at least two documents hold keeps its lines
only in the smallest doc_id that holds it.

State of an index (``LineIndex``), both parts reversible:

* ``refs``: one row per (key, doc_id) - the exact reference table. The count of a key is the number
  of its rows, its owner their least doc_id; inserting or deleting documents adds or removes rows.
* ``filters``: one cuckoo filter per shard of the key space over the keys held by two or more
  documents. A cuckoo filter supports deletion, so a key whose count falls below two is removed
  from it again. A filter only ever saves work: each hit is checked against the exact table.

Scale: counting is a partial aggregation on 16-byte keys (hot lines combine before the shuffle).
Shards are sized from the number of shared keys, so that one shard stays near ``SHARD_KEYS`` keys
whatever the corpus. Filters travel to the scan as a broadcast while their bytes are below
``BROADCAST_BYTES``; above, the line keys travel to the filters: they are dealt by shard (salted by
doc_id, so that a hot line is spread) and pass the filter of their shard in the task that holds it.

Defined results: a null or empty text is one empty line. A null doc_id has no identity: its row
is returned unchanged and it holds no key. Rows that repeat a doc_id count as one document, each
row being returned. An empty table gives an empty result. Extra columns are carried by
``dedup_lines`` and ignored by the digest query.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm.common import LOWER_ASCII, cut, numbered, table

MIN_CHARS = 10
SHARD_KEYS = 100_000
BROADCAST_BYTES = 48 << 20
SALTS = 16
_STRIP = b" \t\n\x0b\x0c\r"
_REF_SCHEMA = "k1 bigint, k2 bigint, doc_id bigint"


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """The key of one lower-cased UTF-8 line, or None if it is too short to take part."""
    k = line.strip(_STRIP)
    if len(k) < min_chars or (len(k) < 4 * min_chars and len(k.decode("utf-8", "surrogatepass")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(k)


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    lowered = (text or "").encode("utf-8", "surrogatepass").translate(LOWER_ASCII)
    return [line_key(x, min_chars) for x in lowered.split(b"\n")]


class CuckooFilter:
    """Partial-key cuckoo hashing: 4-slot buckets of 16-bit fingerprints in one numpy array.

    Keys that find no place after ``max_kicks`` moves are kept exactly in ``stash``, so that there
    are no false negatives at any load and every inserted key can be deleted.
    """

    SLOTS = 4

    def __init__(self, capacity: int, table: np.ndarray | None = None, stash: Iterable[tuple[int, int]] = ()):
        n = 1
        while n * self.SLOTS * 0.85 < max(1, capacity):
            n *= 2
        self.mask = n - 1
        self.table = np.zeros((n, self.SLOTS), dtype=np.uint16) if table is None else table
        self.stash = set(stash)
        self.max_kicks = 200

    @staticmethod
    def _parts(k1: int, k2: int) -> tuple[int, int]:
        return k1 & 0xFFFFFFFF, ((k2 & 0xFFFF) or 1)

    def _other(self, i: int, fp: int) -> int:
        return (i ^ (fp * 0x5BD1E995)) & self.mask

    def add(self, k1: int, k2: int) -> None:
        i, fp = self._parts(k1, k2)
        i &= self.mask
        for b in (i, self._other(i, fp)):
            free = np.flatnonzero(self.table[b] == 0)
            if len(free):
                self.table[b, free[0]] = fp
                return
        moved, b = [], i
        for kick in range(self.max_kicks):
            slot = kick % self.SLOTS
            moved.append((b, slot, int(self.table[b, slot])))
            self.table[b, slot], fp = fp, moved[-1][2]
            b = self._other(b, fp)
            free = np.flatnonzero(self.table[b] == 0)
            if len(free):
                self.table[b, free[0]] = fp
                return
        for b, slot, old in reversed(moved):
            self.table[b, slot] = old
        self.stash.add((k1, k2))

    def remove(self, k1: int, k2: int) -> None:
        if (k1, k2) in self.stash:
            self.stash.discard((k1, k2))
            return
        i, fp = self._parts(k1, k2)
        i &= self.mask
        for b in (i, self._other(i, fp)):
            at = np.flatnonzero(self.table[b] == fp)
            if len(at):
                self.table[b, at[0]] = 0
                return

    def __contains__(self, key: tuple[int, int]) -> bool:
        return bool(self.probe(np.array([key[0]], np.int64), np.array([key[1]], np.int64))[0])

    def probe(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        i = (k1 & 0xFFFFFFFF) & self.mask
        fp = k2 & 0xFFFF
        fp = np.where(fp == 0, 1, fp)
        j = (i ^ (fp * 0x5BD1E995)) & self.mask
        f16 = fp.astype(np.uint16)[:, None]
        hit = (self.table[i] == f16).any(axis=1) | (self.table[j] == f16).any(axis=1)
        if self.stash:
            hit |= np.fromiter(((int(a), int(b)) in self.stash for a, b in zip(k1, k2, strict=True)), bool, len(k1))
        return hit

    def to_bytes(self) -> bytes:
        stash = np.array(sorted(self.stash), dtype="<i8").reshape(-1, 2)
        return np.array([len(self.table), len(stash)], dtype="<i8").tobytes() + self.table.astype("<u2").tobytes() + stash.tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> CuckooFilter:
        n, s = np.frombuffer(raw, "<i8", 2)
        slots = np.frombuffer(raw, "<u2", n * cls.SLOTS, 16).reshape(n, cls.SLOTS).copy()
        stash = np.frombuffer(raw, "<i8", 2 * s, 16 + 2 * n * cls.SLOTS).reshape(s, 2)
        out = cls(1, slots, map(tuple, stash.tolist()))
        out.mask = int(n) - 1
        return out


def line_refs(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(k1, k2, doc_id): each distinct key of each document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _own_keys(b, min_chars)], ["k1", "k2", "doc_id"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(rows, _REF_SCHEMA)


def shared_keys(refs: DataFrame) -> DataFrame:
    """Keys that at least two documents hold, with their owner (least doc_id)."""
    return refs.groupBy("k1", "k2").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last")).where("owner < last").select("k1", "k2", "owner")


def build_filters(shared: DataFrame, n_shards: int, room: float = 1.0) -> DataFrame:
    """(shard, filter): one serialised cuckoo filter per shard, with room for so many times its keys."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        f = CuckooFilter(int(room * len(pdf)))
        for a, b in zip(pdf["k1"].to_numpy(), pdf["k2"].to_numpy(), strict=True):
            f.add(int(a), int(b))
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "filter": [f.to_bytes()]})

    return shared.select("k1", "k2", F.pmod(F.shiftrightunsigned("k1", 33), F.lit(n_shards)).alias("shard")).groupBy("shard").applyInPandas(build, "shard bigint, filter binary")


def shard_of(k1: np.ndarray, n_shards: int) -> np.ndarray:
    return ((k1.view(np.uint64) >> np.uint64(33)) % np.uint64(n_shards)).astype(np.int64)


def _own_keys(b: pa.RecordBatch, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(k1, k2, doc_id) of the distinct keys of each document of a batch (doc_id, text)."""
    keys: list[bytes] = []
    ids: list[int] = []
    for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
        own = {k for k in line_keys(text, min_chars) if k is not None} if doc_id is not None else ()
        keys.extend(own)
        ids.extend([doc_id] * len(own))
    two = np.frombuffer(b"".join(keys), dtype="<i8").reshape(-1, 2)
    return np.ascontiguousarray(two[:, 0]), np.ascontiguousarray(two[:, 1]), np.array(ids, dtype=np.int64)


def _probed(docs: DataFrame, filters: DataFrame, n_shards: int, n_keys: int, min_chars: int) -> DataFrame:
    """Line rows (k1, k2, doc_id) that pass the filter of their shard.

    filters: (shard, filter) rows over n_keys keys.
    """
    if n_keys * 5 > BROADCAST_BYTES:  # at most 2 bytes / 0.425 load for a key
        return _probed_in_shards(line_refs(docs, min_chars), filters, n_shards)
    raw = {int(r["shard"]): bytes(r["filter"]) for r in filters.select("shard", "filter").toLocalIterator()}
    sent = docs.sparkSession.sparkContext.broadcast(raw)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {k: CuckooFilter.from_bytes(v) for k, v in sent.value.items()}
        for b in batches:
            k1, k2, ids = _own_keys(b, min_chars)
            shards, hit = shard_of(k1, n_shards), np.zeros(len(k1), bool)
            for s, f in held.items():
                at = np.flatnonzero(shards == s)
                hit[at] = f.probe(k1[at], k2[at])
            yield pa.RecordBatch.from_arrays([pa.array(k1[hit]), pa.array(k2[hit]), pa.array(ids[hit])], ["k1", "k2", "doc_id"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(rows, _REF_SCHEMA)


def _probed_in_shards(refs: DataFrame, filters: DataFrame, n_shards: int) -> DataFrame:
    """The same, with the line rows dealt to the filters; a task holds one shard's filter at a time."""
    shard = F.pmod(F.shiftrightunsigned("k1", 33), F.lit(n_shards)).alias("shard")
    lines = refs.select("k1", "k2", "doc_id", shard, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"), F.lit(None).cast("binary").alias("filter"))
    none = [F.lit(0).cast("bigint").alias(c) for c in ("k1", "k2", "doc_id")]
    spread = filters.select(*none, F.col("shard").cast("bigint").alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "filter")
    dealt = lines.unionByName(spread).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("filter").isNull())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, of = None, -1
        for b in batches:
            k1, k2, ids, shards = (b.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            brought = np.flatnonzero(~b.column(4).is_null().to_numpy(zero_copy_only=False))
            hit = np.zeros(len(k1), bool)
            for start, end in zip(np.r_[-1, brought], np.r_[brought, len(k1)], strict=True):
                if start >= 0:
                    f, of = CuckooFilter.from_bytes(b.column(4)[int(start)].as_py()), int(shards[start])
                at = np.arange(start + 1, end)
                at = at[shards[at] == of]
                if f is not None and len(at):
                    hit[at] = f.probe(k1[at], k2[at])
            yield pa.RecordBatch.from_arrays([pa.array(k1[hit]), pa.array(k2[hit]), pa.array(ids[hit])], ["k1", "k2", "doc_id"])

    return dealt.select("k1", "k2", "doc_id", "shard", "filter").mapInArrow(rows, _REF_SCHEMA)


def _dropped(hits: DataFrame, shared: DataFrame) -> DataFrame:
    """(doc_id, dropped): per document the keys that another, smaller doc_id owns."""
    return hits.join(shared, ["k1", "k2"]).where("doc_id > owner").groupBy("doc_id").agg(F.collect_set(F.struct("k1", "k2")).alias("dropped"))


def dropped_keys(docs: DataFrame, shared: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, dropped) of docs, by new filters over the shared keys (k1, k2, owner)."""
    n = shared.count()
    n_shards = max(1, -(-n // SHARD_KEYS))
    return _dropped(_probed(docs, build_filters(shared, n_shards), n_shards, n, min_chars), shared)


def keep_lines(text: str | None, dropped: set[bytes], min_chars: int = MIN_CHARS) -> tuple[str, int, int]:
    """(kept text, number of lines, number of dropped lines)."""
    lines = (text or "").split("\n")
    if not dropped:
        return text or "", len(lines), 0
    kept = [x for x, k in zip(lines, line_keys(text, min_chars), strict=True) if k is None or k not in dropped]
    return "\n".join(kept), len(lines), len(lines) - len(kept)


def _n_words(text: str) -> int:
    return len(text.encode("utf-8", "surrogatepass").split())


def _with_kept(docs: DataFrame, drops: DataFrame, columns: list[str], min_chars: int, digest: bool, least_left: float = 0.0) -> DataFrame:
    """Rows of docs (the given columns) with the text rebuilt, or with its digest columns.

    Rows whose text keeps less than the share least_left of its words are left out.
    """
    own = numbered(docs) if not digest else docs.select(F.col("doc_id").alias("c0"), F.col("text").alias("c1"))
    at_text, key = columns.index("text"), F.col(f"c{columns.index('doc_id')}")
    joined = own.join(drops.select(F.col("doc_id").alias("_id"), F.col("dropped").alias("_dropped")), key == F.col("_id"), "left").drop("_id")
    fields = [f for f in own.schema if not digest or f.name == "c0"]
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    more = [StructField("n_lines", LongType()), StructField("n_dropped", LongType()), StructField("kept_sha256", StringType())]
    schema = StructType(fields + (more if digest else []))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, found = b.column(at_text).to_pylist(), b.column(b.num_columns - 1).to_pylist()
            made = [keep_lines(t, {np.array([x["k1"], x["k2"]], "<i8").tobytes() for x in d or ()}, min_chars) for t, d in zip(texts, found, strict=True)]
            if digest:
                sha = [hashlib.sha256(m[0].encode("utf-8", "surrogatepass")).hexdigest() for m in made]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64()), pa.array(sha, pa.string())], [f.name for f in schema])
            else:
                new = [t if m[2] == 0 else m[0] for t, m in zip(texts, made, strict=True)]
                out = pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if i == at_text else b.column(i) for i in range(len(columns))], [f.name for f in schema])
                if least_left > 0:
                    out = out.filter(pa.array([m[2] == 0 or _n_words(m[0]) >= least_left * _n_words(t) for t, m in zip(texts, made, strict=True)], pa.bool_()))
                yield out

    return joined.mapInArrow(rows, schema).toDF(*(["doc_id", *(f.name for f in more)] if digest else columns))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, least_left: float = 0.0) -> DataFrame:
    """docs with the texts that remain after line dedup; all other columns are kept as they are.

    least_left: rows that lose lines and keep less than this share of their words go as a whole (0: none).
    """
    shared = cut(shared_keys(line_refs(docs, min_chars)))
    return _with_kept(docs, dropped_keys(docs, shared, min_chars), docs.columns, min_chars, digest=False, least_left=least_left)


def line_dedup_digests(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""
    shared = cut(shared_keys(line_refs(docs, min_chars)))
    return _with_kept(docs, dropped_keys(docs, shared, min_chars), ["doc_id", "text"], min_chars, digest=True)


class LineIndex:
    """Incremental, reversible line dedup over batches of documents.

    ``refs`` grows by inserts and shrinks by deletions; ``filters`` follow by cuckoo insertion and
    deletion of the keys whose count crosses two. ``insert(d)`` then ``delete(d)`` restores both.

    A batch touches only its own keys: their references before and after it are compared, not those
    of the whole index. A filter that would be loaded beyond ``LOAD`` is built again, twice as large,
    from the exact table. Reference rows of batches stand side by side and are written together
    after ``BATCHES`` of them.
    """

    LOAD = 0.85
    BATCHES = 8
    _FILTERS = "shard bigint, n_keys bigint, filter binary"

    def __init__(self, spark: SparkSession, n_shards: int = 16, min_chars: int = MIN_CHARS):
        self.spark, self.n_shards, self.min_chars = spark, n_shards, min_chars
        self.refs = spark.createDataFrame([], _REF_SCHEMA)
        self.filters = spark.createDataFrame([], self._FILTERS)
        self._batches = 0

    def _shard(self):
        return F.pmod(F.shiftrightunsigned("k1", 33), F.lit(self.n_shards)).alias("shard")

    def _move(self, changed: DataFrame, new_refs: DataFrame) -> None:
        """Goes over to new_refs, which differ from refs in the keys (k1, k2) of changed only."""
        keys = cut(changed.select("k1", "k2").distinct())
        state = lambda refs: shared_keys(refs.join(keys, ["k1", "k2"], "left_semi")).select("k1", "k2")
        before, after = cut(state(self.refs)), cut(state(new_refs))
        signed = after.join(before, ["k1", "k2"], "left_anti").withColumn("sign", F.lit(1)).unionByName(before.join(after, ["k1", "k2"], "left_anti").withColumn("sign", F.lit(-1)))
        load = self.LOAD

        def update(key: tuple, changes: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
            gone, added = changes[changes["sign"] < 0], changes[changes["sign"] > 0]
            n = (int(state["n_keys"].iloc[0]) if len(state) else 0) + len(added) - len(gone)
            f = CuckooFilter.from_bytes(bytes(state["filter"].iloc[0])) if len(state) else CuckooFilter(max(64, 2 * len(added)))
            if n > load * f.table.size:  # to be built again from the exact table
                return pd.DataFrame({"shard": [int(key[0])], "n_keys": [n], "filter": [None]})
            for a, b in zip(gone["k1"], gone["k2"], strict=True):
                f.remove(int(a), int(b))
            for a, b in zip(added["k1"], added["k2"], strict=True):
                f.add(int(a), int(b))
            return pd.DataFrame({"shard": [int(key[0])], "n_keys": [n], "filter": [f.to_bytes()]})

        moved = cut(signed.withColumn("shard", self._shard()).groupBy("shard").cogroup(self.filters.groupBy("shard")).applyInPandas(update, self._FILTERS))
        full = [r["shard"] for r in moved.where("filter is null").select("shard").collect()]  # at most n_shards
        if full:
            again = build_filters(shared_keys(new_refs.where(self._shard().isin(full))), self.n_shards, room=2.0).join(moved.select("shard", "n_keys"), "shard")
            moved = cut(moved.where("filter is not null").unionByName(again.select("shard", "n_keys", "filter")))
        self._batches += 1
        self.refs, self.filters = (cut(new_refs) if self._batches % self.BATCHES == 0 else new_refs), moved

    def insert(self, docs: DataFrame) -> None:
        """Adds documents; a (key, doc_id) pair that is already there is not added twice."""
        new = cut(line_refs(docs, self.min_chars).distinct().join(self.refs, ["k1", "k2", "doc_id"], "left_anti"))
        self._move(new, self.refs.unionByName(new))

    def delete(self, doc_ids: DataFrame) -> None:
        """Removes every reference of the given doc_ids (a frame with a doc_id column)."""
        ids = cut(doc_ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct())
        left = self.refs.join(ids, "doc_id", "left_anti").select("k1", "k2", "doc_id")
        self._move(self.refs.join(ids, "doc_id", "left_semi"), left)

    def kept(self, docs: DataFrame) -> DataFrame:
        """docs as the present index leaves them: its filters in front of its exact table."""
        n_keys = self.filters.agg(F.sum("n_keys")).first()[0] or 0
        hits = cut(_probed(docs, self.filters, self.n_shards, n_keys, self.min_chars))
        shared = shared_keys(self.refs.join(hits.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi"))
        return _with_kept(docs, _dropped(hits, shared), docs.columns, self.min_chars, digest=False)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_digests(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH l AS (
  SELECT doc_id, i, line,
         translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
        FROM documents)
), s AS (
  SELECT k, min(doc_id) AS owner FROM l WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), m AS (
  SELECT l.*, s.owner IS NOT NULL AND l.doc_id <> s.owner AS gone FROM l LEFT JOIN s USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
