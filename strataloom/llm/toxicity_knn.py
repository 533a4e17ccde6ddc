"""Toxicity: nearest labelled examples by exact TF-IDF cosine over a block-max inverted index.

Fit, on labelled rows outside the held-out fold (crc32 of the doc_id's text mod 5 is 0):

1. at most about ``max_labelled`` rows (by a hash of doc_id; the documented bound of the labelled
   sample, and the only bound);
2. the vector space is the whole vocabulary of these rows. A term weighs
   (1 + ln tf) * idf * relevance: idf over all documents, relevance z^2 / (z^2 + ``relevance``^2) with
   z the difference of the term's share of documents between the labels in standard errors. No term
   is left out; one that says nothing about the label weighs little;
3. the examples' unit vectors as postings, with the largest weight of each term in each block of
   ``BLOCK`` examples, and as rows for the last step of a search.

Scoring a document: the postings of its weightiest terms are added up; the block maxima bound what
the other terms can add in each block; when the bounds leave few examples that can still be among
the k best, those are compared in full, so that the k neighbours are exact. (A text with few postings
has all of them added up, which gives the same.) Their votes are weighted
by cosine over (distance + 0.1) and smoothed with the base rate; a logistic map fitted on leave-one-out
scores of the examples calibrates them. Documents without any term of the space get the examples'
rate of that case.

Scale: the documents are scanned twice (document frequencies, scores) without a shuffle of text; the
frequencies are summed per task before their shuffle. What is broadcast or sent to the driver is the
vocabulary and the index of the labelled sample: about max_labelled * distinct words of a text.

Defined results: null and empty texts are scored like any text without terms. A null doc_id is
scored with held_out false. Repeated rows are each scored; repeated label rows of a doc_id count
as its largest label, and of repeated texts the least is the example; null labels are ignored.
Without usable labels every score is 0. An empty table gives an empty result. Extra columns are
ignored by ``score``, kept by ``reject_toxic``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from strataloom.llm.common import fresh, numbered, stored, table

MAX_LABELLED = 4000
RELEVANCE = 5.0
NEIGHBOURS = 15
BLOCK = 64
FOLDS = 5
FEW = 96
FIRST_TERMS = 128
CHEAP = 100_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def _entries(off: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the entries of the given rows of a ragged table, entries of each row)."""
    lo = off[rows]
    n = off[rows + 1] - lo
    end = np.cumsum(n)
    at = np.repeat(lo - end + n, n)
    at += np.arange(len(at))
    return at, n


def _sums(off: np.ndarray, rows: np.ndarray, by: np.ndarray, key: np.ndarray, weight: np.ndarray, n_keys: int) -> np.ndarray:
    """Sum by key of the weights of the given rows' entries, each row times its factor."""
    at, n = _entries(off, rows)
    w = np.take(weight, at)
    w *= np.repeat(by, n)
    return np.bincount(np.take(key, at), weights=w, minlength=n_keys)


def _f(dtype=float):
    return field(default_factory=lambda: np.zeros(0, dtype))


@dataclass
class Index:
    """Block-max inverted index over the examples' unit vectors, with the calibration.

    Ragged tables are an array of offsets and flat columns: postings and block maxima by term, rows
    of the examples by position.
    """

    terms: dict[str, int] = field(default_factory=dict)  # word -> term
    weight: np.ndarray = _f()  # idf * relevance of each term
    ids: np.ndarray = _f(np.int64)
    labels: np.ndarray = _f()
    post_off: np.ndarray = _f(np.int64)
    post_ex: np.ndarray = _f(np.int64)
    post_w: np.ndarray = _f()
    block_off: np.ndarray = _f(np.int64)
    block_id: np.ndarray = _f(np.int64)
    block_max: np.ndarray = _f()
    row_off: np.ndarray = _f(np.int64)
    row_term: np.ndarray = _f(np.int64)
    row_w: np.ndarray = _f()
    term_max: np.ndarray = _f()
    base_rate: float = 0.0
    rate_without: float = 0.0
    slope: float = 1.0
    intercept: float = 0.0

    def vector(self, counts: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
        """(terms ascending, unit weights) of the words that the space knows and that weigh anything."""
        get = self.terms.get
        t, tf = np.array([get(w, -1) for w in counts], dtype=np.int64), np.fromiter(counts.values(), float, len(counts))
        t, tf = t[t >= 0], tf[t >= 0]
        w = (1.0 + np.log(tf)) * self.weight[t]
        t, w = t[w > 0], w[w > 0]
        o = np.argsort(t)
        t, w = t[o], w[o]
        n = math.sqrt(float(w @ w))
        return t, (w / n if n else w)

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int = NEIGHBOURS, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest examples (ties: the lower position), exactly."""
        n = len(self.ids)
        if not len(t) or not n:
            return np.zeros(0, np.int64), np.zeros(0)
        o = np.argsort(-w * self.term_max[t], kind="stable")
        ot, ow = t[o], w[o]
        part, done, step = np.zeros(n), 0, FIRST_TERMS
        if int((self.post_off[t + 1] - self.post_off[t]).sum()) <= CHEAP:
            step = len(ot)  # so few postings are added up sooner than bounded
        while done < len(ot):
            now = slice(done, done + step)
            part += _sums(self.post_off, ot[now], ow[now], self.post_ex, self.post_w, n)
            done, step = min(done + step, len(ot)), step * 2
            if without >= 0:
                part[without] = 0.0
            if done == len(ot) or n <= k:
                continue
            least = np.partition(part, n - k)[n - k]  # the k-th best cosine is no less
            if least <= 0:
                continue
            rest = _sums(self.block_off, ot[done:], ow[done:], self.block_id, self.block_max, -(-n // BLOCK))
            able = np.flatnonzero(part + np.repeat(rest, BLOCK)[:n] >= least - 1e-9)
            if len(able) <= max(FEW, 4 * k):
                return self._best(able[able != without], self._cosines(able[able != without], t, w), k)
        found = np.flatnonzero(part > 0)
        return self._best(found, part[found], k)

    def _cosines(self, some: np.ndarray, t: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The whole cosines of a few examples."""
        if not len(some):
            return np.zeros(0)
        q = self.__dict__.setdefault("_query", np.zeros(len(self.weight)))  # all zeros between calls
        q[t] = w
        at, m = _entries(self.row_off, some)
        cos = np.add.reduceat(np.take(q, np.take(self.row_term, at)) * np.take(self.row_w, at), np.cumsum(m) - m)
        q[t] = 0.0
        return cos

    @staticmethod
    def _best(some: np.ndarray, cos: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        if len(some) > 4 * k:  # ties at the k-th stay
            worst = np.partition(cos, len(cos) - k)[len(cos) - k]
            some, cos = some[cos >= worst - 1e-8], cos[cos >= worst - 1e-8]
        o = np.lexsort((some, -np.round(cos, 9)))[:k]
        return some[o], cos[o]

    def vote(self, at: np.ndarray, cos: np.ndarray) -> float:
        w = cos / (1.1 - np.minimum(cos, 1.0))
        return float((w @ self.labels[at] + self.base_rate) / (w.sum() + 1.0))

    def calibrated(self, raw: float) -> float:
        raw = min(max(raw, 1e-6), 1 - 1e-6)
        return 1.0 / (1.0 + math.exp(-(self.slope * math.log(raw / (1 - raw)) + self.intercept)))

    def score(self, text: str | None) -> tuple[float, list[tuple[int, float, int]]]:
        """Calibrated score, and the neighbours as (doc_id, cosine, label)."""
        at, cos = self.nearest(*self.vector(Counter(words(text))))
        if not len(at):
            return self.rate_without, []
        return self.calibrated(self.vote(at, cos)), [(int(self.ids[i]), float(c), int(self.labels[i])) for i, c in zip(at, cos, strict=True)]


def _logistic(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of y on logit(raw), by damped Newton steps with a weak prior at (1, 0)."""
    x = np.log(np.clip(raw, 1e-6, 1 - 1e-6) / (1 - np.clip(raw, 1e-6, 1 - 1e-6)))
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = np.array([((p - y) * x).sum() + (a - 1), (p - y).sum() + b * 0.1])
        v = p * (1 - p)
        h = np.array([[(v * x * x).sum() + 1, (v * x).sum()], [(v * x).sum(), v.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
    return max(a, 0.05), b


def labelled_sample(docs: DataFrame, labels: DataFrame, max_labelled: int, folds: int = FOLDS) -> DataFrame:
    """(doc_id, toxic, text) of at most about max_labelled labelled rows outside the held-out fold."""
    usable = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"), folds))
    usable = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = usable.count()
    if n > max_labelled:
        usable = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * max_labelled / n))
    # bounded by max_labelled rows of 12 bytes: fit to broadcast
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(usable), "doc_id")
    return found.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))


def relevance_of(n: np.ndarray, a: np.ndarray, n_pos: int, n_neg: int, half: float = RELEVANCE) -> np.ndarray:
    """0 to 1 from the labels of the documents that hold a term: n documents, a of them toxic."""
    share = n / float(n_pos + n_neg)
    spread = np.sqrt(np.maximum(share * (1.0 - share), 0.0) * (1.0 / n_pos + 1.0 / n_neg))
    z = np.divide(a / float(n_pos) - (n - a) / float(n_neg), spread, out=np.zeros(len(n)), where=spread > 0)
    return z * z / (z * z + half * half)


def _document_frequencies(docs: DataFrame, terms: dict[str, int]) -> tuple[int, np.ndarray]:
    """(number of documents, how many hold each term)."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = sent.value.get
        n, df = 0, np.zeros(len(sent.value), np.int64)
        for b in batches:
            n += b.num_rows
            found = [t for text in b.column("text").to_pylist() for w in set(words(text)) if (t := get(w)) is not None]
            df += np.bincount(np.array(found, dtype=np.int64), minlength=len(df))
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[-1, held].astype(np.int32)), pa.array(np.r_[n, df[held]].astype(np.int64))], ["term", "n"])

    got = docs.select("text").mapInArrow(rows, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row for each term
    term, n = got.column("term").to_numpy(), got.column("n").to_numpy()
    df = np.zeros(len(terms), np.int64)
    df[term[term >= 0]] = n[term >= 0]
    return int(n[term < 0].sum()), df


def _offsets(sizes: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(sizes)].astype(np.int64)


def build_index(terms: dict[str, int], weight: np.ndarray, ids: list[int], labels: list[int], counted: list[dict[str, int]]) -> Index:
    """The index of the given examples (counts of the words of each), with its calibration."""
    y = np.array(labels, dtype=float)
    x = Index(terms=terms, weight=weight)
    x.base_rate = float(y.mean()) if len(y) else 0.0
    vectors = [x.vector(c) for c in counted]
    full = [i for i, (t, _) in enumerate(vectors) if len(t)]
    without = np.ones(len(vectors), bool)
    without[full] = False
    x.rate_without = float((y[without].sum() + x.base_rate) / (without.sum() + 1.0)) if len(y) else 0.0
    # examples with the same strongest term stand together: tight block maxima
    full.sort(key=lambda i: (int(vectors[i][0][np.argmax(vectors[i][1])]), -float(vectors[i][1].max()), ids[i]))
    x.ids, x.labels = np.array([ids[i] for i in full], dtype=np.int64), y[full]
    size = np.array([len(vectors[i][0]) for i in full], dtype=np.int64)
    x.row_off = _offsets(size)
    x.row_term = np.concatenate([vectors[i][0] for i in full]) if full else np.zeros(0, np.int64)
    x.row_w = np.concatenate([vectors[i][1] for i in full]) if full else np.zeros(0)
    ex = np.repeat(np.arange(len(full)), size)
    o = np.argsort(x.row_term, kind="stable")  # examples stay ascending inside a term
    term, x.post_ex, x.post_w = x.row_term[o], ex[o], x.row_w[o]
    x.post_off = _offsets(np.bincount(term, minlength=len(terms)))
    block = x.post_ex // BLOCK
    first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])]) if len(term) else np.zeros(0, np.int64)
    x.block_id, x.block_max = block[first], np.maximum.reduceat(x.post_w, first) if len(first) else np.zeros(0)
    x.block_off = _offsets(np.bincount(term[first], minlength=len(terms)))
    x.term_max = np.zeros(len(terms))
    np.maximum.at(x.term_max, term[first], x.block_max)
    if len(full) >= 20 and 0 < x.labels.sum() < len(full):
        raw = []
        for pos, i in enumerate(full):
            raw.append(x.vote(*x.nearest(*vectors[i], without=pos)))
        x.slope, x.intercept = _logistic(np.array(raw), x.labels)
        x.__dict__.pop("_query", None)
    return x


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, relevance: float = RELEVANCE) -> Index:
    sample = stored(labelled_sample(docs, labels, max_labelled), "toxic-sample")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [Counter(words(x)) for x in b.column("text").to_pylist()]
            toxic = pa.array([int(v > 0) for v in b.column("toxic").to_pylist()], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), toxic, pa.array([list(c) for c in made], pa.list_(pa.string())), pa.array([list(c.values()) for c in made], pa.list_(pa.int32()))], ["doc_id", "y", "w", "tf"])

    # bounded by max_labelled rows
    got = sample.select("doc_id", "toxic", "text").mapInArrow(rows, "doc_id bigint, y int, w array<string>, tf array<int>").orderBy("doc_id").toArrow()
    ids, y = got.column("doc_id").to_pylist(), got.column("y").to_pylist()
    counted = [dict(zip(w, n, strict=True)) for w, n in zip(got.column("w").to_pylist(), got.column("tf").to_pylist(), strict=True)]
    n_pos, n_neg = sum(y), len(y) - sum(y)
    if not n_pos or not n_neg:
        return build_index({}, np.zeros(0), ids, y, counted)
    n, a = Counter(), Counter()
    for c, toxic in zip(counted, y, strict=True):
        n.update(c.keys())
        if toxic:
            a.update(c.keys())
    terms = {w: i for i, w in enumerate(sorted(n))}
    total, df = _document_frequencies(docs, terms)
    held = np.array([n[w] for w in terms]), np.array([a[w] for w in terms])
    return build_index(terms, np.log((1 + total) / (1 + df)) * relevance_of(*held, n_pos, n_neg, relevance), ids, y, counted)


def score(docs: DataFrame, index: Index, evidence: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted (and the nearest examples, if asked for) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(index)
    schema = "doc_id bigint, held_out boolean, score double, predicted int" + (", evidence array<struct<doc_id: bigint, cosine: double, toxic: int>>" if evidence else "")
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = sent.value
        for b in batches:
            made = [x.score(t) for t in b.column("text").to_pylist()]
            cols = [b.column("doc_id"), b.column("held_out"), pa.array([m[0] for m in made], pa.float64()), pa.array([int(m[0] >= 0.5) for m in made], pa.int32())]
            names = ["doc_id", "held_out", "score", "predicted"]
            if evidence:
                cols.append(pa.array([[dict(zip(("doc_id", "cosine", "toxic"), e, strict=True)) for e in m[1][:evidence]] for m in made], kind))
                names.append("evidence")
            yield pa.RecordBatch.from_arrays(cols, names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(rows, schema)


def reject_toxic(docs: DataFrame, index: Index, threshold: float = 0.5) -> DataFrame:
    """docs (all columns) without the rows whose score reaches the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(index)
    name = fresh(docs, "_toxicity")
    names, at_text, own = docs.columns, docs.columns.index("text"), numbered(docs)
    schema = StructType([*own.schema.fields, StructField("score", DoubleType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = sent.value
        for b in batches:
            s = pa.array([x.score(t)[0] for t in b.column(at_text).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([*b.columns, s], [f.name for f in schema])

    return own.mapInArrow(rows, schema).toDF(*names, name).where(F.col(name) < threshold).drop(name)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, fit(docs, table(spark, sf_dir, "labels")))
