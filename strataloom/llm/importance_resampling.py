"""Quality classifier by importance resampling: hashed n-gram models, Gumbel top-k.

Two generative bag-of-n-grams models over ``BUCKETS`` hashed word unigrams and bigrams are counted:
the raw model over all documents, the target model over labelled good documents (at most about
``max_target`` of them by a hash of doc_id, outside the held-out fold: the documented bound). The
importance weight of a document is the ratio of its probabilities under the two models: its log is
the sum of the log ratios of the buckets of its n-grams.

Sampling k documents without replacement in proportion to the weights: each gets the key log weight
+ Gumbel noise (from a hash of doc_id and seed) and the k largest keys are kept. k is the share of
good rows among labelled rows times the number of documents, unless given.

The k-th largest key is found exactly without sorting or collecting keys: the range of keys is cut
into cells, counted, and the cell that holds the k-th key is cut again until few keys are in it.

Scale: two narrow scans; the shuffled counts are at most BUCKETS rows a task; models are arrays of
BUCKETS numbers. Scores (32 bytes a document) are checkpointed and counted a few times.

Defined results: null and empty texts have no n-gram, hence log weight 0. A null doc_id is scored
and sampled like any other. Rows that repeat a doc_id with one text have one key: at the threshold
all or none of them are kept. Without labels the target model is the raw model, all log weights are
0 and all documents are kept. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm.common import cut, table, words_of

BUCKETS = 10_000
SEED = 17
MAX_TARGET = 20_000
FOLDS = 5
CELLS = 4096
FEW = 5_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def ngram_buckets(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of every unigram and bigram of the text."""
    w = words_of(text)
    if not w:
        return np.zeros(0, np.int64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), dtype=np.uint64, count=len(w))
    two = (h[:-1] * _A) ^ (h[1:] * _B + _A)
    two ^= two >> np.uint64(31)
    return (np.concatenate([h, two]) % np.uint64(buckets)).astype(np.int64)


def held_out(doc_id, folds: int = FOLDS):
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def target_ids(labels: DataFrame, max_target: int) -> tuple[DataFrame, float]:
    """(doc_id of good labelled rows outside the held-out fold, share of good rows among labelled)."""
    use = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    use = use.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    r = use.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("quality") > 0).cast("int")).alias("good")).first()
    good = use.where("quality > 0").select("doc_id")
    if (r["good"] or 0) > max_target:
        good = good.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int((1 << 20) * max_target / r["good"]))
    return good, (r["good"] or 0) / r["n"] if r["n"] else 1.0


def fit(docs: DataFrame, good: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """log target probability - log raw probability of each bucket (add-one smoothing)."""
    # bounded by max_target rows of 8 bytes: fit to broadcast
    marked = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(good.withColumn("is_target", F.lit(True))), "doc_id", "left").select("text", F.col("is_target").isNotNull().alias("is_target"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in batches:
            for text, mine in zip(b.column("text").to_pylist(), b.column("is_target").to_pylist(), strict=True):
                c = np.bincount(ngram_buckets(text, buckets), minlength=buckets)
                raw += c
                if mine:
                    target += c
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(raw[at]), pa.array(target[at])], ["bucket", "raw", "target"])

    got = marked.mapInArrow(rows, "bucket int, raw bigint, target bigint").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()  # at most BUCKETS rows
    raw, target = np.zeros(buckets), np.zeros(buckets)
    for r in got:
        raw[r["bucket"]], target[r["bucket"]] = r["raw"], r["target"]
    if not target.any():
        return np.zeros(buckets)
    return np.log((target + 1) / (target.sum() + buckets)) - np.log((raw + 1) / (raw.sum() + buckets))


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, log_weight, sample_key, tie of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = sent.value
        for b in batches:
            out = [float(r[ngram_buckets(text, len(r))].sum()) for text in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.float64()), b.column("noise")], ["doc_id", "log_weight", "noise"])

    noise = F.xxhash64(F.lit(seed), F.col("doc_id"))
    scored = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").withColumn("noise", noise).mapInArrow(rows, "doc_id bigint, log_weight double, noise bigint")
    u = (F.shiftrightunsigned("noise", 12).cast("double") + 0.5) / float(1 << 52)
    return scored.select("doc_id", "log_weight", (F.col("log_weight") - F.log(-F.log(u))).alias("sample_key"), F.col("noise").alias("tie"))


def kth_largest(scores: DataFrame, k: int) -> tuple[float, int] | None:
    """(key, tie) of the k-th row by descending sample_key, then ascending tie; None for k < 1."""
    if k < 1:
        return None
    r = scores.agg(F.min("sample_key").alias("lo"), F.max("sample_key").alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, hi, n = r["lo"], r["hi"], r["n"]
    k = min(k, n)
    inside = scores
    while n > FEW and hi > lo:
        width = (hi - lo) / CELLS
        cell = F.least(F.lit(CELLS - 1), F.floor((F.col("sample_key") - F.lit(lo)) / F.lit(width))).cast("int")
        cells = sorted(inside.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.min("sample_key").alias("lo"), F.max("sample_key").alias("hi")).collect(), key=lambda x: -x["cell"])  # at most CELLS rows
        for c in cells:
            if k <= c["n"]:
                break
            k -= c["n"]
        lo, hi, n = c["lo"], c["hi"], c["n"]
        inside = scores.where((F.col("sample_key") >= F.lit(lo)) & (F.col("sample_key") <= F.lit(hi)))
    if hi == lo:  # one key for all that is left: ties decide among equal keys, all of them at once
        return lo, (1 << 63) - 1
    few = sorted(((-x["sample_key"], x["tie"]) for x in inside.select("sample_key", "tie").collect()))
    return -few[k - 1][0], few[k - 1][1]


def resample(docs: DataFrame, labels: DataFrame, k: int | None = None, max_target: int = MAX_TARGET, seed: int = SEED) -> DataFrame:
    """doc_id, log_weight, sample_key, kept of every row of docs; kept marks the sample of k."""
    good, share = target_ids(labels, max_target)
    scores = cut(weigh(docs, fit(docs, good), seed))
    n = scores.count()
    at = kth_largest(scores, round(share * n) if k is None else k)
    if at is None:
        return scores.select("doc_id", "log_weight", "sample_key", F.lit(False).alias("kept"))
    kept = (F.col("sample_key") > F.lit(at[0])) | ((F.col("sample_key") == F.lit(at[0])) & (F.col("tie") <= F.lit(at[1])))
    return scores.select("doc_id", "log_weight", "sample_key", kept.alias("kept"))


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
