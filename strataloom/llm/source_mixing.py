"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the exponential key ``-ln(u) / quality`` (u from a hash of its doc_id and the
seed, quality a positive weight); the documents of a source are taken in the order of these keys
until the source's word budget is met. A budget above the source's size is served by complete
epochs first; the rest is the fractional selection by key, whose last document is taken in part
(its leading words), so that a source's taken words equal its budget rounded down.

Targets: sources in code point order (null last) weigh by a repeating pattern and share the words
of the whole corpus. A target stops at ``max_epochs`` times its source's size; the excess goes to
the others by weight until none is above. This is water filling, target = min(cap, level * weight),
and the level follows from one running sum over the sources in the order of cap / weight.

Scale: only (doc_id, source, size, key) leave the scan. The running sum of a source is split into
buckets that are monotone in the key: bucket totals are summed first, then each bucket runs its own
window from its offset, so that a source with a third of all documents is spread over many tasks.
Whatever the qualities of a source, a bucket is expected to hold no more than ``bucket_rows`` rows: 1 - exp(-LEAST_QUALITY * key) is 1 - u^a with a from LEAST_QUALITY to 1, whose density
nowhere exceeds 1 / LEAST_QUALITY.
Windows without partitions are over one row per source only.

Defined results: a null text has size 0 and takes 0. A null doc_id is a document like any other.
Rows that repeat a doc_id are separate documents with equal keys, ordered by size. Sources whose
size is 0 have target 0. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataloom.llm.common import cut, table

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20240601
BUCKET_ROWS = 4096
LEAST_QUALITY = 0.25


def word_count(text: Column) -> Column:
    """Number of runs of characters other than space and \\x09-\\x0D; 0 for null."""
    folded = F.btrim(F.translate(text, "\t\n\x0b\x0c\r", "     "), F.lit(" "))
    # one space less than words between two words, whatever the run of spaces: strip repeated spaces natively
    single = F.regexp_replace(folded, "  +", " ")
    n = F.length(single) - F.length(F.replace(single, F.lit(" "), F.lit(""))) + 1
    return F.when(text.isNull() | (F.length(folded) == 0), F.lit(0)).otherwise(n).cast("bigint")


def quality_weight(text: Column) -> Column:
    """1 for a text of letters and white space only, falling to 0.25 with their share; 0.25 for none."""
    n = F.length(text)
    others = F.length(F.regexp_replace(text, r"[\p{L}\x09-\x0D\x20]+", ""))
    return F.when(n > 0, F.lit(LEAST_QUALITY) + F.lit(1.0 - LEAST_QUALITY) * (F.lit(1.0) - others.cast("double") / n)).otherwise(F.lit(LEAST_QUALITY))


def uniform(doc_id: Column, seed: int = SEED) -> Column:
    """(0, 1) from the first 52 bits of md5(seed:doc_id)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    bits = F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """From one row per source (source, source_size, n_docs): adds target. Null source sorts last."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    pattern = F.array(*[F.lit(float(w)) for w in weights])
    s = sizes.withColumn("weight", F.element_at(pattern, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    s = s.withColumn("cap", F.lit(float(max_epochs)) * F.col("source_size"))
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    s = (
        s.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("capped_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("capped_before")) / F.col("weight_left"))
        .withColumn("is_capped", F.col("cap") < F.col("level") * F.col("weight"))
    )
    level = F.min(F.when(~F.col("is_capped"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(everything)
    s = s.withColumn("fill", level["level"])
    target = F.when(F.col("is_capped") | F.col("fill").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("fill") * F.col("weight")))
    return s.withColumn("target", target).select("source", "source_size", "n_docs", "target")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of docs (doc_id, source, text)."""
    keyed = cut(
        docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), (-F.log(uniform(F.col("doc_id"), seed)) / quality_weight(F.col("text"))).alias("sample_key"))
    )
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    targets = cut(source_targets(sizes, weights, max_epochs))
    t = targets.withColumnRenamed("source", "_s")
    rows = keyed.join(t, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    n_buckets = F.ceil(F.col("n_docs") / F.lit(bucket_rows * LEAST_QUALITY))
    rows = rows.withColumn("bucket", F.floor((F.lit(1.0) - F.exp(F.col("sample_key") * F.lit(-LEAST_QUALITY))) * n_buckets).cast("bigint"))
    totals = rows.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    offsets = totals.select(
        F.col("source").alias("_s"), F.col("bucket").alias("_b"),
        F.coalesce(F.sum("bucket_size").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
    )
    inside = W.partitionBy("source", "bucket").orderBy("sample_key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    rest = F.floor(F.col("target") - epochs * F.col("source_size"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("offset") - F.col("before")))
    return rows.select("doc_id", "size", "source_size", "target", (epochs * F.col("size") + part).cast("bigint").alias("taken"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH k AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         -ln((('0x' || substr(md5('20240601:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
         / CASE WHEN length(text) > 0
                THEN 0.25 + 0.75 * (1.0 - length(regexp_replace(text, '[\p{L}\x09-\x0D\x20]+', '', 'g'))::DOUBLE / length(text))
                ELSE 0.25 END AS sample_key
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM k GROUP BY source
), w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         3.0::DOUBLE * source_size AS cap FROM s
), r AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE AS total,
         coalesce(sum(cap) OVER o, 0) AS capped_before,
         (sum(weight) OVER ()) - coalesce(sum(weight) OVER o, 0) AS weight_left
  FROM w WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT *, (total - capped_before) / weight_left AS level, cap < (total - capped_before) / weight_left * weight AS is_capped FROM r
), f AS (
  SELECT *, arg_min(level, cap / weight) FILTER (NOT is_capped) OVER () AS fill FROM l
), t AS (
  SELECT source, source_size, CASE WHEN is_capped OR fill IS NULL THEN cap ELSE least(cap, fill * weight) END AS target FROM f
), d AS (
  SELECT k.*, t.source_size, t.target,
         coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY sample_key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS epochs
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, floor(target - epochs * source_size) - before)))::BIGINT AS taken
FROM d
"""
