"""Document fingerprints by spot signatures, with DataFrame functions only.

Tokens are lower-cased runs of letters and digits. Each common word (``ANCHORS``) is an anchor; its
signature is the anchor with the chain of the next two content words (tokens that are no common
words). Only texts in which no common word stands before a content word have other anchors: the content
words whose hash is 0 modulo ``CONTENT_ANCHOR``, and if there is none of these either, every token. A
text without tokens has one signature of the whole text, the empty text none. The fingerprint is the
sorted set of 32-bit signature hashes.

Likeness is the Jaccard index of two sets. Sets whose lengths differ so much that the index cannot
reach a threshold are told apart by length alone: ``similar_pairs`` partitions documents by set
length, joins only neighbouring partitions on the few rarest signatures of which a pair of that
likeness must share one (prefix filter), and compares the survivors.

Scale: fingerprints are computed in the scan. The query needs each text's successor by doc_id: rows
are dealt into range blocks of doc_id, each block gets a copy of the first row of the next block, and
a window runs inside blocks; every text is shuffled once. Block bounds follow from a histogram of at
most ``CELLS`` cells, each cut evenly into as many blocks as its rows ask for, so that neither clustered
ids nor outliers make a block large. A block holds about max(``BLOCK_ROWS``, sqrt(rows)) rows, so that rows of
a block and number of blocks (one row each is broadcast) both grow with the root of the table only. Null
doc_ids are dealt into blocks by text hash.

Defined results: null texts count as empty. Rows that repeat a doc_id are documents of their own,
ordered by text hash. A null doc_id sorts after all others. With one row, the next document is the row
itself. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataloom.llm.common import cut, table

#: Common words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be been but by can do for from had has have he her his i if in into is it its not of on or our "
    "she so than that the their them there they this to up was we were what when which who will with would you your "
    "au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur mais ne nous ou par pas plus pour que qui sa se ses son sont sur un une vous "
    "als am auch auf aus bei das dass dem den der die durch ein eine einem einen einer er es hat ich im ist mit nach nicht noch nur oder sich sie sind um und von vor war wie wir zu zum zur "
    "al como con cuando del el ella entre era esta este está fue ha hay las lo los más me muy no nos para pero por porque sin sobre su sus también todo una uno y ya"
).split()
CONTENT_ANCHOR = 8
CELLS = 4096
BLOCK_ROWS = 500
#: Groups of signatures whose corpus-wide counts order them by rarity.
RARITY_CELLS = 65536
#: Keeps rounding from pruning a pair that reaches the threshold exactly.
_SLACK = 1e-9
_LOW_32 = 0xFFFFFFFF


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")


def _hash(*parts: Column) -> Column:
    return F.xxhash64(*parts).bitwiseAND(F.lit(_LOW_32))


def _at(a: Column, i: Column) -> Column:
    return F.get(a, i)


def signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with column out: the sorted set of 32-bit signature hashes of a (non-null) text column."""
    t, ch, cw, sg = (f"_{x}_{out}" for x in ("tok", "chunk", "content", "sig"))
    df = df.withColumn(t, tokens(F.col(text)))
    # a chunk is a content word with the common words just before it; chunks end in a line feed
    marked = F.array_join(F.transform(F.col(t), lambda x: F.when(x.isin(ANCHORS), x).otherwise(F.concat(x, F.lit("\n")))), " ")
    df = df.withColumn(ch, F.split(marked, "\n ?"))
    # what follows the last content word (common words only, or nothing) is no chunk
    df = df.withColumn(ch, F.slice(F.col(ch), 1, F.greatest(F.size(ch) - 1, F.lit(0))))
    df = df.withColumn(cw, F.transform(F.col(ch), lambda c: F.substring_index(c, " ", -1)))

    def of_chunk(c: Column, k: Column) -> Column:
        first, second = _at(F.col(cw), k), _at(F.col(cw), k + 1)
        parts = F.split(c, " ")
        own = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda a: _hash(a, first, second))
        return F.when(c.contains(" "), own).otherwise(F.array().cast("array<bigint>"))

    def of_content(w: Column, k: Column) -> Column:
        own = F.array(_hash(w, _at(F.col(cw), k + 1), _at(F.col(cw), k + 2)))
        return F.when((k < F.size(cw) - 1) & (F.pmod(F.hash(w), F.lit(CONTENT_ANCHOR)) == 0), own).otherwise(F.array().cast("array<bigint>"))

    df = df.withColumn(sg, F.flatten(F.transform(F.col(ch), of_chunk)))
    df = df.withColumn(sg, F.when(F.size(sg) > 0, F.col(sg)).otherwise(F.flatten(F.transform(F.col(cw), of_content))))
    every = F.transform(F.col(t), lambda x, k: _hash(x, _at(F.col(t), k + 1), _at(F.col(t), k + 2)))
    whole = F.when(F.col(text) == "", F.array().cast("array<bigint>")).otherwise(F.array(_hash(F.col(text))))
    best = F.when(F.size(sg) > 0, F.col(sg)).when(F.size(t) > 0, every).otherwise(whole)
    return df.withColumn(out, F.array_sort(F.array_distinct(best))).drop(t, ch, cw, sg)


def fingerprint(sigs: Column) -> Column:
    """The set as a string: its hashes in order, hexadecimal, joined by commas."""
    return F.array_join(F.transform(sigs, lambda x: F.lower(F.hex(x))), ",")


def likeness(a: Column, b: Column, at_least: float = 0.0) -> Column:
    """Jaccard index of two sets; 0 without comparing them if lengths rule out at_least."""
    na, nb = F.size(a), F.size(b)
    common = F.size(F.array_intersect(a, b))
    j = F.when((na == 0) & (nb == 0), F.lit(1.0)).otherwise(common.cast("double") / (na + nb - common))
    return F.when(F.least(na, nb) < F.lit(at_least) * F.greatest(na, nb) - F.lit(_SLACK), F.lit(0.0)).otherwise(j)


def similar_pairs(docs: DataFrame, at_least: float = 0.8) -> DataFrame:
    """Classes of equal fingerprints and the similar pairs between them.

    Returns class_a, class_b (smallest doc_id of each class), jaccard, with class_a <= class_b; the
    members of a class are those documents whose fingerprint is equal (``classes``). Texts that share
    a doc_id are classes of their own with one name; a class of null doc_ids only is named null.
    """
    keyed = _keyed(docs).withColumn("n", F.size("sigs")).where("n > 0")
    reps = keyed.groupBy("key").agg(F.min("doc_id").alias("class_id"), F.any_value("sigs").alias("sigs"), F.any_value("n").alias("n"))
    # the bands are a little wider than the ratio, so that rounding cannot put a pair two bands apart
    reps = reps.withColumn("partition", F.floor(F.log(F.col("n").cast("double")) / (math.log(1.0 / at_least) * (1 + _SLACK))).cast("int"))
    # the rarest signatures come first: frequent ones stand in the prefix of few sets
    each = reps.select("key", "n", "partition", F.explode("sigs").alias("sig")).withColumn("cell", F.pmod(F.col("sig"), F.lit(RARITY_CELLS)))
    often = each.groupBy("cell").agg(F.count(F.lit(1)).alias("often"))  # at most RARITY_CELLS rows
    ranked = each.join(F.broadcast(often), "cell").groupBy("key", "n", "partition").agg(F.array_sort(F.collect_list(F.struct("often", "sig"))).alias("ranked"))
    prefix = F.slice("ranked", F.lit(1), F.col("n") - F.ceil(F.col("n") * F.lit(at_least) - F.lit(_SLACK)).cast("int") + 1)
    left = ranked.select(F.col("key").alias("key_a"), "n", "partition", F.explode(prefix).alias("s")).withColumn("sig", F.col("s.sig")).drop("s")
    right = left.select(F.col("key_a").alias("key_b"), F.col("n").alias("n_b"), "sig", F.explode(F.array(F.col("partition"), F.col("partition") - 1)).alias("partition"))
    pairs = left.join(right, ["sig", "partition"]).where("n < n_b or (n = n_b and key_a < key_b)")
    pairs = pairs.where(F.col("n") >= F.col("n_b") * F.lit(at_least) - F.lit(_SLACK)).select("key_a", "key_b").distinct()
    a, b = (reps.select(F.col("key").alias(f"key_{x}"), F.col("class_id").alias(f"id_{x}"), F.col("sigs").alias(f"s{x}")) for x in "ab")
    out = pairs.join(a, "key_a").join(b, "key_b").withColumn("jaccard", likeness(F.col("sa"), F.col("sb"), at_least)).where(F.col("jaccard") >= at_least)
    swap = F.col("id_b") < F.col("id_a")
    return out.select(F.when(swap, F.col("id_b")).otherwise(F.col("id_a")).alias("class_a"), F.when(swap, F.col("id_a")).otherwise(F.col("id_b")).alias("class_b"), "jaccard")


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, sigs, key: a digest of the fingerprint."""
    f = signatures(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text", "sigs")
    return f.select("doc_id", "sigs", F.sha2(fingerprint(F.col("sigs")).cast("binary"), 256).alias("key"))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, sigs, class_id: the smallest doc_id with an equal fingerprint."""
    f = _keyed(docs)
    least = f.groupBy("key").agg(F.min("doc_id").alias("class_id"))
    return f.join(least, "key").drop("key")


def _block_of(docs: DataFrame) -> Column:
    """Block number of a row (doc_id, tie), ascending in doc_id; those of null doc_ids are 0 and below,
    descending in tie.

    Two levels: equal-width cells between the least and the largest doc_id, and inside each cell
    equal-width blocks between its own least and largest doc_id, as many as its rows ask for.
    """
    whole = docs.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("doc_id").alias("n"), F.count(F.lit(1)).alias("all")).first()
    lo, hi, n = whole["lo"] or 0, whole["hi"] or 0, whole["n"]
    rows = max(BLOCK_ROWS, math.isqrt(whole["all"]))
    cells = max(1, min(CELLS, n // rows))
    width = max(1, -(-(hi - lo + 1) // cells))
    # differences of ids that span more than a bigint are taken as doubles: blocks stay in order
    wide = hi - lo >= (1 << 63) - 1
    number, doc_id = (float, F.col("doc_id").cast("double")) if wide else (int, F.col("doc_id"))
    cell = F.floor((doc_id - F.lit(number(lo))) / F.lit(number(width))).cast("int")
    found = {r["cell"]: r for r in docs.where("doc_id is not null").groupBy(cell.alias("cell")).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("doc_id").alias("n")).collect()}  # at most CELLS rows
    base, first, step, at = [], [], [], 1
    for c in range(cells + 1):
        r = found.get(c)
        parts = max(1, r["n"] // rows) if r else 1
        base.append(at)
        first.append(number(r["lo"] if r else 0))
        step.append(number(max(1, -(-(r["hi"] - r["lo"] + 1) // parts)) if r else 1))
        at += parts
    arrays = [F.lit(a) for a in (base, first, step)]
    i = cell + 1
    known = F.element_at(arrays[0], i) + F.floor((doc_id - F.element_at(arrays[1], i)) / F.element_at(arrays[2], i))
    unknown = F.floor((F.col("tie").cast("double") / float(1 << 64) + F.lit(0.5)) * F.lit(float(max(1, (whole["all"] - n) // rows))))
    return F.coalesce(known, -unknown).cast("bigint")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, sigs, next_text, next_sigs: each row with its successor by descending doc_id."""
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    block = _block_of(d)
    d = d.withColumn("tie", F.xxhash64("text")).withColumn("block", block)
    # the first row of each block in descending order: the largest (doc_id, then least text hash)
    order = [F.desc_nulls_last("doc_id"), F.asc("tie"), F.asc("text")]
    heads = cut(d.select("block", "doc_id", "tie").groupBy("block").agg(F.max_by(F.struct("doc_id", "tie"), F.struct(F.col("doc_id"), -(F.col("tie").cast("decimal(20,0)")))).alias("h")))
    across = W.orderBy(F.asc("block"))
    last = heads.agg(F.max("block")).first()[0]
    heads = heads.select(F.col("h.doc_id").alias("_id"), F.col("h.tie").alias("_tie"), F.coalesce(F.lead("block").over(across), F.lit(None)).alias("_above"), F.col("block").alias("_own"))
    # the head of a block follows the last row of the block above it; the head of the top follows the lowest
    lowest = heads.agg(F.min("_own")).first()[0] if last is not None else None
    heads = heads.withColumn("_above", F.coalesce("_above", F.lit(lowest)))
    ghosts = d.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie")) & (F.col("block") == F.col("_own")))
    ghosts = ghosts.dropDuplicates(["_own"]).select("doc_id", "text", "tie", F.col("_above").alias("block"))
    rows = d.select("doc_id", "text", "tie", "block").withColumn("ghost", F.lit(0)).unionByName(ghosts.withColumn("ghost", F.lit(1)))
    rows = signatures(rows.repartition("block"), "text", "sigs")
    inside = W.partitionBy("block").orderBy(F.asc("ghost"), *order)
    rows = rows.withColumn("next", F.lead(F.struct("text", "sigs")).over(inside)).where("ghost = 0")
    return rows.select("doc_id", "text", "sigs", F.col("next.text").alias("next_text"), F.col("next.sigs").alias("next_sigs"))


def op2_spot_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = with_next(table(spark, sf_dir, "documents")).withColumn("n_chars", F.length("text").cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    d = d.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half)))
    d = signatures(d, "edited", "edited_sigs")
    return d.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"), fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


# The fingerprints' hash function is not in SQL; the edited texts are.
OP2_TEXT_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC), first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS next_text
  FROM documents
)
SELECT doc_id, length(text) AS n_chars,
       sha256(substr(text, 1, length(text) - length(text) // 2) || substr(next_text, 1, length(text) // 2)) AS edited_sha256
FROM d
"""
