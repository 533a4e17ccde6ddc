"""Joins to annotation: every one is an equi left lookup with a stated answer to duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_rows(df: DataFrame, keys: list[str], ordinal: str = "src_ordinal") -> DataFrame:
    """The first row of each key in source order."""
    w = W.partitionBy(*keys).orderBy(ordinal)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def lookup_first(left: DataFrame, right: DataFrame, keys: list[str], ordinal: str = "src_ordinal") -> DataFrame:
    """Left join to the first right row of each key."""
    return left.join(first_rows(right, keys, ordinal).drop(ordinal), keys, "left")


def lookup_unique(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join to a right side whose keys must be unique; a repeated key raises at run time."""
    n = F.count(F.lit(1)).over(W.partitionBy(*keys))
    checked = right.withColumn("_n", n).where(F.coalesce(F.assert_true(F.col("_n") == 1, F.lit(f"repeated key in lookup on {keys}")).cast("boolean"), F.lit(True))).drop("_n")
    return left.join(checked, keys, "left")


def coalesce_annotation(samples: DataFrame, annotation: DataFrame, key: str = "specimen_source_value", unique: bool = True) -> DataFrame:
    """Annotation joined by key; a column both sides have is the sample's own value, else the annotation's."""
    both = [c for c in annotation.columns if c in samples.columns and c != key]
    renamed = annotation.withColumnsRenamed({c: f"_{c}" for c in both})
    out = lookup_unique(samples, renamed, [key]) if unique else samples.join(renamed, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in both}).drop(*[f"_{c}" for c in both])


def propagate(samples: DataFrame, source: DataFrame, keys: list[str], value: str, evidence: str, direct: str = "source", passed: str = "propagated") -> DataFrame:
    """Fills value, only where null, with the first value another row of the same keys states."""
    stated = first_rows(source.where(F.col(value).isNotNull()), keys).select(*keys, F.col(value).alias("_v"))
    out = samples.join(stated, keys, "left")
    mark = F.when(F.col(value).isNotNull(), F.coalesce(F.col(evidence), F.lit(direct)) if evidence in samples.columns else F.lit(direct)).when(F.col("_v").isNotNull(), F.lit(passed))
    return out.withColumn(evidence, mark).withColumn(value, F.coalesce(F.col(value), F.col("_v"))).drop("_v")


def sole(df: DataFrame, key: str, value: str) -> DataFrame:
    """key, value: the value where a key has exactly one row, else null."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.first(value).alias("_v")).select(key, "n_rows", F.when(F.col("n_rows") == 1, F.col("_v")).alias(value))


def bounded(df: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """The frame with a broadcast hint if it has at most limit rows, else as it is."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def is_member(df: DataFrame, of: DataFrame, key: str, name: str) -> DataFrame:
    """df with a boolean: whether the key is in the other frame."""
    return df.join(of.select(key).distinct().withColumn(name, F.lit(True)), key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def any_of(*flags: Column) -> Column:
    out = F.lit(False)
    for f in flags:
        out = out | F.coalesce(f, F.lit(False))
    return out
