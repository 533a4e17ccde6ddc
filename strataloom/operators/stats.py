"""Grouped statistics of cells: per feature, per stratum, per layer.

Cells are long: (stratum_key, feature_key, specimen_id, value). Every statistic is an aggregate on
(stratum_key, feature_key) - even, high-cardinality keys - with partial aggregation where the
function allows it; stratum level figures aggregate the feature rows, never the cells again.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.functions import expr as E
from strataloom.model import MAX_LOCATION_RANGE, MAX_SPREAD_RATIO, MIN_PRESENT, MIN_SKEW_VALUES, SKEW_TOLERANCE
from strataloom.operators import ranking
from strataloom.operators.lineage import cut, staged
from strataloom.operators.lookups import bounded

KEYS = ("stratum_key", "feature_key")


def pivot_mean(rows: DataFrame, *keys: str, value: str = "value") -> DataFrame:
    """Mean of the non-null values by keys; groups without any value vanish."""
    return rows.where(F.col(value).isNotNull()).groupBy(*keys).agg(F.avg(value).alias(value))


def sample_counts(samples: DataFrame) -> DataFrame:
    """stratum_key, n_samples from the samples dimension (pools and controls count)."""
    return samples.groupBy("stratum_key").agg(F.count(F.lit(1)).alias("n_samples"))


def values_of(cells: DataFrame, *keys: str) -> DataFrame:
    """Keys and values of cells, computed once for the passes over them."""
    return staged(cells.select(*keys, F.col("value").cast("double").alias("value")).where(F.col("value").isNotNull()))


def feature_stats(cells: DataFrame, stored: bool = False) -> DataFrame:
    """n, mean, sd (n-1), median and skew of each feature in its stratum.

    Large features take several passes: cells that are not stored already are computed once, before the first.
    """
    found = ranking.medians(cells if stored else values_of(cells, *KEYS), list(KEYS), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"), E.sample_skew("value").alias("skew"))
    return found.select(*KEYS, "n", "mean", "sd", "median", "skew")


def presence(cells: DataFrame, samples: DataFrame, min_present: float = MIN_PRESENT) -> DataFrame:
    """n_present, n_samples, present fraction and whether the feature is kept (inclusive)."""
    n = cells.groupBy(*KEYS).agg(F.count("value").alias("n_present"))
    out = n.join(F.broadcast(sample_counts(samples)), "stratum_key")  # one row per stratum
    return out.withColumn("present", F.col("n_present") / F.col("n_samples")).withColumn("kept", F.col("present") >= min_present)


def complete_samples(cells: DataFrame, min_complete: float) -> DataFrame:
    """stratum_key, specimen_id, n_detected, detection_rate, kept: share of the stratum's features."""
    features = cells.groupBy("stratum_key").agg(F.count_distinct("feature_key").alias("n_features"))
    out = cells.groupBy("stratum_key", "specimen_id").agg(F.count("value").alias("n_detected")).join(F.broadcast(features), "stratum_key")
    out = out.withColumn("detection_rate", F.col("n_detected") / F.col("n_features"))
    return out.withColumn("kept", F.col("detection_rate") >= min_complete)


def stratum_space(stats: DataFrame) -> DataFrame:
    """location (median of feature medians) and spread (median of feature SDs) of each stratum."""
    return stats.groupBy("stratum_key").agg(F.median("median").alias("location"), F.median(F.when(F.col("sd") > 0, F.col("sd"))).alias("spread"))


def similarity(space: DataFrame) -> DataFrame:
    """One row: range of locations in pooled SDs, ratio of spreads, whether strata are similar."""
    n = F.count(F.lit(1))
    one = space.agg(
        n.alias("n_strata"), (F.max("location") - F.min("location")).alias("range"), F.median("spread").alias("pooled_sd"), F.try_divide(F.max("spread"), F.min("spread")).alias("spread_ratio")
    )
    one = one.withColumn("location_range", F.try_divide(F.col("range"), F.col("pooled_sd"))).drop("range")
    ok = (F.col("location_range") <= MAX_LOCATION_RANGE) & (F.col("spread_ratio") <= MAX_SPREAD_RATIO)
    return one.withColumn("similar", F.when(F.col("n_strata") <= 1, F.lit(True)).otherwise(F.coalesce(ok, F.lit(False))))


def scale_diagnostics(cells: DataFrame, stored: bool = False) -> DataFrame:
    """Median absolute skew, share of skewed features and the verdict, per stratum."""
    return diagnostics_of(feature_stats(cells, stored))


def diagnostics_of(feature_rows: DataFrame) -> DataFrame:
    """The same from rows of feature_stats."""
    s = feature_rows.where(F.col("n") >= MIN_SKEW_VALUES).where(F.col("sd") > 0)
    a = F.abs(F.col("skew"))
    out = s.groupBy("stratum_key").agg(F.count("skew").alias("n_features"), F.median(a).alias("median_abs_skew"), (F.avg((a > SKEW_TOLERANCE).cast("double")) * 100).alias("pct_skewed"))
    return out.withColumn("normality_ok", F.col("median_abs_skew") <= SKEW_TOLERANCE)


PROBABILITIES = (0.01, 0.5, 0.99)


def percentiles(cells: DataFrame, stored: bool = False) -> DataFrame:
    """Exact 1st and 99th percentile and median of a stratum's values, interpolated between ranks.

    Two passes: a mergeable sketch brackets each percentile to a few values in ten thousand (wide open
    where a stratum has less than twice that many); then the rows below each bracket are counted, and only
    values inside it are ranked. No task holds a stratum's values. Cells that are not stored already are computed once.
    """
    v = cells.where(F.col("value").isNotNull()).select("stratum_key", F.col("value").cast("double").alias("value")) if stored else values_of(cells, "stratum_key")
    reach, k = 2.0 / ranking.ACCURACY, len(PROBABILITIES)
    ends = [max(0.0, q - reach) for q in PROBABILITIES] + [min(1.0, q + reach) for q in PROBABILITIES]
    found = cut(v.groupBy("stratum_key").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx("value", ends, ranking.ACCURACY).alias("e")))
    few = F.col("n") <= 2 * ranking.ACCURACY
    each = [F.struct(F.lit(i).alias("i"), ((F.col("n") - 1) * q).alias("at"), F.when(few, F.lit(-math.inf)).otherwise(F.get("e", F.lit(i))).alias("lo"), F.when(few, F.lit(math.inf)).otherwise(F.get("e", F.lit(k + i))).alias("hi")) for i, q in enumerate(PROBABILITIES)]
    brackets = found.select("stratum_key", F.inline(F.array(*each)))
    places = ranking.selected(v, brackets, ["stratum_key"])
    return places.groupBy("stratum_key").agg(*[F.max(F.when(F.col("i") == i, F.col("x"))).alias(f"p{round(q * 100)}") for i, q in enumerate(PROBABILITIES)])


def sparsity(cells: DataFrame, samples: DataFrame) -> DataFrame:
    """Missingness of a stratum after its filter, over features x samples."""
    p = presence(cells, samples)
    pct = F.col("present") * 100
    out = p.groupBy("stratum_key").agg(
        F.count(F.lit(1)).alias("n_features"), F.max("n_samples").alias("n_samples"), F.sum("n_present").alias("n_values"), F.median(pct).alias("median_presence_pct"), F.min(pct).alias("min_presence_pct")
    )
    return out.withColumn("pct_missing", (1 - F.col("n_values") / (F.col("n_features") * F.col("n_samples"))) * 100)


def plex_centres(ratios: DataFrame) -> DataFrame:
    """Centre of each feature: the median of its per-plex medians."""
    per_plex = ranking.medians(ratios, [*KEYS, "plex"], name="m")
    return per_plex.groupBy(*KEYS).agg(F.median("m").alias("centre"), F.count(F.lit(1)).alias("n_plexes"))


def centre_on_plexes(ratios: DataFrame) -> DataFrame:
    """Ratios minus the centre of their feature. The ratios are computed once; the centres, a row for each feature, are
    counted and go to them."""
    ratios = staged(ratios)
    return ratios.join(bounded(cut(plex_centres(ratios))), list(KEYS), "left").withColumn("value", F.col("value") - F.col("centre")).drop("centre", "n_plexes")


def plex_structure(ratios: DataFrame, samples_per_plex: DataFrame) -> DataFrame:
    """How features are missing: plexes empty, partial and full for each stratum."""
    n = ratios.groupBy(*KEYS, "plex").agg(F.count("value").alias("n"))
    full = n.join(F.broadcast(samples_per_plex), ["stratum_key", "plex"])
    per = full.groupBy(*KEYS).agg(F.count_if(F.col("n") > 0).alias("plexes"), F.count_if((F.col("n") > 0) & (F.col("n") < F.col("plex_samples"))).alias("partial"))
    return per.groupBy("stratum_key").agg(
        F.count_if(F.col("partial") > 0).alias("features_partial"), F.count_if(F.col("plexes") == 0).alias("features_empty"), F.avg(F.col("plexes").cast("double")).alias("mean_plexes")
    )


def missingness_agreement(features: DataFrame) -> DataFrame:
    """Correlation and median absolute difference of two missingness measures of features."""
    both = features.where(F.col("missing_freq").isNotNull() & F.col("frac_below_lod").isNotNull())
    d = F.abs(F.col("missing_freq") - F.col("frac_below_lod"))
    n = F.count(F.lit(1))
    return both.agg(n.alias("n"), F.median(d).alias("median_difference"), F.max(d).alias("max_difference"), F.when(n > 2, E.correlation("missing_freq", "frac_below_lod")).alias("correlation"))
