"""Layer policy: decide from measured distributions, then transform and scale."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataloom.functions import expr as E
from strataloom.operators import ranking, stats
from strataloom.operators.lineage import cut, staged
from strataloom.operators.lookups import bounded

KEYS = list(stats.KEYS)


@dataclass(frozen=True)
class Policy:
    """What is done to a layer, and why."""

    layer: str
    z_applied: bool
    location_range: float | None
    spread_ratio: float | None
    n_strata: int
    transforms: dict  # stratum -> 'rank_int' or 'none'
    rationale: str
    label_vs_data: str | None = None

    def as_dict(self) -> dict:
        return asdict(self)


def zscore(cells: DataFrame) -> DataFrame:
    """value_z, centre and scale per feature in its stratum; a scale of 0 gives null.

    Aggregate and join: the statistics are outputs too. They are a row for each feature, and go to the cells, which are
    read twice and should not have to be computed for that (``lineage.staged``).
    """
    s = cells.where(F.col("value").isNotNull()).groupBy(*KEYS).agg(F.avg("value").alias("z_center"), F.stddev_samp("value").alias("z_scale"))
    s = s.withColumn("z_scale", F.when(F.col("z_scale") > 0, F.col("z_scale")))
    return cells.join(bounded(cut(s)), KEYS, "left").withColumn("value_z", (F.col("value") - F.col("z_center")) / F.col("z_scale"))


def rank_inverse_normal(cells: DataFrame) -> DataFrame:
    """value_t: Blom scores of average ranks per feature; features of three values or less get null."""
    have = cells.where(F.col("value").isNotNull())
    ranked = ranking.average_rank(have, KEYS, name="_rank", size="_k").withColumn("_p", (F.col("_rank") - 0.375) / (F.col("_k") + 0.25))
    ranked = ranked.withColumn("_p", F.when(F.col("_k") > 3, F.col("_p")))
    scored = E.with_norm_ppf(ranked, "_p", "value_t").drop("_rank", "_k", "_p")
    return scored.unionByName(cells.where(F.col("value").isNull()).withColumn("value_t", F.lit(None).cast("double")))


def decide(layer: str, cells: DataFrame, declared: dict[str, str] | None = None, stored: bool = False) -> Policy:
    """Measures the strata (a few rows come to the driver) and decides."""
    return decide_on(layer, stats.feature_stats(cells, stored), declared)


def decide_on(layer: str, feature_rows: DataFrame, declared: dict[str, str] | None = None) -> Policy:
    """The same from rows of feature_stats.

    Similar strata stay native; others are scaled, after a rank transform where a stratum is skewed.
    """
    s = feature_rows.persist()  # one row per feature, read twice
    sim = stats.similarity(stats.stratum_space(s)).first()
    skew = {r["stratum_key"]: r for r in stats.diagnostics_of(s).collect()}  # one row per stratum
    s.unpersist()
    z = not sim["similar"]
    transforms = {k: ("rank_int" if z and r["normality_ok"] is False else "none") for k, r in skew.items()}
    if sim["n_strata"] <= 1:
        why = "one stratum: nothing to reconcile"
    else:
        why = f"locations differ by {_fmt(sim['location_range'])} pooled SD, spreads by a factor of {_fmt(sim['spread_ratio'])}"
    labels = set((declared or {}).values())
    disagree = None
    if len(labels) == 1 and z and sim["n_strata"] > 1:
        disagree = f"all strata declare {next(iter(labels))}, but their distributions differ"
    elif len(labels) > 1 and not z:
        disagree = f"strata declare {sorted(labels)}, but their distributions agree"
    return Policy(layer, z, sim["location_range"], sim["spread_ratio"], sim["n_strata"], transforms, why, disagree)


def _fmt(x: float | None) -> str:
    return "an unknown amount" if x is None else f"{x:.3f}"


def apply(cells: DataFrame, policy: Policy) -> DataFrame:
    """Adds value_t (transformed, else the value), value_z (null if native), z_center, z_scale.

    The native value is never overwritten.
    """
    ranked = [k for k, t in policy.transforms.items() if t == "rank_int"]
    if ranked:
        is_ranked = F.col("stratum_key").isin(*ranked)
        plain = cells.where(~is_ranked).withColumn("value_t", F.col("value"))
        t = staged(rank_inverse_normal(cells.where(is_ranked)).unionByName(plain))
    else:
        t = cells.withColumn("value_t", F.col("value"))
    if not policy.z_applied:
        none = F.lit(None).cast("double")
        return t.withColumns({"z_center": none, "z_scale": none, "value_z": none})
    z = zscore(t.withColumnsRenamed({"value": "_native", "value_t": "value"}))
    return z.withColumnsRenamed({"value": "value_t", "_native": "value"})


def numeric_space(cells: DataFrame, policy: Policy, stored: bool = False) -> DataFrame:
    """One row: whether the strata share a numeric space on the surface that ships."""
    surface = "value_z" if policy.z_applied else "value"
    on = cells.select(*KEYS, F.col(surface).alias("value"))
    return stats.similarity(stats.stratum_space(stats.feature_stats(on, stored))).withColumn("surface", F.lit(surface)).withColumnRenamed("similar", "verified")
