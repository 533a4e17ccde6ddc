"""Returns by grant: each contributor gets the harmonized values of its own specimens.

The cohorts layer (a stratum for each region, a feature for each part type, a specimen for each
customer) is read from the tables, specimens that detect too few features are withheld, features that too
few specimens have are dropped, and values are Z-scored in their stratum. Every grant's slice is written as a
partition of ``<output>/returns``, the withheld specimens to ``<output>/withheld``.

What is written is read back and held against the specimens' owners: a specimen under another grant than
its own stops the job. Partitions of the grants at hand are replaced, so that a rerun gives the same rows (figures are rounded beyond what the order of a sum can change);
``grants`` in the settings renews those alone and leaves the others as they are.

Defined results: a grant that keeps no feature stops the job (its return would be empty); a value
without spread in its feature has no Z-score; specimens without any value are not part of the layer.

    python -m jobs.grant_returns --input TABLES --output OUT --config jobs/grant_returns.json
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import arguments, read_config, session, write_counted
from strataloom.operators import layer as L
from strataloom.operators import policy, stats
from strataloom.operators.contract import gated
from strataloom.operators.lineage import staged
from strataloom.sinks import writers as W
from strataloom.sources import tables as T

log = logging.getLogger("grant_returns")
SETTINGS = {"min_complete": 0.5, "min_present": 0.5, "grants": None}


def harmonized(cells: DataFrame, min_complete: float, min_present: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells of kept specimens and features with value_z, completeness of all specimens, feature status)."""
    complete = stats.complete_samples(cells, min_complete)
    own = cells.join(complete.where("kept").select("stratum_key", "specimen_id"), ["stratum_key", "specimen_id"], "left_semi")
    samples = complete.where("kept").select("stratum_key", "specimen_id")
    status = L.kept_features(own, samples, min_present)
    return policy.zscore(L.sparse(own, status)), complete, status


def settled(name: str, digits: int) -> Column:
    """Rounded, ties upward: sums that Spark adds in another order still give the same figure."""
    return (F.round(F.col(name) + 1e-9, digits) + 0.0).alias(name)


def run(spark: SparkSession, source: str, output: str, config: str | None = None) -> DataFrame:
    """Writes and verifies the returns; gives them as they stand, with their grant."""
    c = read_config(spark, config, SETTINGS)
    cells = T.cohorts(spark, source)
    if c["grants"] is not None:
        cells = cells.where(F.col("stratum_key").isin(*c["grants"]))
    cells = staged(cells)  # completeness, filter, scaling and both outputs read them
    values, complete, status = harmonized(cells, c["min_complete"], c["min_present"])
    # a row for each grant: counted before anything is written
    for r in status.groupBy("stratum_key").agg(F.count_if(F.col("status") == "kept").alias("kept"), F.count(F.lit(1)).alias("n")).collect():
        log.info("grant %s: %d of %d features kept", r["stratum_key"], r["kept"], r["n"])
        L.guard_features(r["kept"], r["stratum_key"])
    figures = [settled(x, digits) for x, digits in (("value", 6), ("z_center", 3), ("z_scale", 3), ("value_z", 4))]
    returns = values.select(F.col("stratum_key").alias("grant"), "specimen_id", "feature_key", *figures)
    write_counted(gated(returns), f"{output}/returns", "grant", log)
    withheld = complete.where(~F.col("kept")).select(F.col("stratum_key").alias("grant"), "specimen_id", "n_detected", "n_features", "detection_rate")
    write_counted(gated(withheld), f"{output}/withheld", "grant", log)
    verify(spark, source, output)
    return spark.read.schema(returns.schema).parquet(f"{output}/returns")


def verify(spark: SparkSession, source: str, output: str) -> None:
    """Reads the returns back: no specimen may stand under a grant that does not own it."""
    owner = T.owners(spark, source).select(F.lit("cohorts").alias("layer_key"), F.col("c_custkey").cast("string").alias("specimen_id"), F.col("r_name").alias("grant")).distinct()
    found = spark.read.parquet(f"{output}/returns").select(F.lit("cohorts").alias("layer_key"), "grant", "specimen_id").distinct()
    rows = W.return_boundary(found, owner).collect()  # a row for each grant
    for r in rows:
        log.info("grant %s: %d specimens returned, %d of other grants", r["grant"], r["n_specimens"], r["n_foreign"])
    foreign = sorted(r["grant"] for r in rows if r["n_foreign"])
    if foreign:
        raise ValueError(f"specimens of other grants in the returns of {foreign}")


def main() -> None:
    a = arguments("Returns by grant", "input", "output")
    spark = session("grant_returns")
    try:
        run(spark, a.input, a.output, a.config)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
