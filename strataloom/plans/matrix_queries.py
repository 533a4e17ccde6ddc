"""Queries on cells: sources, statistics, policy, merge, limits of detection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions import expr as E
from strataloom.operators import features as FE
from strataloom.operators import layer as L
from strataloom.operators import policy as P
from strataloom.operators import ranking, stats
from strataloom.operators.lineage import staged
from strataloom.plans import oracles as O
from strataloom.sources import tables as T

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def r(c: str, digits: int = 6):
    return F.round(F.col(c), digits).alias(c)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[r(c, digits) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("SELECT event_type, user_id, round(avg(value), 6) AS value FROM events WHERE value IS NOT NULL GROUP BY ALL")
def cells_pivot_mean(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.pivot_mean(T.table(spark, d, "events"), "event_type", "user_id"))


@query("SELECT vec_id, (i - 1)::INTEGER AS dim, round(v::DOUBLE, 6) AS value FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)")
def unpivot_embeddings(spark: SparkSession, d: str) -> DataFrame:
    e = T.table(spark, d, "embeddings")
    return e.select("vec_id", F.posexplode("embedding").alias("dim", "value")).select("vec_id", "dim", F.round(F.col("value").cast("double"), 6).alias("value"))


@query("SELECT vec_id, 'd' || (i - 1) AS dim, round(v::DOUBLE, 6) AS value FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)")
def unpivot_wide_all(spark: SparkSession, d: str) -> DataFrame:
    """All 64 dimensions of the wide matrix by the operator."""
    e = T.table(spark, d, "embeddings")
    wide = e.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(f"d{i}") for i in range(64)])
    return rounded(L.unpivot(wide, ["vec_id"], "dim", "value"))


REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


@query(f"WITH c AS ({O.COHORTS}) SELECT feature_key, " + ", ".join(f"round(avg(value) FILTER (stratum_key = '{x}'), 4) AS {x.lower().replace(' ', '_')}" for x in REGIONS) + " FROM c GROUP BY feature_key")
def wide_bundle_matrix(spark: SparkSession, d: str) -> DataFrame:
    c = T.cohorts(spark, d).groupBy("stratum_key", "feature_key").agg(F.avg("value").alias("value")).withColumnRenamed("stratum_key", "specimen_id")
    w = L.wide_matrix(c, list(REGIONS))
    return rounded(w.withColumnsRenamed({x: x.lower().replace(" ", "_") for x in REGIONS}), 4)


@query("SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN round(log2(c_acctbal), 6) END AS value FROM customer")
def safe_log2(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "customer").select("c_custkey", F.round(E.safe_log2("c_acctbal"), 6).alias("value"))


#: Text of customers as a column of mixed content would hold it; both engines read this expression.
_STRINGS = """CASE c_custkey % 9 WHEN 0 THEN CAST(c_nationkey AS STRING) || '.5' WHEN 1 THEN ' ' || CAST(c_custkey AS STRING) || ' ' WHEN 2 THEN CAST(c_nationkey AS STRING) || 'e3' WHEN 3 THEN c_name
  WHEN 4 THEN '' WHEN 5 THEN '-0.' || CAST(c_custkey AS STRING) WHEN 6 THEN 'NaN' WHEN 7 THEN 'Infinity' END"""


@query(f"SELECT c_custkey, s, CASE WHEN isfinite(try_cast(trim(s) AS DOUBLE)) THEN try_cast(trim(s) AS DOUBLE) END AS value FROM (SELECT c_custkey, {_STRINGS} AS s FROM customer)")
def numeric_coerce(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "customer").select("c_custkey", F.expr(_STRINGS).alias("s")).select("c_custkey", "s", E.numeric("s").alias("value"))


@query(f"WITH c AS ({O.TWO_RUNS}), k AS ({O.KEPT}) SELECT stratum_key, feature_key, n_present, n_samples, round(present, 6) AS present, kept FROM k")
def feature_presence_filter(spark: SparkSession, d: str) -> DataFrame:
    c = staged(T.two_runs(spark, d))
    return rounded(stats.presence(c, T.samples_of(c)))


@query(f"WITH c AS ({O.MIXED.format(feature='p_brand')}), k AS ({O.KEPT}) SELECT stratum_key, count(*) AS n_features, count(*) FILTER (kept) AS n_kept FROM k GROUP BY 1")
def filter_wipe_out(spark: SparkSession, d: str) -> DataFrame:
    c = T.mixed_scales(spark, d, "p_brand")
    return stats.presence(c, T.samples_of(c)).groupBy("stratum_key").agg(F.count(F.lit(1)).alias("n_features"), F.count_if("kept").alias("n_kept"))


@query(
    f"WITH c AS ({O.MIXED.format(feature='p_brand')}), f AS (SELECT stratum_key, count(DISTINCT feature_key) AS n FROM c GROUP BY 1) "
    "SELECT stratum_key, specimen_id, count(value) AS n_detected, any_value(n) AS n_features, round(count(value) / any_value(n), 6) AS detection_rate, count(value) / any_value(n) >= 0.5 AS kept FROM c JOIN f USING (stratum_key) GROUP BY 1, 2"
)
def sample_completeness_drop(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.complete_samples(T.mixed_scales(spark, d, "p_brand"), 0.5))


@query(
    f"WITH c AS ({O.TWO_RUNS}) SELECT stratum_key, 'ACC' || (substr(feature_key, 7)::INTEGER % 6) AS feature_id, specimen_id, round(avg(value), 6) AS value FROM c GROUP BY ALL"
)
def collapse_duplicates(spark: SparkSession, d: str) -> DataFrame:
    c = T.two_runs(spark, d).withColumn("lod", F.lit(None).cast("double"))
    f = c.select("stratum_key", "feature_key").distinct().withColumn("src_ordinal", F.substring("feature_key", 7, 9).cast("int"))
    f = f.withColumn("feature_id", F.concat(F.lit("ACC"), (F.col("src_ordinal") % 6).cast("string")))
    out, _ = FE.collapse(c, f, rekey=True)
    return out.select("stratum_key", F.col("feature_key").alias("feature_id"), "specimen_id", r("value"))


@query(
    f"WITH c AS ({O.TWO_RUNS}), f AS (SELECT DISTINCT stratum_key, feature_key, substr(feature_key, 7)::INTEGER AS o FROM c) "
    "SELECT stratum_key, 'ACC' || (o % 6) AS feature_id, arg_min(feature_key, o) AS feature_key, count(*) AS n_collapsed FROM f GROUP BY 1, 2"
)
def collapse_metadata(spark: SparkSession, d: str) -> DataFrame:
    c = T.two_runs(spark, d).withColumn("lod", F.lit(None).cast("double"))
    f = c.select("stratum_key", "feature_key").distinct().withColumn("src_ordinal", F.substring("feature_key", 7, 9).cast("int"))
    f = f.withColumn("feature_id", F.concat(F.lit("ACC"), (F.col("src_ordinal") % 6).cast("string")))
    return FE.collapse(c, f)[1].select("stratum_key", "feature_id", "feature_key", "n_collapsed")


@query(f"WITH c AS ({O.COHORTS}), s AS ({O.STATS}), k AS ({O.SKEW}) SELECT s.stratum_key, s.feature_key, s.n, round(mean, 3) AS mean, round(s.sd, 3) AS sd, round(med, 3) AS median, round(skew, 6) AS skew FROM s LEFT JOIN k USING (stratum_key, feature_key)")
def feature_stats(spark: SparkSession, d: str) -> DataFrame:
    s = stats.feature_stats(T.cohorts(spark, d))
    return s.select("stratum_key", "feature_key", "n", r("mean", 3), r("sd", 3), r("median", 3), r("skew"))


@query(f"WITH c AS ({O.COHORTS}) SELECT stratum_key, round(quantile_cont(value, 0.01), 3) AS p1, round(quantile_cont(value, 0.5), 3) AS p50, round(quantile_cont(value, 0.99), 3) AS p99 FROM c GROUP BY 1")
def value_percentiles(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.percentiles(T.cohorts(spark, d)), 3)


def _similar_sql(cells: str) -> str:
    return f"WITH c AS ({cells}), s AS ({O.STATS}), sp AS ({O.SPACE}), m AS ({O.SIMILAR}) SELECT n_strata, round(location_range, 4) AS location_range, round(spread_ratio, 4) AS spread_ratio, location_range <= 0.5 AND spread_ratio <= 2.0 AS similar FROM m"


LAYERS = {"cohorts": O.COHORTS, "mixed": O.MIXED.format(feature="p_type"), "two_runs": O.TWO_RUNS}


def _stats_of_layers(spark: SparkSession, d: str) -> DataFrame:
    """Feature statistics of all layers, strata named layer|stratum. Lines are joined once, for all layers."""
    return stats.feature_stats(T.layers(spark, d))


@query(" UNION ALL ".join(f"SELECT '{k}' AS layer_key, * FROM ({_similar_sql(v)})" for k, v in LAYERS.items()))
def stratum_similarity(spark: SparkSession, d: str) -> DataFrame:
    """Feature statistics of all layers in one pass; each layer's strata are then compared on feature rows."""
    s, out = _stats_of_layers(spark, d), None
    for k in LAYERS:
        own = s.where(F.col("stratum_key").startswith(f"{k}|"))
        one = stats.similarity(stats.stratum_space(own)).select(F.lit(k).alias("layer_key"), "n_strata", r("location_range", 4), r("spread_ratio", 4), "similar")
        out = one if out is None else out.unionByName(one)
    return out


@query(" UNION ALL ".join(f"SELECT '{k}' AS layer_key, \"similar\" = false AS z_applied, n_strata FROM ({_similar_sql(v)})" for k, v in LAYERS.items()))
def layer_policy(spark: SparkSession, d: str) -> DataFrame:
    s = _stats_of_layers(spark, d).persist()  # a row for each feature
    found = [P.decide_on(k, s.where(F.col("stratum_key").startswith(f"{k}|"))) for k in LAYERS]
    s.unpersist()
    return spark.createDataFrame([(p.layer, p.z_applied, p.n_strata) for p in found], "layer_key string, z_applied boolean, n_strata bigint")


@query(f"WITH c AS ({O.MIXED.format(feature='p_type')}), s AS ({O.STATS}) SELECT stratum_key, feature_key, specimen_id, round((value - mean) / CASE WHEN sd > 0 THEN sd END, 4) + 0.0 AS value_z FROM c JOIN s USING (stratum_key, feature_key)")
def zscore_stratum(spark: SparkSession, d: str) -> DataFrame:
    z = P.zscore(staged(T.mixed_scales(spark, d)))
    return z.select("stratum_key", "feature_key", "specimen_id", (F.round("value_z", 4) + 0.0).alias("value_z"))


_RANKED = "SELECT *, rank() OVER (PARTITION BY stratum_key, feature_key ORDER BY value) + (count(*) OVER (PARTITION BY stratum_key, feature_key, value) - 1) / 2 AS rk, count(*) OVER (PARTITION BY stratum_key, feature_key) AS k FROM c"


@query(f"WITH c AS ({O.READINGS}), q AS ({_RANKED}) SELECT feature_key, specimen_id, round(CASE WHEN k > 3 THEN {E.norm_ppf_sql('((rk - 0.375) / (k + 0.25))')} END, 6) + 0.0 AS value_t FROM q")
def rank_inverse_normal(spark: SparkSession, d: str) -> DataFrame:
    t = P.rank_inverse_normal(T.readings(spark, d))
    return t.select("feature_key", "specimen_id", (F.round("value_t", 6) + 0.0).alias("value_t"))


@query(f"WITH c AS ({O.READINGS}), q AS ({_RANKED}) SELECT feature_key, specimen_id, rk::DOUBLE AS average_rank FROM q")
def average_rank(spark: SparkSession, d: str) -> DataFrame:
    return ranking.average_rank(T.readings(spark, d), list(stats.KEYS)).select("feature_key", "specimen_id", F.col("average_rank").cast("double").alias("average_rank"))


_LARGE = "SELECT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem"


@query(f"SELECT l_linestatus, count(*) AS n, round(median(l_extendedprice), 6) AS median FROM ({_LARGE}) GROUP BY ALL")
def large_group_medians(spark: SparkSession, d: str) -> DataFrame:
    """Two groups of lines, each beyond what a sketch holds exactly."""
    return rounded(ranking.medians(T.table(spark, d, "lineitem"), ["l_linestatus"], value="l_extendedprice"))


@query(
    f"SELECT l_returnflag, l_orderkey, l_linenumber, rank() OVER w + (count(*) OVER (PARTITION BY l_returnflag, l_extendedprice) - 1) / 2 AS by_price, rank() OVER q + (count(*) OVER (PARTITION BY l_returnflag, l_quantity) - 1) / 2 AS by_quantity "
    f"FROM ({_LARGE}) WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_extendedprice), q AS (PARTITION BY l_returnflag ORDER BY l_quantity)"
)
def large_group_ranks(spark: SparkSession, d: str) -> DataFrame:
    """Ranks in three groups of all lines: by price (nearly all different) and by quantity (50 values)."""
    lines = T.table(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    out = ranking.average_rank(lines, ["l_returnflag"], "l_extendedprice", "by_price")
    out = ranking.average_rank(out, ["l_returnflag"], "l_quantity", "by_quantity")
    return out.select("l_returnflag", "l_orderkey", "l_linenumber", F.col("by_price").cast("double").alias("by_price"), F.col("by_quantity").cast("double").alias("by_quantity"))


@query(
    f"WITH c AS ({O.READINGS}), s AS ({O.STATS}), k AS ({O.SKEW}) SELECT stratum_key, count(*) AS n_features, round(median(abs(skew)), 6) AS median_abs_skew, round(avg((abs(skew) > 1)::INTEGER) * 100, 6) AS pct_skewed, median(abs(skew)) <= 1 AS normality_ok FROM k WHERE n >= 8 GROUP BY 1"
)
def scale_diagnostics(spark: SparkSession, d: str) -> DataFrame:
    return rounded(stats.scale_diagnostics(T.readings(spark, d)))


@query(f"WITH c AS ({O.PLEXED}), p AS (SELECT feature_key, plex, median(value) AS m FROM c GROUP BY ALL), q AS (SELECT feature_key, median(m) AS centre FROM p GROUP BY 1) SELECT feature_key, specimen_id, plex, round(value - centre, 5) + 0.0 AS value FROM c JOIN q USING (feature_key)")
def median_of_plex_medians(spark: SparkSession, d: str) -> DataFrame:
    return stats.centre_on_plexes(T.plexed(spark, d)).select("feature_key", "specimen_id", "plex", (F.round("value", 5) + 0.0).alias("value"))


@query(
    f"WITH c AS ({O.PLEXED}), n AS (SELECT plex, count(DISTINCT specimen_id) AS plex_samples FROM c GROUP BY 1), f AS (SELECT feature_key, plex, count(value) AS n FROM c GROUP BY ALL), "
    "g AS (SELECT feature_key, count(*) FILTER (n > 0) AS plexes, count(*) FILTER (n > 0 AND n < plex_samples) AS part FROM f JOIN n USING (plex) GROUP BY 1) "
    "SELECT 'plexed' AS stratum_key, count(*) FILTER (part > 0) AS features_partial, count(*) FILTER (plexes = 0) AS features_empty, round(avg(plexes), 6) AS mean_plexes FROM g"
)
def plex_structure(spark: SparkSession, d: str) -> DataFrame:
    c = T.plexed(spark, d)
    per = c.groupBy("stratum_key", "plex").agg(F.count_distinct("specimen_id").alias("plex_samples"))
    return rounded(stats.plex_structure(c, per))


_MERGE = f"""WITH c AS ({O.TWO_RUNS}), k AS ({O.KEPT}), u AS (SELECT DISTINCT feature_key FROM k WHERE kept),
  g AS (SELECT stratum_key, specimen_id, feature_key FROM (SELECT DISTINCT stratum_key, specimen_id FROM c) CROSS JOIN u),
  m AS (SELECT g.*, CASE WHEN k.kept THEN c.value END AS value, CASE WHEN k.kept AND c.value IS NOT NULL THEN 0 WHEN k.kept THEN 1 WHEN k.kept = false THEN 3 ELSE 2 END::TINYINT AS missing_reason
        FROM g LEFT JOIN c USING (stratum_key, specimen_id, feature_key) LEFT JOIN k USING (stratum_key, feature_key)) """


def _merged(spark: SparkSession, d: str):
    """Samples with their cells, the samples, the cells, and what the filter says of their features."""
    packed = staged(T.two_runs_by_sample(spark, d))  # samples, filter and merge all read the cells
    c, s = packed.select(*L.PLACE, F.inline("_cells")), packed.select(*L.PLACE)
    return packed, s, c, L.kept_features(c, s)


@query(_MERGE + "SELECT stratum_key, missing_reason, count(*) AS n_cells FROM m GROUP BY 1, 2")
def merge_layer_reason(spark: SparkSession, d: str) -> DataFrame:
    packed, _, _, status = _merged(spark, d)
    return L.merge_samples(packed, status).groupBy("stratum_key", "missing_reason").agg(F.count(F.lit(1)).alias("n_cells"))


@query(_MERGE + "SELECT stratum_key, specimen_id, feature_key, round(value, 5) AS value, missing_reason FROM m")
def merge_layer_dense(spark: SparkSession, d: str) -> DataFrame:
    packed, _, _, status = _merged(spark, d)
    return rounded(L.merge_samples(packed, status).select("stratum_key", "specimen_id", "feature_key", "value", "missing_reason"), 5)


@query(_MERGE + "SELECT stratum_key, missing_reason, count(*) AS n_cells FROM m GROUP BY 1, 2")
def merge_reason_sparse(spark: SparkSession, d: str) -> DataFrame:
    """The same counts without the dense layer."""
    _, s, c, status = _merged(spark, d)
    return L.reason_counts(s, c, status)


@query(f"WITH c AS ({O.TWO_RUNS}), k AS ({O.KEPT}) SELECT feature_key, min(stratum_key) AS stratum_key FROM k WHERE kept GROUP BY 1")
def feature_union(spark: SparkSession, d: str) -> DataFrame:
    *_, status = _merged(spark, d)
    return L.feature_union(status.where("status = 'kept'"), ["F", "O"]).select("feature_key", "stratum_key")


@query(
    f"WITH c0 AS ({O.MIXED.format(feature='p_type')}), s0 AS (SELECT stratum_key, feature_key, avg(value) AS mean, stddev_samp(value) AS sd FROM c0 GROUP BY ALL), "
    "c AS (SELECT stratum_key, feature_key, (value - mean) / sd AS value FROM c0 JOIN s0 USING (stratum_key, feature_key)), "
    f"s AS ({O.STATS}), sp AS ({O.SPACE}), m AS ({O.SIMILAR}) SELECT 'value_z' AS surface, n_strata, round(location_range, 4) AS location_range, round(spread_ratio, 4) AS spread_ratio, location_range <= 0.5 AND spread_ratio <= 2 AS verified FROM m"
)
def numeric_space_check(spark: SparkSession, d: str) -> DataFrame:
    c = staged(T.mixed_scales(spark, d).drop("specimen_id"))  # statistics and scaling read the values
    p = P.Policy("mixed", True, None, None, 3, {}, "measured")
    return P.numeric_space(P.apply(c, p), p, stored=True).select("surface", "n_strata", r("location_range", 4), r("spread_ratio", 4), "verified")


@query(f"WITH c AS ({O.PANEL}) SELECT feature_key, specimen_id, CASE WHEN value IS NULL THEN NULL ELSE coalesce(value < lod, false) END AS below_lod FROM c")
def below_lod_tristate(spark: SparkSession, d: str) -> DataFrame:
    return T.panel(spark, d).select("feature_key", "specimen_id", E.below_lod("value", "lod").alias("below_lod"))


@query(
    f"WITH c AS ({O.PANEL}), f AS (SELECT feature_key, count(*) FILTER (value < lod) AS n_below, count(value) AS n_values FROM c GROUP BY 1) "
    "SELECT feature_key, n_below, n_values, round(n_below / greatest(n_values, 1), 6) AS frac_below_lod, CASE WHEN n_below / greatest(n_values, 1) >= 0.5 THEN 'gt50pct_below_lod' WHEN n_below / greatest(n_values, 1) >= 0.25 THEN 'gt25pct_below_lod' ELSE 'ok' END AS lod_flag FROM f"
)
def frac_below_lod_flag(spark: SparkSession, d: str) -> DataFrame:
    return rounded(FE.below_lod_features(T.panel(spark, d)).drop("stratum_key"))


@query(
    f"WITH c AS ({O.TWO_RUNS}), k AS ({O.KEPT}) SELECT stratum_key, count(*) AS n_features, max(n_samples) AS n_samples, sum(n_present)::BIGINT AS n_values, round(median(present * 100), 6) AS median_presence_pct, round(min(present * 100), 6) AS min_presence_pct, "
    "round((1 - sum(n_present) / (count(*) * max(n_samples))) * 100, 6) AS pct_missing FROM k GROUP BY 1"
)
def sparsity(spark: SparkSession, d: str) -> DataFrame:
    c = staged(T.two_runs(spark, d))
    return rounded(stats.sparsity(c, T.samples_of(c)))


@query(
    "WITH l AS (SELECT event_type AS feature_key, 1.5 * quantile_cont(value, 0.25) AS lod FROM events GROUP BY 1), "
    "f AS (SELECT feature_key, count(*) FILTER (value < lod) / count(value) AS b, count(*) FILTER (value < 5) / count(*) AS m FROM events JOIN l ON feature_key = event_type GROUP BY 1) "
    "SELECT count(*) AS n, round(median(abs(m - b)), 6) AS median_difference, round(max(abs(m - b)), 6) AS max_difference, round(corr(m, b), 5) AS correlation FROM f"
)
def missingness_cross_check(spark: SparkSession, d: str) -> DataFrame:
    readings = T.readings(spark, d)
    lod = ranking.quantile(readings, ["feature_key"], 0.25, name="lod").withColumn("lod", F.col("lod") * 1.5)
    ours = FE.below_lod_features(readings.join(F.broadcast(lod), "feature_key"))  # one limit per event type
    vendor = readings.groupBy("feature_key").agg((F.count_if(F.col("value") < 5) / F.count(F.lit(1))).alias("missing_freq"))
    out = stats.missingness_agreement(ours.join(vendor, "feature_key"))
    return out.select("n", r("median_difference"), r("max_difference"), r("correlation", 5))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
