"""DuckDB SQL of the table adapters, as common table expressions for the oracle queries."""

LINES = "lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey"

MIXED = f"""SELECT l_returnflag AS stratum_key, {{feature}} AS feature_key, o_custkey::VARCHAR AS specimen_id,
  CASE l_returnflag WHEN 'A' THEN log2(avg(l_extendedprice)) WHEN 'N' THEN avg(l_quantity) ELSE avg(l_discount) END AS value
  FROM {LINES} GROUP BY l_returnflag, {{feature}}, o_custkey"""
TWO_RUNS = f"""SELECT l_linestatus AS stratum_key, p_brand AS feature_key, o_custkey::VARCHAR AS specimen_id, log2(avg(l_extendedprice)) AS value
  FROM {LINES} GROUP BY ALL"""
COHORTS = f"""SELECT r_name AS stratum_key, p_type AS feature_key, c_custkey::VARCHAR AS specimen_id, avg(l_extendedprice) AS value
  FROM {LINES} JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""
PANEL = """SELECT 'events' AS stratum_key, event_type AS feature_key, user_id::VARCHAR AS specimen_id, avg(value) AS value,
  any_value(l.lod) AS lod FROM events JOIN (SELECT event_type AS t, quantile_cont(value, 0.25) AS lod FROM events GROUP BY 1) l ON event_type = t GROUP BY ALL"""
READINGS = "SELECT 'events' AS stratum_key, event_type AS feature_key, event_id::VARCHAR AS specimen_id, value FROM events"
PLEXED = f"""SELECT 'plexed' AS stratum_key, p_brand AS feature_key, l_suppkey::VARCHAR AS specimen_id, l_linenumber::VARCHAR AS plex, log2(avg(l_extendedprice)) AS value
  FROM {LINES} GROUP BY ALL"""
ORDERS = """SELECT o_orderstatus AS stratum_key, o_orderkey::VARCHAR AS specimen_source_value, CASE WHEN c_acctbal >= 0 THEN c_custkey::VARCHAR END AS person_source_value,
  ((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1)::INTEGER AS visit_month, NULL::INTEGER AS visit_index, 'site ' || c_nationkey AS anatomic_site,
  o_orderkey AS sample_ordinal, c_mktsegment AS platform, o_orderpriority = '5-LOW' AS is_pool, o_totalprice AS total
  FROM orders JOIN customer ON o_custkey = c_custkey"""

#: Per-feature statistics of cells c.
STATS = """SELECT stratum_key, feature_key, count(value) AS n, avg(value) AS mean, stddev_samp(value) AS sd, median(value) AS med FROM c WHERE value IS NOT NULL GROUP BY ALL"""
SKEW = """SELECT c.stratum_key, c.feature_key, any_value(s.n) AS n, any_value(s.sd) AS sd, avg(((c.value - s.mean) / s.sd) ** 3) AS skew
  FROM c JOIN s USING (stratum_key, feature_key) WHERE c.value IS NOT NULL AND s.sd > 0 GROUP BY c.stratum_key, c.feature_key"""
SPACE = "SELECT stratum_key, median(med) AS location, median(sd) FILTER (sd > 0) AS spread FROM s GROUP BY stratum_key"
SIMILAR = """SELECT count(*) AS n_strata, (max(location) - min(location)) / median(spread) AS location_range, median(spread) AS pooled_sd, max(spread) / min(spread) AS spread_ratio FROM sp"""
KEPT = """SELECT p.stratum_key, p.feature_key, p.n_present, n.n_samples, p.n_present / n.n_samples AS present, p.n_present / n.n_samples >= 0.5 AS kept
  FROM (SELECT stratum_key, feature_key, count(value) AS n_present FROM c GROUP BY ALL) p
  JOIN (SELECT stratum_key, count(DISTINCT specimen_id) AS n_samples FROM c GROUP BY 1) n USING (stratum_key)"""
