"""Queries on the sample table, identity, files, audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.audit import checks
from strataloom.functions import expr as E
from strataloom.model import DENIED, DENY_EXEMPT, EXTRA_DECLARED, LayerSpec, Material, Method, Origin, Scale, Source, Stated, Stratum
from strataloom.operators import contract, lookups, stats
from strataloom.operators import features as FE
from strataloom.operators import layer as L
from strataloom.operators import samples as S
from strataloom.operators.lineage import staged
from strataloom.plans import oracles as O
from strataloom.plans.matrix_queries import r
from strataloom.sources import manifest as M
from strataloom.sources import readers as R
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


def _values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows) + ")"


_K = "try_cast(json_extract_string(props, '$.k') AS INTEGER)"


def _qc_events(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("int")
    ev = T.table(spark, d, "events")
    return ev.select("user_id", F.when(k < 2, "WARN").otherwise("PASS").alias("QC_Warning"), F.when(k.between(2, 3), "FAIL").when(k.between(4, 50), "pass").alias("Distribution_QC"), F.when(k >= 97, "WARN").otherwise("PASS").alias("Outliers_QC"))


_QC = f"""SELECT user_id, coalesce(bool_or({_K} < 2), false) AS a, coalesce(bool_or({_K} BETWEEN 2 AND 3), false) AS b, coalesce(bool_or({_K} >= 97), false) AS c FROM events GROUP BY 1"""


@query(f"SELECT user_id, CASE WHEN a OR b OR c THEN 'WARN' ELSE 'PASS' END AS qc_status, 'QC_Warning|Distribution_QC|Outliers_QC=' || CASE WHEN a THEN 'WARN' ELSE 'PASS' END || '|' || CASE WHEN b THEN 'WARN' ELSE 'PASS' END || '|' || CASE WHEN c THEN 'WARN' ELSE 'PASS' END AS qc_detail FROM ({_QC})")
def qc_worst_of(spark: SparkSession, d: str) -> DataFrame:
    return S.qc_summary(_qc_events(spark, d), ["user_id"]).select("user_id", "qc_status", "qc_detail")


@query(f"SELECT a::INTEGER + b::INTEGER + c::INTEGER AS qc_warn_count, count(*) AS n_samples FROM ({_QC}) GROUP BY 1")
def qc_warn_count(spark: SparkSession, d: str) -> DataFrame:
    return S.qc_summary(_qc_events(spark, d), ["user_id"]).groupBy("qc_warn_count").agg(F.count(F.lit(1)).alias("n_samples"))


_PLATED = "SELECT 'P' || (event_id % 8) AS plate, user_id::VARCHAR || ':' || (event_id % 8) AS sample_id, user_id AS participant_id FROM events"


def _plated(spark: SparkSession, d: str) -> DataFrame:
    plate = (F.col("event_id") % 8).cast("string")
    return T.table(spark, d, "events").select(F.concat(F.lit("P"), plate).alias("PlateID"), F.concat_ws(":", F.col("user_id").cast("string"), plate).alias("sample_id"), F.col("user_id").alias("participant_id"))


@query(
    f"WITH p AS ({_PLATED}), w AS (SELECT * FROM p WHERE plate IN ('P0', 'P1')) SELECT count(DISTINCT sample_id) AS n_samples, (SELECT count(DISTINCT participant_id) FROM w WHERE participant_id NOT IN (SELECT participant_id FROM p WHERE plate NOT IN ('P0', 'P1'))) AS n_persons_lost FROM w"
)
def withdraw_by_plate(spark: SparkSession, d: str) -> DataFrame:
    return S.withdraw_plates(_plated(spark, d), ["P0", "P1"])[1]


@query(f"WITH p AS ({_PLATED}) SELECT plate, count(*) AS n_rows, count(DISTINCT sample_id) AS n_samples FROM p WHERE plate NOT IN ('P0', 'P1') GROUP BY 1")
def withdraw_kept_rows(spark: SparkSession, d: str) -> DataFrame:
    kept = S.withdraw_plates(_plated(spark, d), ["P0", "P1"])[0]
    return kept.groupBy(F.col("PlateID").alias("plate")).agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("sample_id").alias("n_samples"))


@query("SELECT c_custkey, o_orderkey, round(o_totalprice, 4) AS o_totalprice FROM customer LEFT JOIN (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1) ON c_custkey = o_custkey")
def lookup_first_match(spark: SparkSession, d: str) -> DataFrame:
    o = T.table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice", F.col("o_orderkey").alias("src_ordinal"))
    return lookups.lookup_first(T.table(spark, d, "customer").select("c_custkey"), o, ["c_custkey"]).select("c_custkey", "o_orderkey", r("o_totalprice", 4))


@query("SELECT c_custkey::VARCHAR AS specimen_source_value, coalesce(CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END, 'annotated ' || c_nationkey) AS platform, c_nationkey AS nation FROM customer")
def annotation_coalesce(spark: SparkSession, d: str) -> DataFrame:
    c = T.table(spark, d, "customer")
    key = F.col("c_custkey").cast("string").alias("specimen_source_value")
    own = c.select(key, F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("platform"))
    annotation = c.select(key, F.concat(F.lit("annotated "), F.col("c_nationkey").cast("string")).alias("platform"), F.col("c_nationkey").alias("nation"))
    return lookups.coalesce_annotation(own, annotation)


_STATED = "CASE WHEN c_custkey % 7 = 0 THEN 'BA' || (c_custkey % 50) END"


@query(
    f"WITH s AS (SELECT c_custkey, c_nationkey, c_mktsegment, {_STATED} AS area FROM customer), f AS (SELECT c_nationkey, c_mktsegment, arg_min(area, c_custkey) AS v FROM s WHERE area IS NOT NULL GROUP BY ALL) "
    "SELECT c_custkey, coalesce(area, v) AS area, CASE WHEN area IS NOT NULL THEN 'source' WHEN v IS NOT NULL THEN 'propagated' END AS evidence FROM s LEFT JOIN f USING (c_nationkey, c_mktsegment)"
)
def composite_propagation(spark: SparkSession, d: str) -> DataFrame:
    c = T.table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("BA"), (F.col("c_custkey") % 50).cast("string"))).alias("area"), F.col("c_custkey").alias("src_ordinal"))
    return lookups.propagate(c, c, ["c_nationkey", "c_mktsegment"], "area", "evidence").select("c_custkey", "area", "evidence")


@query(f"SELECT c_custkey, coalesce({_STATED}, 'BA9') AS brodmann_area, CASE WHEN {_STATED} IS NULL THEN 'convention' ELSE 'source' END AS brodmann_area_evidence FROM customer")
def convention_fill_evidence(spark: SparkSession, d: str) -> DataFrame:
    c = T.table(spark, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("BA"), (F.col("c_custkey") % 50).cast("string"))).alias("brodmann_area"))
    return S.brodmann_fill(c, "Dorsolateral prefrontal cortex").select("c_custkey", "brodmann_area", "brodmann_area_evidence")


@query(f"WITH s AS (SELECT {_STATED} AS a FROM customer) SELECT count(*) FILTER (a IS NOT NULL) AS n_source, 0::BIGINT AS n_propagated, count(*) FILTER (a IS NULL) AS n_convention, 0::BIGINT AS n_unfilled, count(*) FILTER (a IS NOT NULL AND a <> 'BA9') AS n_disagree FROM s")
def convention_report(spark: SparkSession, d: str) -> DataFrame:
    c = T.table(spark, d, "customer").select(F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("BA"), (F.col("c_custkey") % 50).cast("string"))).alias("brodmann_area"))
    return S.brodmann_report(S.brodmann_fill(c, "dorsolateral prefrontal cortex"), "dorsolateral prefrontal cortex")


_INTERVALS = {"hours_like": 0.002, "minutes_like": 0.1, "too_large": 10.0}


@query(
    " UNION ALL ".join(
        f"SELECT '{k}' AS lookup, CASE WHEN median(v) BETWEEN 0.5 AND 120 THEN 'hours' WHEN median(v) BETWEEN 30 AND 7200 THEN 'minutes' END AS unit, "
        f"CASE WHEN median(v) BETWEEN 0.5 AND 7200 THEN count(v) ELSE 0 END AS n_populated, round(CASE WHEN median(v) BETWEEN 0.5 AND 120 THEN median(v) WHEN median(v) BETWEEN 30 AND 7200 THEN median(v * (1 / 60::DOUBLE)) END, 5) AS median_hours FROM (SELECT abs(c_acctbal) * {f}::DOUBLE AS v FROM customer)"
        for k, f in _INTERVALS.items()
    )
)
def unit_inference(spark: SparkSession, d: str) -> DataFrame:
    c = T.table(spark, d, "customer")
    people = c.select(F.col("c_custkey").cast("string").alias("person_source_value"))
    rows = []
    for k, f in _INTERVALS.items():
        lookup = c.select(F.col("c_custkey").cast("string").alias("person_source_value"), (F.abs("c_acctbal") * F.lit(f)).cast("string").alias("interval"), F.col("c_custkey").alias("src_ordinal"))
        out, note = S.attach_interval(people, lookup)
        one = S.interval_report(out).first()
        rows.append((k, note["unit"], one["n_populated"], None if one["median_hours"] is None else round(one["median_hours"], 5)))
    return spark.createDataFrame(rows, "lookup string, unit string, n_populated bigint, median_hours double")


# Strings of the tables as sources would write them: expressions that both engines read.
_IDS = """CASE c_custkey % 8 WHEN 0 THEN ' PD-' || CAST(c_custkey AS STRING) || ' ' WHEN 1 THEN CAST(c_custkey AS STRING) || '.0' WHEN 2 THEN 'Unknown' WHEN 3 THEN 'NaN' WHEN 4 THEN '' WHEN 5 THEN CAST(c_nationkey AS STRING) || '.50'
  WHEN 6 THEN 'not reported' ELSE CAST(c_custkey AS STRING) || '.000' END"""
_SPACE = "CASE WHEN c_nationkey % 3 = 0 THEN c_mktsegment END"
_SENTINELS = "('', 'nan', 'na', 'n/a', 'none', 'null', '<na>', 'unknown', 'unk', 'missing', 'not applicable', 'not collected', 'not reported')"


@query(
    f"WITH t AS (SELECT c_custkey, raw, coalesce(ns, 'study.id') AS ns, CASE WHEN lower(trim(raw)) NOT IN {_SENTINELS} THEN regexp_replace(trim(raw), '^(\\d+)\\.0+$', '\\1') END AS p FROM (SELECT c_custkey, {_IDS} AS raw, {_SPACE} AS ns FROM customer)) "
    "SELECT c_custkey, raw, p AS person_id, ns AS person_source_namespace, CASE WHEN p IS NOT NULL THEN ns || ':' || p END AS person_global_key FROM t"
)
def person_identity(spark: SparkSession, d: str) -> DataFrame:
    s = T.table(spark, d, "customer").select("c_custkey", F.expr(_IDS).alias("raw"), F.expr(_IDS).alias("person_source_value"), F.expr(_SPACE).alias("person_source_namespace_row"))
    return S.with_identity(s, "study.id").select("c_custkey", "raw", "person_id", "person_source_namespace", "person_global_key")


_KEYS = """CASE o_orderkey % 4 WHEN 0 THEN 'b' || CAST(o_custkey % 90 AS STRING) || 'r' || CAST(o_orderkey % 3 AS STRING) || '_0' || CAST(o_orderkey % 9 AS STRING) || '_' || CAST(o_orderkey AS STRING)
  WHEN 1 THEN 'b' || CAST(o_custkey AS STRING) || '_03_' || CAST(o_orderkey AS STRING) WHEN 2 THEN 'site_b' || CAST(o_custkey % 5 AS STRING) || '_00' || CAST(o_orderkey % 9 AS STRING) || '_11' ELSE o_orderstatus || '_' || CAST(o_orderkey AS STRING) END"""


@query(
    "SELECT o_orderkey, k AS label, CASE WHEN len(string_split(k, '_')) = 3 THEN regexp_replace(split_part(k, '_', 1), '^b(\\d+)r(\\d+)$', 'r\\2b\\1') || '_' || split_part(k, '_', 3) || '_' || split_part(k, '_', 2) ELSE k END AS specimen_key, "
    f"CASE WHEN len(string_split(k, '_')) >= 3 THEN split_part(k, '_', 2) || '_' || split_part(k, '_', 3) ELSE k END AS prefixed FROM (SELECT o_orderkey, {_KEYS} AS k FROM orders)"
)
def key_rewrite(spark: SparkSession, d: str) -> DataFrame:
    o = T.table(spark, d, "orders").select("o_orderkey", F.expr(_KEYS).alias("label"))
    return o.select("o_orderkey", "label", E.plex_channel_key("label").alias("specimen_key"), E.prefixed_key("label").alias("prefixed"))


def _acc(k: str, first: str = "P") -> str:
    """An accession of a key, as an expression of both engines."""
    return f"'{first}' || CAST({k} % 10 AS STRING) || 'XY' || CAST({k} % 9 AS STRING) || CAST({k} % 7 AS STRING)"


_ACC = f"""CASE p_partkey % 7 WHEN 0 THEN 'sp|' || {_acc("p_partkey")} || '|NAME_HUMAN' WHEN 1 THEN {_acc("p_partkey", "Q")} || '-2' WHEN 2 THEN 'A' || CAST(p_partkey % 10 AS STRING) || 'A024RBG' || CAST(p_partkey % 8 AS STRING) || ';' || {_acc("p_partkey", "O")}
  WHEN 3 THEN p_name WHEN 4 THEN 'CON__' || {_acc("p_partkey")} WHEN 5 THEN '' ELSE {_acc("p_partkey")} || ' ' || {_acc("p_size", "Q")} || ' ' || p_brand END"""


@query(f"SELECT p_partkey, s, nullif(regexp_extract(s, '({E.ACCESSION})', 1), '') AS accession, len(regexp_extract_all(s, '({E.ACCESSION})', 1))::INTEGER AS n FROM (SELECT p_partkey, {_ACC} AS s FROM part)")
def accession_extract(spark: SparkSession, d: str) -> DataFrame:
    p = T.table(spark, d, "part").select("p_partkey", F.expr(_ACC).alias("s"))
    return p.select("p_partkey", "s", E.accession("s").alias("accession"), F.size(E.accessions("s")).alias("n"))


_GROUPS = f"""CASE p_partkey % 5 WHEN 0 THEN {_acc("p_partkey")} || ';' || {_acc("p_size", "Q")} WHEN 1 THEN 'REV__' || {_acc("p_partkey")} WHEN 2 THEN 'CON__;' || p_brand WHEN 3 THEN 'A0A024RBG' || CAST(p_size % 9 AS STRING)
  ELSE p_type || ';' || {_acc("p_partkey")} || '-2;' || {_acc("p_size", "O")} END"""


@query(
    f"WITH v AS (SELECT p_partkey, s, list_filter(list_transform(string_split(s, ';'), lambda x: nullif(regexp_extract(x, '({E.ACCESSION})', 1), '')), lambda x: x IS NOT NULL) AS a FROM (SELECT p_partkey, {_GROUPS} AS s FROM part)) "
    "SELECT p_partkey, s AS feature_source_value, a[1] AS feature_id, CASE WHEN len(a) > 0 THEN array_to_string(a, ';') ELSE s END AS protein_group, greatest(len(a), 1)::SMALLINT AS protein_group_size FROM v"
)
def feature_resolution_groups(spark: SparkSession, d: str) -> DataFrame:
    f = T.table(spark, d, "part").select("p_partkey", F.expr(_GROUPS).alias("feature_source_value"))
    return FE.resolve(f, "maxquant").select("p_partkey", "feature_source_value", "feature_id", "protein_group", "protein_group_size")


_PAIRS = f"""CASE p_partkey % 6 WHEN 0 THEN p_brand || '|' || {_acc("p_partkey")} WHEN 1 THEN 'NA|' || {_acc("p_partkey")} WHEN 2 THEN '|' || {_acc("p_partkey")} WHEN 3 THEN p_brand || '|' WHEN 4 THEN p_name ELSE 'None| ' || {_acc("p_partkey")} || '|x' END"""
_AFTER = "nullif(CASE WHEN contains(s, '|') THEN trim(substr(s, instr(s, '|') + 1)) ELSE '' END, '')"
_BEFORE = "CASE WHEN split_part(s, '|', 1) NOT IN ('', 'NA', 'nan', 'None') THEN split_part(s, '|', 1) END"


@query(f"SELECT p_partkey, s AS feature_source_value, {_AFTER} AS feature_id, {_BEFORE} AS gene_symbol FROM (SELECT p_partkey, {_PAIRS} AS s FROM part)")
def feature_resolution_pairs(spark: SparkSession, d: str) -> DataFrame:
    f = T.table(spark, d, "part").select("p_partkey", F.expr(_PAIRS).alias("feature_source_value"))
    return FE.resolve(f, "csv_matrix").select("p_partkey", "feature_source_value", "feature_id", "gene_symbol")


#: reader -> (feature_source_value, uniprot_raw, gene_raw) of a part; the reference is of suppliers.
_BRANCHES = {
    "reporter_xlsx": (f"CASE WHEN p_size % 5 = 0 THEN 'NA|' || p_name ELSE p_brand || '|sp|' || {_acc('p_partkey')} || '|X_HUMAN' END", "NULL", "NULL"),
    "srm": ("CASE p_partkey % 4 WHEN 0 THEN 'tau_' || p_brand || '_4' WHEN 1 THEN 'bA38' ELSE 'SYM' || CAST(p_partkey % 60 AS STRING) || '_' || CAST(p_size AS STRING) END", "NULL", "NULL"),
    "somascan": ("'seq.' || CAST(p_partkey AS STRING)", f"CASE WHEN p_size % 4 = 0 THEN 'none' ELSE {_acc('p_partkey')} || ' ' || {_acc('p_size', 'Q')} END", "CASE WHEN p_size % 3 = 0 THEN '\"\"' WHEN p_size % 3 = 1 THEN 'NA' ELSE p_brand END"),
    "olink": (_acc("p_partkey"), f"CASE WHEN p_size % 6 = 0 THEN 'no accession ' || p_brand ELSE 'isoform ' || {_acc('p_partkey')} || '-1' END", "NULL"),
    "dia": (_acc("p_partkey"), _acc("p_partkey"), "NULL"),
    "pd_ratio": (_PAIRS, "NULL", "NULL"),
}
_REF = f"SELECT {_acc('s_suppkey')} AS uniprot, CASE WHEN s_suppkey % 11 <> 0 THEN 'SYM' || CAST(s_suppkey % 40 AS STRING) END AS symbol, s_suppkey AS src_ordinal FROM supplier"
_LIST = f"regexp_extract_all(u, '({E.ACCESSION})', 1)"


def _first(s: str) -> str:
    return f"nullif(regexp_extract({s}, '({E.ACCESSION})', 1), '')"


@query(
    "WITH f AS (" + " UNION ALL ".join(f"SELECT '{k}' AS reader, p_partkey, {a} AS s, {u} AS u, {g} AS g FROM part" for k, (a, u, g) in _BRANCHES.items()) + f"), ref AS ({_REF}), "
    "fw AS (SELECT symbol, arg_min(uniprot, src_ordinal) AS acc, min(src_ordinal) AS o FROM ref WHERE symbol IS NOT NULL GROUP BY 1), bk AS (SELECT acc, arg_max(symbol, o) AS sym FROM fw GROUP BY 1), "
    "x AS (SELECT f.*, CASE WHEN reader = 'srm' THEN CASE WHEN starts_with(s, 'tau') THEN 'MAPT' ELSE regexp_replace(s, '_\\d+$', '') END END AS sy FROM f), "
    f"y AS (SELECT x.*, CASE reader WHEN 'reporter_xlsx' THEN {_first('coalesce(' + _AFTER + ', chr(32))')} WHEN 'srm' THEN coalesce(CASE WHEN sy IN ('bA', 'bA38') THEN 'P05067' END, fw.acc) WHEN 'somascan' THEN {_LIST}[1] WHEN 'pd_ratio' THEN {_AFTER} ELSE coalesce({_first('u')}, u) END AS id, "
    f"CASE reader WHEN 'srm' THEN sy WHEN 'somascan' THEN CASE WHEN trim(g, '\" ') NOT IN ('', 'NA', 'nan', 'None') THEN trim(g, '\" ') END WHEN 'reporter_xlsx' THEN {_BEFORE} WHEN 'pd_ratio' THEN {_BEFORE} END AS gene FROM x LEFT JOIN fw ON sy = fw.symbol) "
    "SELECT reader, p_partkey, s AS feature_source_value, id AS feature_id, coalesce(gene, bk.sym) AS gene_symbol, "
    f"CASE reader WHEN 'reporter_xlsx' THEN CASE WHEN contains(s, '|') THEN substr(s, instr(s, '|') + 1) ELSE '' END WHEN 'somascan' THEN CASE WHEN len({_LIST}) > 0 THEN array_to_string({_LIST}, ';') END ELSE id END AS protein_group, "
    f"CASE WHEN reader = 'somascan' THEN greatest(len({_LIST}), 1) ELSE 1 END::SMALLINT AS protein_group_size FROM y LEFT JOIN bk ON bk.acc = id"
)
def feature_resolution_branches(spark: SparkSession, d: str) -> DataFrame:
    """The other six readers' resolution, with accession by symbol and symbol by accession of a reference."""
    part, ref = T.table(spark, d, "part"), T.table(spark, d, "supplier").selectExpr(*[x.strip() for x in (_acc("s_suppkey") + " AS uniprot", "CASE WHEN s_suppkey % 11 <> 0 THEN 'SYM' || CAST(s_suppkey % 40 AS STRING) END AS symbol", "s_suppkey AS src_ordinal")])
    out = None
    for reader, (a, u, g) in _BRANCHES.items():
        f = part.select(F.lit(reader).alias("reader"), "p_partkey", F.expr(a).alias("feature_source_value"), F.expr(u).cast("string").alias("uniprot_raw"), F.expr(g).cast("string").alias("gene_raw"))
        one = FE.resolve(f, reader, ref).select("reader", "p_partkey", "feature_source_value", "feature_id", "gene_symbol", "protein_group", "protein_group_size")
        out = one if out is None else out.unionByName(one)
    return out


@query("SELECT p_partkey, p_brand AS feature_id, CASE WHEN count(*) OVER (PARTITION BY p_type, p_brand) > 1 THEN p_brand || '__' || p_partkey ELSE p_brand END AS feature_key FROM part")
def feature_key(spark: SparkSession, d: str) -> DataFrame:
    p = T.table(spark, d, "part").select("p_partkey", F.col("p_type").alias("stratum_key"), F.col("p_brand").alias("feature_id"), F.col("p_partkey").cast("string").alias("feature_source_value"))
    return FE.with_feature_key(p).select("p_partkey", "feature_id", "feature_key")


def _identified(spark: SparkSession, d: str) -> DataFrame:
    return S.with_identity(T.order_samples(spark, d), "orders.custkey")


_KEYED = f"""WITH o AS ({O.ORDERS}), i AS (SELECT *, CASE WHEN person_source_value IS NOT NULL THEN 'orders.custkey:' || person_source_value END AS gk FROM o),
  k AS (SELECT *, coalesce(gk, 'UNRESOLVED') || '|' || replace(anatomic_site, ' ', '-') || '|M' || visit_month AS short FROM i),
  n AS (SELECT count(*) AS n, count(DISTINCT short) AS s, count(DISTINCT short || '|' || stratum_key) AS l FROM k),
  c AS (SELECT k.*, CASE WHEN n.s < n.n AND n.l > n.s THEN short || '|' || stratum_key ELSE short END AS key FROM k CROSS JOIN n) """


@query(_KEYED + "SELECT sample_ordinal, key || CASE WHEN count(*) OVER (PARTITION BY key) > 1 THEN '|R' || row_number() OVER (PARTITION BY key ORDER BY sample_ordinal) ELSE '' END AS row_key FROM c")
def row_key(spark: SparkSession, d: str) -> DataFrame:
    return S.row_key(_identified(spark, d)).select("sample_ordinal", "row_key")


@query(f"WITH o AS ({O.ORDERS}) SELECT sample_ordinal, (row_number() OVER (PARTITION BY coalesce(person_source_value, '') ORDER BY sample_ordinal))::INTEGER AS replicate_index FROM o")
def replicate_index(spark: SparkSession, d: str) -> DataFrame:
    return S.replicate_index(_identified(spark, d)).select("sample_ordinal", "replicate_index")


@query(f"WITH o AS ({O.ORDERS}) SELECT stratum_key || ':' || specimen_source_value AS specimen_id, stratum_key || ':' || specimen_source_value || '|M' || visit_month AS visit_occurrence_id FROM o")
def visit_axis(spark: SparkSession, d: str) -> DataFrame:
    return S.with_visits(T.order_samples(spark, d)).select("specimen_id", "visit_occurrence_id")


@query("SELECT o_orderkey, ((o_orderkey % 5) * 12)::INTEGER AS visit_month, 'derived_from_visit_index' AS visit_month_evidence FROM orders")
def visit_from_index(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "orders").select("o_orderkey", *S.visit_month_from_index((F.col("o_orderkey") % 5).cast("string")))


@query(f"WITH o AS ({O.ORDERS}) SELECT stratum_key, count(*) AS n_samples, count(*) FILTER (person_source_value IS NULL AND NOT is_pool) AS n_dropped FROM o GROUP BY 1")
def unresolved_drop_counts(spark: SparkSession, d: str) -> DataFrame:
    s = T.order_samples(spark, d)
    n = s.groupBy("stratum_key").agg(F.count(F.lit(1)).alias("n_samples"))
    kept = S.drop_unresolved(s).groupBy("stratum_key").agg(F.count(F.lit(1)).alias("n_kept"))
    return n.join(kept, "stratum_key", "left").select("stratum_key", "n_samples", (F.col("n_samples") - F.coalesce("n_kept", F.lit(0))).alias("n_dropped"))


@query("SELECT stratum_key, CASE WHEN count(*) = 1 THEN any_value(platform) ELSE 'mixed per sample: ' || string_agg(platform || ' (' || n || '/' || total || ')', '; ' ORDER BY platform) END AS platform FROM (SELECT stratum_key, platform, count(*) AS n, sum(count(*)) OVER (PARTITION BY stratum_key) AS total FROM (" + O.ORDERS + ") GROUP BY 1, 2) GROUP BY 1")
def observed_platform(spark: SparkSession, d: str) -> DataFrame:
    return S.observed_platform(T.order_samples(spark, d)).select("stratum_key", "platform")


@query("SELECT c_custkey::VARCHAR AS specimen_source_value, CASE WHEN c_custkey % 3 = 0 THEN 'lot ' || c_nationkey END AS reagent_lot, CASE WHEN c_custkey % 10 = 0 THEN true WHEN c_custkey % 11 = 0 THEN true ELSE c_custkey % 2 = 0 END AS is_pool FROM customer")
def assay_metadata_attach(spark: SparkSession, d: str) -> DataFrame:
    c = T.table(spark, d, "customer")
    k = F.col("c_custkey")
    samples = c.select(k.cast("string").alias("specimen_source_value"), (k % 2 == 0).alias("is_pool"))
    meta = c.select(k.alias("specimenID"), F.when(k % 3 == 0, F.concat(F.lit("lot "), F.col("c_nationkey").cast("string"))).alias("lotNumber"), F.when(k % 10 == 0, "TRUE").alias("isAssayControl"), F.when(k % 11 == 0, "GIS").alias("controlType"), k.alias("src_ordinal"))
    return S.attach_assay_metadata(samples, meta, "specimenID").select("specimen_source_value", "reagent_lot", "is_pool")


_INVENTORY = f"WITH c AS ({O.COHORTS}) SELECT stratum_key, count(DISTINCT specimen_id) AS n_samples, count(DISTINCT feature_key) AS n_features, count(value) AS n_values, array_to_string(list_sort(list(DISTINCT feature_key)), ',') AS features FROM c GROUP BY 1"


def _inventory(spark: SparkSession, d: str) -> DataFrame:
    c = T.cohorts(spark, d)
    return c.groupBy("stratum_key").agg(F.count_distinct("specimen_id").alias("n_samples"), F.count_distinct("feature_key").alias("n_features"), F.count("value").alias("n_values"), F.array_join(F.array_sort(F.collect_set("feature_key")), ",").alias("features"))


@query(_INVENTORY)
def derived_inventory(spark: SparkSession, d: str) -> DataFrame:
    return M.derived_inventory(_inventory(spark, d).withColumn("layer_key", F.lit("cohorts"))).drop("layer_key")


_TRACKED = (("AFRICA", "n_features", "6"), ("ASIA", "n_features", "~7?"), ("EUROPE", "n_features", "6.0"), ("EUROPE", "site", "ECONOMY"), ("AMERICA", "site", "steel"), ("MIDDLE EAST", "n_donors", "12"))


@query(
    f"WITH t AS (SELECT * FROM {_values(_TRACKED)} v(tracking_row, field, tracking_value)), i AS ({_INVENTORY}), x AS (SELECT stratum_key AS tracking_row, 'n_features' AS field, n_features::VARCHAR AS derived_value FROM i UNION ALL SELECT stratum_key, 'site', features FROM i) "
    "SELECT tracking_row, field, tracking_value, derived_value, CASE WHEN derived_value IS NULL THEN NULL WHEN field = 'site' THEN contains(lower(derived_value), lower(tracking_value)) ELSE try_cast(regexp_replace(regexp_replace(tracking_value, '[?~,\\s]', '', 'g'), '\\.0+$', '') AS INTEGER) = try_cast(derived_value AS INTEGER) END AS agrees FROM t LEFT JOIN x USING (tracking_row, field)"
)
def tracking_diff(spark: SparkSession, d: str) -> DataFrame:
    i = _inventory(spark, d)
    derived = i.select(F.col("stratum_key").alias("tracking_row"), F.lit("n_features").alias("field"), F.col("n_features").cast("string").alias("derived_value")).unionByName(
        i.select(F.col("stratum_key").alias("tracking_row"), F.lit("site").alias("field"), F.col("features").alias("derived_value"))
    )
    return M.tracking_diff(spark.createDataFrame(_TRACKED, "tracking_row string, field string, tracking_value string"), derived).drop("note")


@query("SELECT md5(text) AS content_md5, count(*) AS n_copies, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1")
def content_presence(spark: SparkSession, d: str) -> DataFrame:
    t = T.table(spark, d, "documents").where(F.col("text").isNotNull())
    return t.select(F.md5(F.col("text").cast("binary")).alias("content_md5"), "doc_id").groupBy("content_md5").agg(F.count(F.lit(1)).alias("n_copies"), F.min("doc_id").alias("first_doc"))


#: Names that a table keyed by part types and sizes could carry.
_NAMES = "CASE p_size % 7 WHEN 0 THEN lower(p_type) || '.age' WHEN 1 THEN 'Sampling Age ' || p_brand WHEN 2 THEN 'reagent_lot' WHEN 3 THEN p_type || '_pct' WHEN 4 THEN 'Pct Coverage' WHEN 5 THEN 'stage_' || p_type ELSE 'pmi_hours' END"


def _names(spark: SparkSession, d: str) -> DataFrame:
    return T.table(spark, d, "part").groupBy(F.expr(_NAMES).alias("column_name")).agg(F.count(F.lit(1)).alias("n_parts"))


@query(f"WITH v AS (SELECT {_NAMES} AS c, count(*) AS n_parts FROM part GROUP BY 1), w AS (SELECT *, regexp_replace(lower(c), '[^a-z0-9]', '', 'g') AS n FROM v) SELECT c AS column_name, n_parts, n NOT IN ({', '.join(repr(contract.normalized(x)) for x in DENY_EXEMPT)}) AND ({' OR '.join(f'contains(n, {t!r})' for t in DENIED)}) AS denied FROM w")
def scope_gate_report(spark: SparkSession, d: str) -> DataFrame:
    names = _names(spark, d)
    bad = contract.scope_gate([x[0] for x in names.select("column_name").collect()], report_only=True)  # names of columns
    return names.withColumn("denied", F.col("column_name").isin(bad))


@query(f"SELECT {_NAMES} AS column_name, count(*) AS n_parts FROM part GROUP BY 1 HAVING column_name NOT IN ({', '.join(repr(x) for x in sorted({*EXTRA_DECLARED, *LayerSpec('x', measurement_columns=('lod',)).columns()}))})")
def undeclared_columns(spark: SparkSession, d: str) -> DataFrame:
    names = _names(spark, d)
    found = contract.undeclared([x[0] for x in names.select("column_name").collect()], [LayerSpec("x", measurement_columns=("lod",))])  # names of columns
    return names.where(F.col("column_name").isin(found))


def cohort_strata() -> list[Stratum]:
    """Registry entries of the five regions, with a scale whose range they meet or miss."""
    return [Stratum(k, "cohorts", Origin("tables", k, k), Source(("customer",), "parquet"), material=Material(site=k.lower()), scale=Scale("log2_lfq_intensity"), method=Method(pipeline=Stated("tables", "A"))) for k in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")]


def _audit_context(spark: SparkSession, d: str) -> dict:
    c = staged(T.cohorts(spark, d).withColumn("value", F.log2("value")))
    s = T.samples_of(c)
    p = {x["stratum_key"]: x.asDict() for x in stats.percentiles(c, stored=True).collect()}
    sp = {x["stratum_key"]: x.asDict() for x in stats.sparsity(c, s).collect()}
    strata = [{"stratum": st, **{k: p[st.key][k] for k in ("p1", "p50", "p99")}, "pct_missing": sp[st.key]["pct_missing"], "n_features": sp[st.key]["n_features"], "n_nonpool": sp[st.key]["n_samples"], "n_resolved": sp[st.key]["n_samples"]} for st in cohort_strata() if st.key in p]
    return {"strata": strata}


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS has_orders FROM customer")
def membership(spark: SparkSession, d: str) -> DataFrame:
    o = T.table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return lookups.is_member(T.table(spark, d, "customer").select("c_custkey"), o, "c_custkey", "has_orders")


@query(f"WITH c AS ({O.PANEL}) SELECT specimen_id, len(list(value ORDER BY feature_key))::INTEGER AS n, round(list_sum(list(value::FLOAT ORDER BY feature_key))::DOUBLE, 2) AS total, arg_min(round(value::FLOAT::DOUBLE, 4), feature_key) AS first_value FROM c GROUP BY 1")
def packed_matrix(spark: SparkSession, d: str) -> DataFrame:
    m = L.packed_matrix(T.panel(spark, d))
    total = F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x.cast("double")), 2)
    return m.select("specimen_id", F.size("values").alias("n"), total.alias("total"), F.round(F.get("values", F.lit(0)).cast("double"), 4).alias("first_value"))


@query("SELECT n_name AS stratum_key, n_name || ':assay' AS assay_id, 'counting' AS assay_type, r_name AS platform, 'tables' AS study, r_name AS \"grant\", 'desk ' || n_regionkey AS tissue FROM nation JOIN region ON n_regionkey = r_regionkey")
def assay_table(spark: SparkSession, d: str) -> DataFrame:
    """A stratum declared for each nation: declarations are rows of a registry, and on the driver."""
    rows = T.table(spark, d, "nation").join(T.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).collect()
    strata = [Stratum(x["n_name"], "l", Origin("tables", x["r_name"], "c"), Source(("orders.parquet",), "parquet"), material=Material(f"desk {x['n_regionkey']}"), method=Method("counting", platform=Stated(x["r_name"]))) for x in rows]
    return S.assay_table(strata, spark).select("stratum_key", "assay_id", "assay_type", "platform", "study", "grant", "tissue")


_AUDIT = f"""WITH c0 AS ({O.COHORTS}), c AS (SELECT stratum_key, feature_key, specimen_id, log2(value) AS value FROM c0), k AS ({O.KEPT}),
  p AS (SELECT stratum_key, quantile_cont(value, 0.01) AS p1, quantile_cont(value, 0.99) AS p99 FROM c GROUP BY 1),
  m AS (SELECT stratum_key, (1 - sum(n_present) / (count(*) * max(n_samples))) * 100 AS pct FROM k GROUP BY 1),
  a AS (SELECT 'scale_range' AS "check", stratum_key AS subject, CASE WHEN p1 >= 5 AND p99 <= 45 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM p
   UNION ALL SELECT 'anatomic_site', stratum_key, 'UNVERIFIABLE' FROM p UNION ALL SELECT 'person_resolution', stratum_key, 'PASS' FROM p
   UNION ALL SELECT 'cde_analysis_pipeline', stratum_key, 'PASS' FROM p UNION ALL SELECT 'cde_platform', stratum_key, 'UNVERIFIABLE' FROM p
   UNION ALL SELECT 'feature_ids', stratum_key, 'PASS' FROM p UNION ALL SELECT 'sparsity', stratum_key, CASE WHEN pct <= 35 THEN 'PASS' ELSE 'FAIL' END FROM m) """


@query(_AUDIT + 'SELECT "check", subject, verdict FROM a')
def audit_rows(spark: SparkSession, d: str) -> DataFrame:
    return checks.run(spark, _audit_context(spark, d)).select("check", "subject", "verdict")


@query(_AUDIT + "SELECT count(*) AS n_checks, count(*) FILTER (verdict = 'PASS') AS n_pass, count(*) FILTER (verdict = 'FAIL') AS n_fail, count(*) FILTER (verdict = 'UNVERIFIABLE') AS n_unverifiable FROM a")
def audit_summary(spark: SparkSession, d: str) -> DataFrame:
    return checks.summarise(checks.run(spark, _audit_context(spark, d)))


_DENIED_SQL = "(" + " OR ".join(f"n LIKE '%{x}%'" for x in DENIED) + ") AND n NOT IN (" + ", ".join(f"'{contract.normalized(x)}'" for x in DENY_EXEMPT) + ")"


@query(
    "SELECT regexp_extract(url, '://([^/]+)', 1) AS host, count(*) AS n_pages, sum(length(html))::BIGINT AS n_chars, "
    f"(SELECT string_agg(column_name, ',' ORDER BY column_name) FROM (SELECT column_name, regexp_replace(lower(column_name), '[^a-z0-9]', '', 'g') AS n FROM information_schema.columns WHERE table_name = 'pages') WHERE {_DENIED_SQL}) AS refused FROM pages GROUP BY 1"
)
def plan_scope_guard(spark: SparkSession, d: str) -> DataFrame:
    """Pages by host: the plan that reads the denied column is refused unread, the plan that prunes it runs."""
    pages = T.table(spark, d, "pages")
    by_host = lambda df: df.groupBy(F.regexp_extract("url", "://([^/]+)", 1).alias("host"))
    try:
        contract.guarded(by_host(pages).agg(F.max("page_id").alias("last")))
        refused = ""
    except contract.ScopeError:
        refused = ",".join(sorted(contract.denied(pages.columns)))
    allowed = contract.guarded(by_host(pages).agg(F.count(F.lit(1)).alias("n_pages"), F.sum(F.length("html")).cast("bigint").alias("n_chars")))
    return allowed.withColumn("refused", F.lit(refused))


@query(
    f"WITH c AS ({O.MIXED.format(feature='p_brand')}), n AS (SELECT stratum_key, count(DISTINCT feature_key) AS n FROM c GROUP BY 1), s AS (SELECT stratum_key, specimen_id, count(value) AS d, count(value) / any_value(n) AS rate FROM c JOIN n USING (stratum_key) GROUP BY 1, 2) "
    "SELECT count(*) AS n_dropped, array_to_string(list(d ORDER BY d)[1:5], ',') AS lowest FROM s WHERE rate < 0.5"
)
def lowest_five_samples(spark: SparkSession, d: str) -> DataFrame:
    """How many of all samples are incomplete, and the five lowest counts among them."""
    out = R.dropped_samples(stats.complete_samples(T.mixed_scales(spark, d, "p_brand"), 0.5))
    return out.select("n_dropped", F.array_join(F.transform("lowest_counts", lambda x: x.cast("string")), ",").alias("lowest"))
