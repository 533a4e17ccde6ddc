"""Queries on readers and sinks: a table is written in a source format, read back, and compared by SQL.

Files go to the folder that driver and executors share; every query writes whole tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.model import Method, Origin, Source, Stated, Stratum
from strataloom.operators import layer as L
from strataloom.operators import samples as S
from strataloom.plans import oracles as O
from strataloom.plans.matrix_queries import r
from strataloom.sinks import writers as Wr
from strataloom.sources import annotations as A
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


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{Wr.shared_folder(spark)}/strataloom-files-{uuid.uuid4().hex}/{name}"


def _delimited(df: DataFrame, name: str, sep: str = ",") -> str:
    """Writes a table as gzipped delimited text with headers; its path."""
    path = _scratch(df.sparkSession, name)
    df.write.option("header", True).option("sep", sep).option("compression", "gzip").option("escape", '"').csv(path)
    return path


def _sheet(spark: SparkSession, name: str, rows: list[list]) -> str:
    path = _scratch(spark, name)
    Wr.write_sheet(spark, path, rows)
    return path


def _read(spark: SparkSession, reader: str, path, **options):
    files = (path,) if isinstance(path, str) else tuple(path)
    return R.read_stratum(spark, Stratum("s", "l", Origin("tables", "g", "c"), Source(files, reader, options=options)))


def _annotated(spark: SparkSession, reader: str, path: str, samples: DataFrame | None = None, **options) -> DataFrame:
    st = Stratum("s", "l", source=Source(annotation=path, annotation_reader=reader, options=options))
    return A.ANNOTATION_READERS[reader](spark, st, samples).drop("src_ordinal")


def _long(f) -> DataFrame:
    return f.cells.select(F.col("feature_source_value").alias("feature"), F.col("specimen_source_value").alias("specimen"), r("value"))


def _text(c: str):
    return F.col(c).cast("string")


# --- matrix formats --------------------------------------------------------------------------------


@query(
    "WITH c AS (SELECT n_name, 'b_' || c_mktsegment AS seg, sum(c_acctbal) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL), s AS (SELECT DISTINCT 'b_' || c_mktsegment AS seg FROM customer) "
    "SELECT n.n_name || '|' || n.n_nationkey AS feature, s.seg AS specimen, round(c.v, 6) AS value FROM nation n CROSS JOIN s LEFT JOIN c ON c.n_name = n.n_name AND c.seg = s.seg"
)
def read_csv_matrix(spark: SparkSession, d: str) -> DataFrame:
    c = T.table(spark, d, "customer").withColumn("seg", F.concat(F.lit("b_"), "c_mktsegment"))
    segments = sorted(x[0] for x in c.select("seg").distinct().collect())  # columns of the format
    w = c.groupBy("c_nationkey").pivot("seg", segments).agg(F.sum("c_acctbal"))
    w = T.table(spark, d, "nation").join(w, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    path = _delimited(w.select(F.concat_ws("|", "n_name", "n_nationkey").alias("id"), *segments), "matrix")
    return _long(_read(spark, "csv_matrix", path))


@query(
    "SELECT coalesce(CASE WHEN p_size % 5 <> 0 THEN 'M' || p_partkey END, 'P' || p_partkey) AS feature, s.n AS specimen, round(CASE WHEN s.v > 0 THEN log2(s.v) END, 6) AS value, s.b AS batch, s.p AS is_pool "
    "FROM part, LATERAL (VALUES ('b01_price', p_retailprice, 'b01', false), ('GIS_size', (p_size - 10)::DOUBLE, 'GIS', true)) s(n, v, b, p) WHERE p_size > 3"
)
def read_maxquant(spark: SparkSession, d: str) -> DataFrame:
    """Decoys go, intensities that are not positive become null, names make pools and batches."""
    p, key = T.table(spark, d, "part"), _text("p_partkey")
    mark = lambda n: F.when(F.col("p_size") == n, "+")
    w = p.select(
        F.concat(F.lit("P"), key).alias("Protein IDs"), F.when(F.col("p_size") % 5 != 0, F.concat(F.lit("M"), key)).alias("Majority protein IDs"), mark(1).alias("Reverse"), mark(2).alias("Potential contaminant"),
        mark(3).alias("Only identified by site"), F.col("p_retailprice").alias("LFQ intensity b01_price"), (F.col("p_size") - 10).alias("LFQ intensity GIS_size"), F.lit(7).alias("Intensity other"),
    )
    f = _read(spark, "maxquant", _delimited(w, "groups", "\t"))
    names = f.samples.select(F.col("specimen_source_value").alias("specimen"), "batch", "is_pool")
    return _long(f).join(F.broadcast(names), "specimen").select("feature", "specimen", "value", "batch", "is_pool")


@query(
    "WITH v AS (SELECT p_partkey, p_brand || '|A' || p_partkey AS feature, log2(p_retailprice / 100) AS a, log2(p_size / 7) AS b, log2(p_retailprice / (p_size + 1)) AS c FROM part), "
    "m AS (SELECT *, ((a + b) / 2 + c) / 2 AS centre FROM v) SELECT feature, s.n AS specimen, round(s.v - centre, 5) + 0.0 AS value FROM m, LATERAL (VALUES ('F1.127N', a), ('F1.128C', b), ('F2.127N', c)) s(n, v)"
)
def read_pd_ratio(spark: SparkSession, d: str) -> DataFrame:
    """Ratios to the reference channel, centred on the median of per-plex medians."""
    p = T.table(spark, d, "part")
    size = F.col("p_size")
    w = p.select(
        F.concat(F.lit("A"), _text("p_partkey")).alias("Accession"), F.col("p_brand").alias("Gene Symbol"), (F.col("p_retailprice") / 100).alias("Abundance Ratio: (F1, 127N) / (F1, 126)"), (size / 7).alias("Abundance Ratio: (F1, 128C) / (F1, 126)"),
        (F.col("p_retailprice") / (size + 1)).alias("Abundance Ratio: (F2, 127N) / (F2, 126)"), F.lit(1).alias("Abundance Ratio: (F1, 127N) / (F2, 126)"),
    )
    f = _read(spark, "pd_ratio", _delimited(w, "ratios", "\t"))
    return f.cells.select(F.col("feature_source_value").alias("feature"), F.col("specimen_source_value").alias("specimen"), (F.round("value", 5) + 0.0).alias("value"))


@query(
    "SELECT f.n AS feature, 'w' || c_custkey AS specimen, round(f.v, 6) AS value, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_custkey::VARCHAR END AS person, c_mktsegment IN ('MACHINERY', 'BUILDING') AS is_pool, c_nationkey::VARCHAR AS plate_id, "
    "f.p AS peptide FROM customer, LATERAL (VALUES ('BAL_1', c_acctbal, 'PEPTIDE BAL_1'), ('tau_N', c_nationkey::DOUBLE, NULL)) f(n, v, p)"
)
def read_srm(spark: SparkSession, d: str) -> DataFrame:
    """Samples in rows; control wells from two columns, donors by number only, peptides by feature."""
    c = T.table(spark, d, "customer")
    segment = F.col("c_mktsegment")
    w = c.select(
        F.concat(F.lit("w"), _text("c_custkey")).alias("sample_id"), _text("c_nationkey").alias("plate"), F.when(segment == "MACHINERY", "control").otherwise(F.concat(_text("c_custkey"), F.lit(".0"))).alias("subject.id"),
        F.when(segment == "BUILDING", "TRUE").otherwise("false").alias("isControl"), F.when(segment == "MACHINERY", "pool").otherwise("subjects").alias("sample.type"), F.col("c_acctbal").alias("BAL_1"), F.col("c_nationkey").alias("tau_N"),
    )
    peptides = spark.createDataFrame([("BAL_1", "PEPTIDE BAL_1", "x"), ("other", "PEPTIDE", "y")], "`Peptide.Name` string, `Peptide.Sequence` string, note string")
    f = _read(spark, "srm", _delimited(w, "wells", "\t"), feature_meta=_delimited(peptides, "peptides", "\t"))
    who = f.samples.select(F.col("specimen_source_value").alias("specimen"), F.col("person_source_value").alias("person"), "is_pool", "plate_id")
    what = f.features.select(F.col("feature_source_value").alias("feature"), F.col("peptide_sequence").alias("peptide"))
    return _long(f).join(who, "specimen").join(F.broadcast(what), "feature").select("feature", "specimen", "value", "person", "is_pool", "plate_id", "peptide")


@query(
    "WITH c AS (SELECT c_mktsegment, c_nationkey, avg(c_acctbal) AS v FROM customer GROUP BY ALL), s AS (SELECT DISTINCT c_mktsegment FROM customer) "
    "SELECT 'q' || n_nationkey AS feature, s.c_mktsegment AS specimen, round(c.v, 6) AS value, 'Q' || n_nationkey AS accession, CASE WHEN n_regionkey = 1 THEN 'FLAG' ELSE 'PASS' END AS colcheck "
    "FROM nation CROSS JOIN s LEFT JOIN c ON c.c_nationkey = n_nationkey AND c.c_mktsegment = s.c_mktsegment WHERE n_regionkey <> 0 AND n_name <> 'NATION_7'"
)
def read_somascan(spark: SparkSession, d: str) -> DataFrame:
    """Aptamers by SeqId with their first metadata row; only human proteins stay."""
    n = T.table(spark, d, "nation")
    keys = [x[0] for x in n.select("n_nationkey").orderBy("n_nationkey").collect()]  # columns of the format
    w = T.table(spark, d, "customer").groupBy("c_mktsegment").pivot("c_nationkey", keys).agg(F.avg("c_acctbal"))
    w = w.select("c_mktsegment", *[F.col(f"`{k}`").alias(f"q{k}") for k in keys])
    meta = n.select(
        F.concat(F.lit("q"), _text("n_nationkey")).alias("SeqId"), F.concat(F.lit("Q"), _text("n_nationkey")).alias("UniProt"), F.col("n_name").alias("EntrezGeneSymbol"), F.lit("20").alias("Dilution"),
        F.when(F.col("n_regionkey") == 0, "Mouse").otherwise(" Human ").alias("Organism"), F.when(F.col("n_name") == "NATION_7", "Spuriomer").otherwise("Protein").alias("Type"), F.when(F.col("n_regionkey") == 1, "FLAG").otherwise("PASS").alias("ColCheck"),
    )
    twice = meta.unionByName(meta.withColumn("UniProt", F.lit("second")))
    one_file = _delimited(twice.coalesce(1), "aptamers")
    f = _read(spark, "somascan", _delimited(w, "visits"), feature_meta=one_file)
    what = f.features.select(F.col("feature_source_value").alias("feature"), F.col("uniprot_raw").alias("accession"), "colcheck")
    return _long(f).join(F.broadcast(what), "feature").select("feature", "specimen", "value", "accession", "colcheck")


_K = "try_cast(json_extract_string(props, '$.k') AS INTEGER)"


@query(
    f"WITH e AS (SELECT event_type AS feature, user_id::VARCHAR AS specimen, value, {_K} AS k FROM events) SELECT feature, specimen, round(avg(value), 6) AS value, round(avg(k), 6) AS lod, "
    "count(value) FILTER (value < k) AS n_below FROM e GROUP BY ALL"
)
def read_olink(spark: SparkSession, d: str) -> DataFrame:
    """Panel rows to cells: values and limits are averaged by feature and sample in one aggregate."""
    e = T.table(spark, d, "events")
    w = e.select(
        F.col("event_type").alias("UniProt"), _text("user_id").alias("sample_id"), _text("user_id").alias("participant_id"), F.col("value").alias("NPX"), F.get_json_object("props", "$.k").alias("LOD"), F.lit("plate 1").alias("PlateID"),
        F.lit("lot").alias("Panel_Lot_Nr"), F.lit("PASS").alias("QC_Warning"), F.lit("PASS").alias("Distribution_QC"), F.lit("PASS").alias("Outliers_QC"), F.lit("12").alias("visit_month"),
    )
    f = _read(spark, "olink", _delimited(w, "panel"), panels=["one"])
    below = e.select(F.col("event_type").alias("feature"), _text("user_id").alias("specimen"), (F.col("value") < F.get_json_object("props", "$.k").try_cast("int")).alias("b")).groupBy("feature", "specimen").agg(F.count_if("b").alias("n_below"))
    cells = f.cells.select(F.col("feature_source_value").alias("feature"), F.col("specimen_source_value").alias("specimen"), r("value"), r("lod"))
    return cells.join(below, ["feature", "specimen"])


_PANEL_ROWS = f"SELECT *, {_K} AS k, event_type || '.' || (event_id % 4) AS feature, 'panel ' || (event_id % 4) AS panel FROM events WHERE user_id % 8 > 1"


def _four_panels(spark: SparkSession, d: str):
    """Four panel files with plates (two of them withdrawn), limits, quality flags and missingness from the events."""
    e = T.table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").try_cast("int"))
    k, paths = F.col("k"), []
    for i in range(4):
        w = e.where(F.col("event_id") % 4 == i).select(
            F.concat("event_type", F.lit(f".{i}")).alias("UniProt"), _text("user_id").alias("sample_id"), _text("user_id").alias("participant_id"), F.col("value").alias("NPX"), k.alias("LOD"), F.concat(F.lit("P"), (F.col("user_id") % 8).cast("string")).alias("PlateID"),
            F.lit(f"lot {i}").alias("Panel_Lot_Nr"), F.when(k < 2, "WARN").otherwise("PASS").alias("QC_Warning"), F.when(k.between(2, 3), "FAIL").when(k.between(4, 50), "pass").alias("Distribution_QC"), F.when(k >= 97, "WARN").otherwise("PASS").alias("Outliers_QC"),
            (F.col("user_id") % 5 * 12).alias("visit_month"), (k / 128).alias("MissingFreq"),
        )
        paths.append(_delimited(w, f"panel{i}"))
    return _read(spark, "olink", paths, panels=[f"panel {i}" for i in range(4)], withdrawn_plates=["P0", "P1"])


@query(f"SELECT feature, panel, 'lot ' || right(panel, 1) AS lot, max(k / 128) AS missing_freq FROM ({_PANEL_ROWS}) GROUP BY ALL")
def read_olink_features(spark: SparkSession, d: str) -> DataFrame:
    """Features of four panels: the first panel and lot, the largest stated missingness."""
    f = _four_panels(spark, d).features
    return f.select(F.col("feature_source_value").alias("feature"), "panel", F.col("panel_lot_nr").alias("lot"), "missing_freq")


@query(
    f"WITH w AS (SELECT user_id, coalesce(bool_or(k < 2), false) AS a, coalesce(bool_or(k BETWEEN 2 AND 3), false) AS b, coalesce(bool_or(k >= 97), false) AS c FROM ({_PANEL_ROWS}) GROUP BY 1) "
    "SELECT user_id::VARCHAR AS specimen, 'P' || (user_id % 8) AS plate_id, (user_id % 5 * 12)::INTEGER AS visit_month, CASE WHEN a OR b OR c THEN 'WARN' ELSE 'PASS' END AS qc_status, a::INTEGER + b::INTEGER + c::INTEGER AS qc_warn_count FROM w"
)
def read_olink_sample_qc(spark: SparkSession, d: str) -> DataFrame:
    """Samples of the plates that were not withdrawn, with the worst of each flag over four panels."""
    s = _four_panels(spark, d).samples
    return s.select(F.col("specimen_source_value").alias("specimen"), "plate_id", "visit_month", "qc_status", "qc_warn_count")


@query(
    "WITH m AS (SELECT event_type AS f, user_id::VARCHAR AS s, avg(value) AS v FROM events GROUP BY ALL), n AS (SELECT count(DISTINCT f) AS n FROM m), k AS (SELECT s, count(v) AS d, count(v) / max(n) AS rate FROM m, n GROUP BY 1 HAVING count(v) / max(n) >= 0.8) "
    "SELECT f AS feature, s AS specimen, round(CASE WHEN v > 0 THEN log2(v) END, 6) AS value, d::INTEGER AS n_detected, round(rate, 6) AS detection_rate FROM m JOIN k USING (s)"
)
def read_dia(spark: SparkSession, d: str) -> DataFrame:
    """The long form: samples that detect under four fifths of the features go."""
    e = T.table(spark, d, "events")
    w = e.select(F.col("event_type").alias("UniProt"), _text("user_id").alias("sample_id"), _text("user_id").alias("participant_id"), F.lit("0").alias("visit_month"), F.col("value").alias("protein_abundance"))
    f = _read(spark, "dia", _delimited(w, "reports"), min_sample_completeness=0.8)
    who = f.samples.select(F.col("specimen_source_value").alias("specimen"), "n_detected", r("detection_rate"))
    return _long(f).join(who, "specimen").select("feature", "specimen", "value", "n_detected", "detection_rate")


@query("SELECT n_name || '|sp|N' || n_nationkey || '|X_HUMAN' AS feature, s.n AS specimen, round(CASE WHEN s.v > 0 THEN log2(s.v) END, 6) AS value FROM nation, LATERAL (VALUES ('nation', n_nationkey::DOUBLE), ('region', n_regionkey - 1.0)) s(n, v)")
def read_reporter_xlsx(spark: SparkSession, d: str) -> DataFrame:
    rows = T.table(spark, d, "nation").orderBy("n_nationkey").collect()  # one sheet of 25 rows
    head = [["Reporter export"], [], ["made by", "query"], ["x"], [None, "Gene", "Accession", None, "nation", "region"]]
    body = [[i, x["n_name"], f"sp|N{x['n_nationkey']}|X_HUMAN", None, x["n_nationkey"], x["n_regionkey"] - 1] for i, x in enumerate(rows)]
    return _long(_read(spark, "reporter_xlsx", _sheet(spark, "reporter.xlsx", [*head, *body, [99, None, None, None, 5, 5]])))


# --- annotation ------------------------------------------------------------------------------------


@query(
    "SELECT n_name AS specimen_source_value, CASE WHEN n_regionkey <> 0 THEN 'I' || n_nationkey ELSE CASE WHEN n_nationkey <> 0 THEN 'P' || n_nationkey END END AS person_source_value, "
    "CASE WHEN n_regionkey <> 0 THEN 'individualID' WHEN n_nationkey <> 0 THEN 'projid' END AS person_source_namespace_row, 'b' || n_regionkey AS batch, n_regionkey = 0 AND n_nationkey = 0 AS is_pool FROM nation"
)
def read_dc_traits(spark: SparkSession, d: str) -> DataFrame:
    rows = T.table(spark, d, "nation").collect()
    body = [[x["n_name"], f"I{x['n_nationkey']}" if x["n_regionkey"] else "NA", f"P{x['n_nationkey']}" if x["n_nationkey"] else "GIS", f"b{x['n_regionkey']}", "127"] for x in rows]
    a = _annotated(spark, "dc_traits", _sheet(spark, "traits.xlsx", [["ID", "individualID", "projID", "Batch", "Channel"], *body]))
    return a.select("specimen_source_value", "person_source_value", "person_source_namespace_row", "batch", "is_pool")


@query("SELECT 'F' || n_regionkey || '.' || n_nationkey || 'N' AS specimen_source_value, CASE WHEN n_name <> 'NATION_3' THEN n_name END AS person_source_value, 'plex' || n_regionkey AS batch, n_nationkey || 'N' AS channel, n_name = 'NATION_3' AS is_pool FROM nation")
def read_labelling_sheet(spark: SparkSession, d: str) -> DataFrame:
    rows = T.table(spark, d, "nation").collect()
    body = [[str(x["n_regionkey"]), f"{x['n_nationkey']}_N", "gis" if x["n_name"] == "NATION_3" else x["n_name"], "lot"] for x in rows]
    a = _annotated(spark, "labelling_sheet", _sheet(spark, "labels.xlsx", [["Plex", "Channel", "ProjID", "Lot #"], *body]))
    return a.select("specimen_source_value", "person_source_value", "batch", "channel", "is_pool")


@query(
    "SELECT c_name AS specimen_source_value, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_custkey::VARCHAR END AS person_source_value, c_nationkey::VARCHAR AS batch, '127N' AS channel, "
    "c_mktsegment IN ('FURNITURE', 'BUILDING') AS is_pool FROM customer"
)
def read_specimen_table(spark: SparkSession, d: str) -> DataFrame:
    c = T.table(spark, d, "customer")
    segment = F.col("c_mktsegment")
    w = c.select(F.col("c_name").alias("SampleID"), F.when(segment == "FURNITURE", "NA").otherwise(_text("c_custkey")).alias("projid"), F.col("c_nationkey").alias("Batch"), F.lit("b1.127N").alias("batch.channel"), F.when(segment == "BUILDING", "GIS 1").otherwise(F.col("c_name")).alias("SpecimenID"), F.lit("77").alias("age_at_visit"))
    return _annotated(spark, "specimen_table", _delimited(w, "specimens")).select("specimen_source_value", "person_source_value", "batch", "channel", "is_pool")


@query("SELECT o_orderkey::VARCHAR AS specimen_source_value, o_custkey::VARCHAR AS person_source_value, month(o_orderdate)::INTEGER AS visit_index, (month(o_orderdate) * 12)::INTEGER AS visit_month, o_orderstatus AS source_dataset FROM orders")
def read_somascan_samples(spark: SparkSession, d: str) -> DataFrame:
    o = T.table(spark, d, "orders")
    w = o.select(F.col("o_orderkey").alias("projid_visit"), F.col("o_custkey").alias("projid"), F.month("o_orderdate").alias("Visit"), F.concat(F.lit(" "), "o_orderstatus", F.lit(" ")).alias("study"), F.lit("F").alias("msex"))
    return _annotated(spark, "somascan_samples", _delimited(w, "visits")).select("specimen_source_value", "person_source_value", "visit_index", "visit_month", "source_dataset")


@query("SELECT o_custkey::VARCHAR AS specimen_source_value, 'p' || o_custkey AS person_source_value, min(o_orderkey)::INTEGER AS visit_month, 'source' AS visit_month_evidence FROM orders GROUP BY o_custkey")
def read_olink_samples(spark: SparkSession, d: str) -> DataFrame:
    """The first row of each sample counts, in the order of the files and of their rows."""
    o = T.table(spark, d, "orders")
    w = o.select(_text("o_custkey").alias("sample_id"), F.concat(F.lit("p"), _text("o_custkey")).alias("participant_id"), F.col("o_orderkey").alias("visit_month")).orderBy("visit_month")
    return _annotated(spark, "olink_samples", _delimited(w, "samples")).select("specimen_source_value", "person_source_value", "visit_month", "visit_month_evidence")


_AREAS = (
    "WITH own AS (SELECT c_name AS specimen, c_custkey % 400 AS donor, c_mktsegment AS site, CASE WHEN c_nationkey < 3 THEN 'BA' || c_nationkey END AS area FROM customer), "
    "other AS (SELECT donor, site, arg_min(area, k) AS area FROM (SELECT s_suppkey AS donor, ['BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD', 'FURNITURE'][s_nationkey % 5 + 1] AS site, 'BA' || s_nationkey AS area, s_suppkey AS k FROM supplier WHERE s_acctbal > 0) GROUP BY ALL) "
)


@query(
    _AREAS + "SELECT specimen, site, coalesce(own.area, other.area) AS brodmann_area, CASE WHEN own.area IS NOT NULL THEN 'source' WHEN other.area IS NOT NULL THEN 'propagated' END AS evidence FROM own LEFT JOIN other USING (donor, site)"
)
def read_biospecimen_areas(spark: SparkSession, d: str) -> DataFrame:
    """Sites of the assay's own specimens, and areas that other assays state for the same donor and tissue."""
    c, s = T.table(spark, d, "customer"), T.table(spark, d, "supplier")
    sites = F.array(*[F.lit(x) for x in ("BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE")])
    own = c.select(F.lit(0).alias("k"), (F.col("c_custkey") % 400).cast("string").alias("individualID"), F.col("c_name").alias("specimenID"), F.col("c_mktsegment").alias("tissue"), F.when(F.col("c_nationkey") < 3, F.concat(F.lit("BA"), _text("c_nationkey"))).alias("BrodmannArea"), F.lit("TMT quantitation").alias("assay"))
    others = s.select(F.col("s_suppkey").alias("k"), _text("s_suppkey").alias("individualID"), F.col("s_name").alias("specimenID"), F.get(sites, F.col("s_nationkey") % 5).alias("tissue"), F.when(F.col("s_acctbal") > 0, F.concat(F.lit("BA"), _text("s_nationkey"))).alias("BrodmannArea"), F.lit("rnaSeq").alias("assay"))
    path = _delimited(own.unionByName(others).withColumn("samplingAge", F.lit("90+")).orderBy("k"), "biospecimens")
    direct, rest = A.biospecimen_sites(spark, path, "TMT quantitation")
    filled = S.brodmann_fill(direct, None, rest, ("_donor", "anatomic_site_source"))
    return filled.select(F.col("specimen_source_value").alias("specimen"), F.col("anatomic_site_source").alias("site"), "brodmann_area", F.col("brodmann_area_evidence").alias("evidence"))


@query(
    "SELECT c_name AS specimen_source_value, 'I' || c_custkey AS person_source_value, c_mktsegment AS anatomic_site_source, CASE WHEN c_acctbal < 0 THEN 'EXCLUDED_BY_SOURCE' ELSE 'not_assessed' END AS qc_status, CASE WHEN c_acctbal < 0 THEN 'balance' END AS exclude_reason FROM customer"
)
def read_biospecimen(spark: SparkSession, d: str) -> DataFrame:
    """The portal's table by the matrix' own labels; exclusions flag, never drop."""
    c = T.table(spark, d, "customer")
    out = F.col("c_acctbal") < 0
    w = c.select(F.concat(F.lit("I"), _text("c_custkey")).alias("individualID"), F.col("c_name").alias("specimenID"), F.col("c_mktsegment").alias("tissue"), F.when(out, "TRUE").otherwise("FALSE").alias("exclude"), F.when(out, "balance").alias("excludeReason"), F.lit("x").alias("assay"), F.lit("80").alias("samplingAge"))
    samples = c.select(F.col("c_name").alias("specimen_source_value"), F.col("c_custkey").alias("src_ordinal"))
    return _annotated(spark, "biospecimen", _delimited(w, "biospecimens"), samples).select("specimen_source_value", "person_source_value", "anatomic_site_source", "qc_status", "exclude_reason")


@query("SELECT DISTINCT c_custkey::VARCHAR AS projid, c_name AS individual_id, c_mktsegment AS study FROM customer WHERE c_acctbal >= 0")
def read_crosswalk(spark: SparkSession, d: str) -> DataFrame:
    c = T.table(spark, d, "customer")
    w = c.select(_text("c_custkey").alias("projid"), F.when(F.col("c_acctbal") >= 0, F.concat(F.lit(" "), "c_name")).alias("individualID"), F.col("c_mktsegment").alias("Study"), F.lit("1").alias("apoe_genotype"))
    return A.crosswalk(spark, _delimited(w.unionByName(w), "bridge"))


@query("SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal >= 0")
def crosswalk_donors(spark: SparkSession, d: str) -> DataFrame:
    """Orders meet the bridge as it is read from its file; donors that it lacks stay out."""
    c = T.table(spark, d, "customer")
    bridge = A.crosswalk(spark, _delimited(c.select(_text("c_custkey").alias("projid"), F.when(F.col("c_acctbal") >= 0, F.col("c_name")).alias("individualID"), F.lit("s").alias("Study")), "bridge"))
    o = T.table(spark, d, "orders").select("o_orderkey", _text("o_custkey").alias("projid"))
    return o.join(bridge, "projid").select("o_orderkey", F.col("individual_id").alias("c_name"))


@query("SELECT 'P' || lpad(p_partkey::VARCHAR, 5, '0') AS uniprot, p_brand AS symbol FROM part")
def read_symbol_reference(spark: SparkSession, d: str) -> DataFrame:
    p = T.table(spark, d, "part")
    key = F.concat(F.lit("P"), F.lpad(_text("p_partkey"), 5, "0"))
    return A.symbol_reference(spark, _delimited(p.select(key.alias("uniprot"), F.col("p_brand").alias("symbol")), "symbols")).select("uniprot", "symbol")


@query("SELECT c_custkey::VARCHAR AS person_source_value, round(c_acctbal / 60, 6) AS pmi_hours FROM customer")
def read_interval(spark: SparkSession, d: str) -> DataFrame:
    """An interval file in minutes, looked up by donor and converted."""
    c = T.table(spark, d, "customer")
    path = _delimited(c.select(F.concat(_text("c_custkey"), F.lit(".0")).alias("projid"), F.col("c_acctbal").alias("pmi"), F.lit("1").alias("educ")), "intervals")
    samples = c.select(_text("c_custkey").alias("person_source_value"))
    return S.attach_interval(samples, A.interval_lookup(spark, path, "projid", "pmi"), "minutes")[0].select("person_source_value", r("pmi_hours"))


# --- files -----------------------------------------------------------------------------------------


@query("SELECT 'csv' AS file_format, (SELECT count(*) FROM region) AS n_rows, 2 AS n_cols, ',' AS delimiter UNION ALL SELECT 'tsv', (SELECT count(*) FROM nation), 3, chr(9) UNION ALL SELECT 'csv.gz', (SELECT count(*) FROM supplier), 4, ','")
def file_manifest(spark: SparkSession, d: str) -> DataFrame:
    root = _scratch(spark, "tree")
    for name, sep, ext in (("region", ",", "csv"), ("nation", "\t", "tsv"), ("supplier", ",", "csv.gz")):
        w = T.table(spark, d, name).coalesce(1).write.option("header", True).option("sep", sep).option("extension", ext.split(".")[0])
        (w.option("compression", "gzip") if ext.endswith("gz") else w).csv(f"{root}/{name}")
    m = M.file_manifest(spark, root).where("file_format in ('csv', 'tsv', 'csv.gz')")
    return m.select("file_format", F.col("n_rows").cast("bigint").alias("n_rows"), "n_cols", "delimiter")


@query("SELECT md5(string_agg(n_nationkey || ',' || n_name || chr(10), '' ORDER BY n_nationkey)) AS content_md5, 2::BIGINT AS n_copies FROM nation UNION ALL SELECT md5(string_agg(r_name || chr(10), '' ORDER BY r_regionkey)), 1 FROM region")
def content_index(spark: SparkSession, d: str) -> DataFrame:
    """Files by decompressed content: a plain and a gzipped copy of one table are one content."""
    root = _scratch(spark, "tree")
    n = T.table(spark, d, "nation").orderBy("n_nationkey").select("n_nationkey", "n_name").coalesce(1)
    n.write.csv(f"{root}/a")
    n.write.option("compression", "gzip").csv(f"{root}/b")
    T.table(spark, d, "region").orderBy("r_regionkey").select("r_name").coalesce(1).write.csv(f"{root}/c")
    index = M.content_index(spark, root)
    data = F.filter("paths", lambda p: p.contains("part-") & ~p.contains(".crc"))
    return index.select("content_md5", F.size(data).cast("bigint").alias("n_copies")).where("n_copies > 0")


# --- sinks -----------------------------------------------------------------------------------------


@query(f"WITH c AS ({O.TWO_RUNS}) SELECT stratum_key, feature_key, specimen_id, round(value::FLOAT::DOUBLE, 4) AS value FROM c")
def write_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of a layer as written and read back: floats, typed nulls."""
    path = _scratch(spark, "layer")
    Wr.write_cells(T.two_runs(spark, d).withColumn("lod", F.lit(None).cast("double")), path, "runs")
    back = spark.read.parquet(f"{path}/cells/layer_key=runs")
    assert dict(back.dtypes)["value"] == dict(back.dtypes)["lod"] == "float"
    return back.where("lod is null").select("stratum_key", "feature_key", "specimen_id", F.round(F.col("value").cast("double"), 4).alias("value"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 2::BIGINT AS forms FROM customer")
def emit_table(spark: SparkSession, d: str) -> DataFrame:
    """A table as Parquet and as text; rows that both forms hold alike."""
    c, path = T.table(spark, d, "customer"), _scratch(spark, "customer")
    Wr.emit(c, path)
    text = spark.read.schema(c.schema).option("sep", "\t").option("header", True).csv(f"{path}.tsv")
    return spark.read.parquet(f"{path}.parquet").unionByName(text).groupBy(*c.columns).agg(F.count(F.lit(1)).alias("forms"))


@query("SELECT c_nationkey::VARCHAR AS feature_key, c_mktsegment AS specimen, round(avg(c_acctbal), 4) AS value FROM customer GROUP BY ALL")
def write_bundle(spark: SparkSession, d: str) -> DataFrame:
    """A wide bundle read back to long: matrix, samples and features agree."""
    cells = T.table(spark, d, "customer").groupBy(F.lit("s").alias("stratum_key"), _text("c_nationkey").alias("feature_key"), F.col("c_mktsegment").alias("specimen_id")).agg(F.avg("c_acctbal").alias("value"))
    samples = cells.select("specimen_id").distinct().select("specimen_id", F.concat(F.lit("k|"), "specimen_id").alias("row_key"), F.col("specimen_id").alias("sample_ordinal"))
    path = _scratch(spark, "bundle")
    info = Wr.write_bundle(cells, samples, cells.select("feature_key").distinct(), path, False)
    assert info["column_basis"] == "specimen_id" and spark.read.parquet(f"{path}/samples.parquet").count() == info["n_specimens"]
    long = L.unpivot(spark.read.parquet(f"{path}/matrix.parquet"), ["feature_key"], "specimen").where("value is not null")
    return long.join(spark.read.parquet(f"{path}/features.parquet"), "feature_key").select("feature_key", "specimen", r("value", 4))


@query(
    "WITH s AS (SELECT r_name AS \"grant\", 'people' AS layer_key, c_name AS specimen_id FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), "
    "w AS (SELECT CASE WHEN \"grant\" = 'ASIA' THEN 'EUROPE' ELSE \"grant\" END AS \"grant\", specimen_id, \"grant\" AS truth FROM s) "
    "SELECT \"grant\", count(*) AS n_specimens, count(*) FILTER (\"grant\" <> truth) AS n_foreign FROM w GROUP BY 1"
)
def returns_with_foreign_rows(spark: SparkSession, d: str) -> DataFrame:
    """Returns are counted on what is read back: rows put into another grant's return are found."""
    c = T.table(spark, d, "customer").join(T.table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(T.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    truth = c.select(F.col("r_name").alias("grant"), F.lit("people").alias("layer_key"), F.col("c_name").alias("specimen_id"), F.lit("tissue").alias("tissue"))
    path = _scratch(spark, "returns")
    Wr.write_returns(truth.withColumn("grant", F.when(F.col("grant") == "ASIA", "EUROPE").otherwise(F.col("grant"))), path)
    return Wr.return_boundary(spark.read.parquet(path), truth).select("grant", "n_specimens", "n_foreign")


@query("SELECT r_name AS layer_key, CASE WHEN count(n_nationkey) > 4 THEN 'built' ELSE 'deferred' END AS status, count(n_nationkey) AS n_features FROM region LEFT JOIN nation ON n_regionkey = r_regionkey GROUP BY 1")
def write_layers_and_inventory(spark: SparkSession, d: str) -> DataFrame:
    """The list of layers, deferred ones with them, and an inventory table, read back."""
    g = T.table(spark, d, "region").join(T.table(spark, d, "nation"), F.col("n_regionkey") == F.col("r_regionkey"), "left").groupBy("r_name").agg(F.count("n_nationkey").alias("n")).collect()
    path = _scratch(spark, "build")
    Wr.write_manifest(spark, path, [{"layer_key": x["r_name"], "status": "built" if x["n"] > 4 else "deferred", "reason": None if x["n"] > 4 else "few", "n_features": x["n"]} for x in g])
    layers = spark.read.parquet(f"{path}/layers")
    Wr.write_inventory({"layers": layers}, f"{path}/inventory")
    text = spark.read.schema(layers.schema).option("sep", "\t").option("header", True).csv(f"{path}/inventory/layers")
    return layers.join(text.select("layer_key", F.col("status").alias("_s")), "layer_key").where("status = _s").select("layer_key", "status", "n_features")


# --- whole tables for queries that took a part -----------------------------------------------------


@query(f"WITH o AS ({O.ORDERS}) SELECT sample_ordinal, 'declared' AS study, coalesce(platform, 'fallback') AS platform, stratum_key || ':assay' AS assay_id FROM o")
def declared_columns_all(spark: SparkSession, d: str) -> DataFrame:
    """What strata declare, on the orders of every status."""
    o = T.order_samples(spark, d)
    strata = [Stratum(x[0], "l", Origin("declared", "g", "c"), method=Method(platform=Stated("fallback"))) for x in o.select("stratum_key").distinct().collect()]
    return S.declared_columns(o, strata).select("sample_ordinal", "study", "platform", "assay_id")


_ALL_FILES = "SELECT r_name AS stratum_key, n_name AS file_id FROM nation JOIN region ON n_regionkey = r_regionkey"
_ALL_PEOPLE = "SELECT r_name AS stratum_key, c_custkey::VARCHAR AS specimen_id FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"


@query(f"WITH f AS ({_ALL_FILES}), s AS ({_ALL_PEOPLE}) SELECT s.stratum_key, specimen_id, file_id FROM s LEFT JOIN f USING (stratum_key)")
def sample_file_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Every sample with every file of its stratum."""
    place = T.table(spark, d, "nation").join(T.table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    files = place.select(F.col("r_name").alias("stratum_key"), F.col("n_name").alias("file_id"), F.lit("matrix").alias("file_role"))
    people = T.table(spark, d, "customer").join(place, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("r_name").alias("stratum_key"), _text("c_custkey").alias("specimen_id"))
    return S.sample_files(people, files).select("stratum_key", "specimen_id", "file_id")


@query(
    "WITH f AS (SELECT s_nationkey || CASE WHEN s_acctbal < 0 THEN ' debit' ELSE ' credit' END AS stratum_key, s_name AS file_id FROM supplier), n AS (SELECT stratum_key, any_value(file_id) AS file_id FROM f GROUP BY 1 HAVING count(*) = 1) "
    "SELECT c_custkey::VARCHAR AS specimen_id, n.file_id FROM customer LEFT JOIN n ON n.stratum_key = c_nationkey || CASE WHEN c_acctbal < 0 THEN ' debit' ELSE ' credit' END"
)
def sole_file_of_stratum(spark: SparkSession, d: str) -> DataFrame:
    """The file of a sample whose stratum has exactly one; null where it has several or none."""
    kind = lambda k, b: F.concat(_text(k), F.when(F.col(b) < 0, " debit").otherwise(" credit")).alias("stratum_key")
    files = T.table(spark, d, "supplier").select(kind("s_nationkey", "s_acctbal"), F.col("s_name").alias("file_id"), F.lit("matrix").alias("file_role"))
    people = T.table(spark, d, "customer").select(kind("c_nationkey", "c_acctbal"), _text("c_custkey").alias("specimen_id"))
    return S.with_sole_file(people, files).select("specimen_id", "file_id")


_UNION_COLUMNS = ("feature_key", "lod", "specimen_id", "stratum_key", "value")


@query(
    f"WITH u AS (SELECT stratum_key, feature_key, specimen_id, value, NULL::DOUBLE AS lod FROM ({O.COHORTS}) UNION ALL SELECT stratum_key, feature_key, specimen_id, value, lod FROM ({O.PANEL})) "
    + " UNION ALL ".join(f"SELECT stratum_key, '{c}' AS column_name, count(*) AS n_rows, count({c}) AS n_values FROM u GROUP BY 1" for c in _UNION_COLUMNS)
)
def column_union_of_layers(spark: SparkSession, d: str) -> DataFrame:
    """A layer without and one with limits of detection on the union of their columns: values by column."""
    both = L.union_all([T.cohorts(spark, d), T.panel(spark, d)])
    counts = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_{c}").alias("n_values")) for c in sorted(both.columns)])
    per = both.groupBy("stratum_key").agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(c).alias(f"_{c}") for c in both.columns])
    return per.select("stratum_key", "n_rows", F.inline(counts))


@query(f"WITH c AS ({O.COHORTS}) SELECT t.tracking_row, f.field, f.v AS derived_value FROM (VALUES ('all of A', 'A'), ('EUROPE', NULL)) t(tracking_row, prefix), LATERAL (SELECT count(DISTINCT stratum_key || feature_key)::VARCHAR AS nf, count(DISTINCT stratum_key || specimen_id)::VARCHAR AS ns FROM c WHERE CASE WHEN prefix IS NULL THEN stratum_key = t.tracking_row ELSE starts_with(stratum_key, prefix) END) x, LATERAL (VALUES ('n_features', nf), ('n_samples', ns)) f(field, v)")
def tracking_sums(spark: SparkSession, d: str) -> DataFrame:
    """A tracking row over several strata takes the sum of their numbers."""
    c = T.cohorts(spark, d)
    i = c.groupBy("stratum_key").agg(F.count_distinct("feature_key").alias("n_features"), F.count_distinct("specimen_id").alias("n_samples")).withColumns({"n_resolved": F.lit(0), "site": F.lit("")})
    rows = spark.createDataFrame([("all of A", "A"), ("EUROPE", None)], "tracking_row string, prefix string")
    return M.measured_rows(i, rows).where("field in ('n_features', 'n_samples')")



_WIDE = "SELECT p_brand AS feature_key, l_orderkey::VARCHAR AS specimen_id, avg(l_extendedprice) AS value FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"


@query(f"SELECT feature_key, specimen_id, round(value + 1e-9, 6) AS value FROM ({_WIDE})")
def wide_bundle_orders(spark: SparkSession, d: str) -> DataFrame:
    """The bundle of all orders by brand, written, and its matrix read back as cells."""
    lines = T.table(spark, d, "lineitem").join(T.table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    cells = lines.groupBy(F.col("p_brand").alias("feature_key"), F.col("l_orderkey").cast("string").alias("specimen_id")).agg(F.avg("l_extendedprice").alias("value"))
    samples = T.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("specimen_id"), F.concat(F.lit("k"), F.col("o_orderkey").cast("string")).alias("row_key"), F.col("o_orderkey").alias("sample_ordinal"))
    path = _scratch(spark, "bundle")
    info = Wr.write_bundle(cells, samples, T.table(spark, d, "part").select(F.col("p_brand").alias("feature_key")).distinct(), path, False)
    return Wr.bundle_cells(spark, path, info).select("feature_key", "specimen_id", F.round(F.col("value") + 1e-9, 6).alias("value"))


_OBJECTS = """SELECT 'item ' || item_id AS object_id, md5(text) AS content_md5, 'item' AS kind, item_id % 2 = 0 AS critical FROM benchmark
  UNION ALL SELECT 'doc ' || doc_id, md5(coalesce(text, '')), 'document', quality = 1 FROM labels JOIN documents USING (doc_id)"""


@query(
    f"WITH w AS ({_OBJECTS}), i AS (SELECT md5(coalesce(text, '')) AS content_md5, array_to_string(list_sort(list(DISTINCT coalesce(source, '') || '/' || doc_id)), '; ') AS held FROM documents GROUP BY 1) "
    "SELECT object_id, kind, critical, i.content_md5 IS NOT NULL AS present, held AS held_as FROM w LEFT JOIN i USING (content_md5)"
)
def object_presence(spark: SparkSession, d: str) -> DataFrame:
    """Benchmark items and labelled documents: whether their content is held, and where."""
    docs = T.table(spark, d, "documents").withColumn("content_md5", F.md5(F.coalesce("text", F.lit(""))))
    items = T.table(spark, d, "benchmark").select(F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("object_id"), F.md5("text").alias("content_md5"), F.lit("item").alias("kind"), (F.col("item_id") % 2 == 0).alias("critical"))
    labelled = T.table(spark, d, "labels").join(docs, "doc_id").select(F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("object_id"), "content_md5", F.lit("document").alias("kind"), (F.col("quality") == 1).alias("critical"))
    index = docs.groupBy("content_md5").agg(F.array_sort(F.collect_set(F.concat_ws("/", F.coalesce("source", F.lit("")), F.col("doc_id").cast("string")))).alias("paths"))
    return M.missing_objects(items.unionByName(labelled), index).select("object_id", "kind", "critical", "present", "held_as")
