"""Annotation readers: (spark, stratum) -> samples. Each reads an allow-list of columns only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions import expr as E
from strataloom.model import Stratum
from strataloom.operators import samples as S
from strataloom.operators.lookups import first_rows
from strataloom.sources.tabular import read_delimited, read_sheet_table

ANNOTATION_READERS: dict[str, Callable[[SparkSession, Stratum, DataFrame], DataFrame]] = {}
#: Column names of the portal tables that may be read; demographic ones are never among them.
BIOSPECIMEN_COLUMNS = ["individualID", "specimenID", "specimenIdSource", "organ", "tissue", "BrodmannArea", "sampleStatus", "nucleicAcidSource", "cellType", "isPostMortem", "assay", "exclude", "excludeReason"]
ASSAY_META_COLUMNS = ["specimenID", "individualID", "platform", "isAssayControl", "controlType", "lotNumber", "fragmentation", "resolution", "TMTType", "assay"]


def register(name: str):
    def add(f):
        ANNOTATION_READERS[name] = f
        return f

    return add


def _absent(*words: str):
    return lambda c: F.when(~F.trim(c).isin(*words), F.trim(c))


def _or_null(df: DataFrame, name: str):
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


@register("dc_traits")
def dc_traits(spark: SparkSession, s: Stratum, samples: DataFrame | None = None) -> DataFrame:
    """Person is the individual id, else the project id, each in its own namespace."""
    d = read_sheet_table(spark, s.source.annotation)
    clean = _absent("nan", "NA", "None", "", "GIS")
    own = clean(_or_null(d, "individualID" if "individualID" in d.columns else "IndividualID"))
    project = clean(_or_null(d, "projID"))
    first, second = s.source.options.get("namespaces", ("individualID", "projid"))
    batch = F.col("Batch") if "Batch" in d.columns else F.regexp_extract("ID", r"(b\d+)", 1)
    channel = F.col("Channel") if "Channel" in d.columns else F.element_at(F.split("ID", r"\."), -1)
    return d.select(
        F.col("ID").alias("specimen_source_value"), F.coalesce(own, project).alias("person_source_value"), F.when(own.isNotNull(), first).when(project.isNotNull(), second).alias("person_source_namespace_row"),
        batch.alias("batch"), channel.alias("channel"), _or_null(d, "Dataset").alias("source_dataset"), F.coalesce(own, project).isNull().alias("is_pool"), "src_ordinal",
    )


@register("specimen_table")
def specimen_table(spark: SparkSession, s: Stratum, samples: DataFrame | None = None) -> DataFrame:
    d = read_delimited(spark, s.source.annotation, columns=["SampleID", "projid", "Batch", "batch.channel", "SpecimenID"])
    person = _absent("NA", "nan")(F.col("projid"))
    pool = F.coalesce(F.lower("SpecimenID").contains("gis"), F.lit(False)) | person.isNull()
    return d.select(F.col("SampleID").alias("specimen_source_value"), person.alias("person_source_value"), F.col("Batch").alias("batch"), F.element_at(F.split("`batch.channel`", r"\."), -1).alias("channel"), F.col("SpecimenID").alias("specimen_native_id"), pool.alias("is_pool"), "src_ordinal")


@register("somascan_samples")
def somascan_samples(spark: SparkSession, s: Stratum, samples: DataFrame | None = None) -> DataFrame:
    d = read_delimited(spark, s.source.annotation, columns=["projid_visit", "projid", "Visit", "study"])
    month, evidence = S.visit_month_from_index("Visit")
    return d.select(F.col("projid_visit").alias("specimen_source_value"), F.col("projid").alias("person_source_value"), E.numeric("Visit").cast("int").alias("visit_index"), month, evidence, F.trim("study").alias("source_dataset"), F.lit(False).alias("is_pool"), "src_ordinal")


@register("olink_samples")
def olink_samples(spark: SparkSession, s: Stratum, samples: DataFrame | None = None) -> DataFrame:
    d = first_rows(read_delimited(spark, s.source.annotation, columns=["participant_id", "sample_id", "visit_month"]), ["sample_id"])
    return d.select(F.col("sample_id").alias("specimen_source_value"), F.col("participant_id").alias("person_source_value"), E.numeric("visit_month").cast("int").alias("visit_month"), F.lit("source").alias("visit_month_evidence"), F.lit(False).alias("is_pool"), "src_ordinal")


@register("biospecimen")
def biospecimen(spark: SparkSession, s: Stratum, samples: DataFrame | None = None) -> DataFrame:
    """Portal biospecimen table by the matrix' own labels; stated exclusions flag, never drop."""
    b = read_delimited(spark, s.source.annotation, columns=BIOSPECIMEN_COLUMNS)
    if s.source.options.get("assay_filter") and "assay" in b.columns:
        b = b.where(F.col("assay") == s.source.options["assay_filter"])
    b = first_rows(b, ["specimenID"])
    rule = {"plex_channel": E.plex_channel_key, "prefixed": E.prefixed_key}.get(s.source.options.get("key_rewrite"), lambda c: F.col(c) if isinstance(c, str) else c)
    keyed = samples.select("specimen_source_value", "src_ordinal", rule("specimen_source_value").alias("_key"))
    j = keyed.join(b.drop("src_ordinal"), keyed["_key"] == b["specimenID"], "left")
    excluded = F.coalesce(F.upper(F.trim(_or_null(b, "exclude"))).isin("TRUE", "YES", "1"), F.lit(False))
    return j.select(
        "specimen_source_value", F.col("individualID").alias("person_source_value"), F.col("specimenID").alias("specimen_native_id"), F.substring_index("specimen_source_value", "_", 1).alias("batch"),
        _or_null(b, "tissue").alias("anatomic_site_source"), _or_null(b, "BrodmannArea").alias("brodmann_area"), (F.col("individualID").isNull() & F.col("specimen_source_value").rlike("(?i)gis|pool")).alias("is_pool"),
        F.when(excluded, "EXCLUDED_BY_SOURCE").otherwise("not_assessed").alias("qc_status"), _or_null(b, "excludeReason").alias("exclude_reason"), "src_ordinal",
    )


@register("labelling_sheet")
def labelling_sheet(spark: SparkSession, s: Stratum, samples: DataFrame | None = None) -> DataFrame:
    """Specimen is F<plex>.<channel>; the reference channel has no person."""
    d = read_sheet_table(spark, s.source.annotation)
    channel, plex, project = F.trim(F.regexp_replace("Channel", "_", "")), F.trim("Plex"), F.trim("ProjID")
    reference = F.coalesce((F.upper(project) == "GIS") | (channel == "126"), F.lit(False))
    return d.select(F.concat(F.lit("F"), plex, F.lit("."), channel).alias("specimen_source_value"), F.when(~reference, project).alias("person_source_value"), F.concat(F.lit("plex"), plex).alias("batch"), channel.alias("channel"), _or_null(d, "Lot #").alias("reagent_lot"), reference.alias("is_pool"), "src_ordinal")


def biospecimen_sites(spark: SparkSession, path: str, assay: str | None) -> tuple[DataFrame, DataFrame]:
    """(sites of the assay's own specimens by specimen, area that specimens of other assays state by donor and tissue).

    Without an assay column all rows are the assay's own.
    """
    b = read_delimited(spark, path, columns=BIOSPECIMEN_COLUMNS)
    own = F.coalesce(F.col("assay") == assay, F.lit(False)) if assay and "assay" in b.columns else F.lit(True)
    direct = first_rows(b.where(own), ["specimenID"]).select(
        F.col("specimenID").alias("specimen_source_value"), F.col("individualID").alias("_donor"), _or_null(b, "tissue").alias("anatomic_site_source"), _or_null(b, "BrodmannArea").alias("brodmann_area")
    )
    others = b.where(~own).select(F.col("individualID").alias("_donor"), _or_null(b, "tissue").alias("anatomic_site_source"), _or_null(b, "BrodmannArea").alias("brodmann_area"), "src_ordinal")
    return direct, others


def crosswalk(spark: SparkSession, path: str) -> DataFrame:
    """Project id to individual id, from a file of which nothing else is read."""
    d = read_delimited(spark, path, columns=["projid", "individualID", "Study"]).dropna(subset=["projid", "individualID"])
    return d.select(F.trim("projid").alias("projid"), F.trim("individualID").alias("individual_id"), F.trim("Study").alias("study")).distinct()


def assay_metadata(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, columns=ASSAY_META_COLUMNS)


def interval_lookup(spark: SparkSession, path: str, key: str, column: str) -> DataFrame:
    d = read_delimited(spark, path, columns=[key, column])
    return d.select(E.source_id(f"`{key}`").alias("person_source_value"), F.col(f"`{column}`").alias("interval"), "src_ordinal")


def peptide_features(spark: SparkSession, path: str) -> DataFrame:
    """feature_source_value and peptide_sequence of a peptide table."""
    d = read_delimited(spark, path, sep="\t")
    first = d.columns[0]
    return d.select(F.col(f"`{first}`").alias("feature_source_value"), _or_null(d, "Peptide.Sequence").alias("peptide_sequence"), "src_ordinal")


def symbol_reference(spark: SparkSession, path: str) -> DataFrame:
    """uniprot, symbol, src_ordinal of a two-column reference."""
    d = read_delimited(spark, path)
    a, b = [c for c in d.columns if c != "src_ordinal"][:2]
    return d.select(F.col(f"`{a}`").alias("uniprot"), F.col(f"`{b}`").alias("symbol"), "src_ordinal").dropna(subset=["uniprot", "symbol"])
