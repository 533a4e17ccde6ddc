"""Format readers: each turns one source into long cells with sample and feature dimensions.

A reader is a function (spark, stratum) -> StratumFrames, registered by name; ``register`` adds
others. Values are null or finite; nothing is collected but header names.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.functions import expr as E
from strataloom.model import MIN_SAMPLE_COMPLETENESS, Stratum, StratumFrames
from strataloom.operators import samples as S
from strataloom.operators import stats
from strataloom.operators.layer import unpivot
from strataloom.operators.lookups import first_rows
from strataloom.sources.annotations import peptide_features
from strataloom.sources.tabular import read_delimited, read_sheet

Reader = Callable[[SparkSession, Stratum], StratumFrames]
MATRIX_READERS: dict[str, Reader] = {}

#: Names in the formats.
RATIO_COLUMN = r"Abundance Ratio: \(F(\d+), (\d+[NC]?)\) / \(F\1, 126\)$"
INTENSITY_PREFIX = "LFQ intensity "
DECOY_COLUMNS = ("Reverse", "Potential contaminant", "Only identified by site")
SRM_META = ("sample_id", "sample_num", "plate", "plate_row", "plate_col", "plate_well", "subject.id", "isControl", "sample.type", "Replicate.Name")


def register(name: str):
    def add(f: Reader) -> Reader:
        MATRIX_READERS[name] = f
        return f

    return add


#: word of a declared quality step -> the note that shows it was done; filled beside the code that does it.
TRACES: dict[str, str] = {}


def leaves(**notes: str):
    """Declares that the function leaves these notes, each for the quality steps whose name has the word given."""

    def add(f):
        TRACES.update({word: note for note, word in notes.items()})
        return f

    return add


def read_stratum(spark: SparkSession, s: Stratum) -> StratumFrames:
    if s.source.reader not in MATRIX_READERS:
        raise ValueError(f"stratum {s.key}: no reader {s.source.reader!r}; there are {sorted(MATRIX_READERS)}")
    return MATRIX_READERS[s.source.reader](spark, s)


def _q(name: str):
    return F.col(f"`{name}`")


def _path(s: Stratum) -> str:
    return s.source.files[0]


def _frames(s: Stratum, wide: DataFrame, feature: str, columns: list[str], value, extra: list[str] | None = None) -> StratumFrames:
    """Frames of a wide matrix: one feature column, the given sample columns."""
    renamed = wide.select(_q(feature).cast("string").alias("feature_source_value"), *[_q(c) for c in extra or []], "src_ordinal", *[_q(c) for c in columns])
    long = unpivot(renamed.drop(*(extra or [])), ["feature_source_value", "src_ordinal"])
    cells = long.select("feature_source_value", "specimen_source_value", value(F.col("value")).alias("value"), F.lit(None).cast("double").alias("lod"))
    spark = wide.sparkSession
    samples = spark.createDataFrame([(c, i) for i, c in enumerate(columns)], "specimen_source_value string, src_ordinal bigint")
    return StratumFrames(s, cells, samples, renamed.select("feature_source_value", *(extra or []), "src_ordinal"), {"n_samples": len(columns)})


@register("csv_matrix")
def csv_matrix(spark: SparkSession, s: Stratum) -> StratumFrames:
    """First column is the feature, each further column a sample."""
    wide = read_delimited(spark, _path(s))
    feature, *columns = [c for c in wide.columns if c != "src_ordinal"]
    return _frames(s, wide, feature, columns, E.numeric)


@register("reporter_xlsx")
def reporter_xlsx(spark: SparkSession, s: Stratum) -> StratumFrames:
    """Sheet with sample ids in row 4 from column 4 on; column 1 gene, column 2 accession; log2."""
    sheet = read_sheet(spark, _path(s))
    head = sheet.where("sheet_row = 4").first()["cells"]
    names = [(i, n) for i, n in enumerate(head) if i >= 4 and n]
    body = sheet.where("sheet_row >= 5").withColumn("gene", F.get("cells", F.lit(1))).withColumn("acc", F.get("cells", F.lit(2)))
    body = body.where(~(E.blank("gene") & E.blank("acc")))
    feature = F.concat(F.coalesce("gene", F.lit("")), F.lit("|"), F.coalesce("acc", F.lit("")))
    pairs = F.array(*[F.struct(F.lit(n).alias("specimen_source_value"), F.get("cells", F.lit(i)).alias("raw")) for i, n in names])
    rows = body.select(feature.alias("feature_source_value"), F.inline(pairs))
    cells = rows.select("feature_source_value", "specimen_source_value", E.safe_log2(E.numeric("raw")).alias("value"), F.lit(None).cast("double").alias("lod"))
    samples = spark.createDataFrame([(n, i) for i, n in names], "specimen_source_value string, src_ordinal bigint")
    return StratumFrames(s, cells, samples, body.select(feature.alias("feature_source_value"), F.col("sheet_row").alias("src_ordinal")), {"transform": "log2", "n_samples": len(names)})


@register("maxquant")
@leaves(n_decoy_contaminant_dropped="contaminant", transform="log2")
def maxquant(spark: SparkSession, s: Stratum) -> StratumFrames:
    """Intensity columns by prefix; decoys, contaminants and site-only rows go; log2."""
    wide = read_delimited(spark, _path(s), sep="\t")
    columns = [c for c in wide.columns if c.startswith(INTENSITY_PREFIX)]
    decoys = [c for c in DECOY_COLUMNS if c in wide.columns]
    clean = wide
    for c in decoys:
        clean = clean.where(E.blank(_q(c)))
    ids = [_q(c) for c in ("Majority protein IDs", "Protein IDs") if c in wide.columns]
    names = {c: c[len(INTENSITY_PREFIX) :] for c in columns}
    clean = clean.select(F.coalesce(*ids).alias("_feature"), "src_ordinal", *[_q(c).alias(n) for c, n in names.items()])
    out = _frames(s, clean, "_feature", list(names.values()), lambda c: E.safe_log2(E.numeric(c)))
    name = F.col("specimen_source_value")
    out.samples = out.samples.withColumn("is_pool", name.rlike("(?i)gis|pool")).withColumn("batch", F.substring_index(name, "_", 1))
    out.notes |= {"transform": "log2", "n_decoy_contaminant_dropped": wide.select(F.count_if(S.any_of(*[~E.blank(_q(c)) for c in decoys])).alias("n")) if decoys else None}
    return out


@register("pd_ratio")
@leaves(centring="centring")
def pd_ratio(spark: SparkSession, s: Stratum) -> StratumFrames:
    """Channel over reference ratios; log2, centred on the median of per-plex medians."""
    wide = read_delimited(spark, _path(s), sep="\t").where(F.col("Accession").isNotNull())
    found = [(c, m[1], m[2]) for c in wide.columns if (m := re.match(RATIO_COLUMN, c))]
    gene = F.col("`Gene Symbol`") if "Gene Symbol" in wide.columns else F.lit(None).cast("string")
    feature = F.concat(F.coalesce(gene, F.lit("nan")), F.lit("|"), F.col("Accession")) if "Gene Symbol" in wide.columns else F.concat(F.lit("|"), F.col("Accession"))
    named = wide.select(feature.alias("_feature"), "src_ordinal", *[_q(c).alias(f"F{p}.{ch}") for c, p, ch in found])
    out = _frames(s, named, "_feature", [f"F{p}.{ch}" for _, p, ch in found], lambda c: E.safe_log2(E.numeric(c)))
    plex = F.regexp_extract("specimen_source_value", r"^F(\d+)\.", 1)
    ratios = out.cells.select(F.lit(s.key).alias("stratum_key"), F.col("feature_source_value").alias("feature_key"), "specimen_source_value", "value", "lod", plex.alias("plex"))
    per_plex = spark.createDataFrame([(s.key, p, sum(1 for _, q, _ in found if q == p)) for p in sorted({p for _, p, _ in found})], "stratum_key string, plex string, plex_samples int")
    out.cells = stats.centre_on_plexes(ratios).select(F.col("feature_key").alias("feature_source_value"), "specimen_source_value", "value", "lod")
    name = F.col("specimen_source_value")
    out.samples = out.samples.withColumns({"batch": F.concat(F.lit("plex"), plex), "channel": F.substring_index(name, ".", -1), "is_pool": F.lit(False)})
    out.notes |= {"transform": "log2", "centring": "median of per-plex medians", "structured_missingness": stats.plex_structure(ratios, per_plex)}
    return out


@register("srm")
@leaves(control_wells_flagged="control well")
def srm(spark: SparkSession, s: Stratum) -> StratumFrames:
    """Samples are rows, features columns; control wells are pools, donors are numeric ids only."""
    wide = read_delimited(spark, _path(s), sep="\t")
    columns = [c for c in wide.columns if c != "src_ordinal"]
    meta = [c for c in columns if c in SRM_META or c.startswith(("Unnamed", "_c"))]
    features = [c for c in columns if c not in meta]
    key = "sample_id" if "sample_id" in columns else columns[0]
    long = unpivot(wide.select(_q(key).cast("string").alias("specimen_source_value"), *[_q(f) for f in features]), ["specimen_source_value"], "feature_source_value")
    cells = long.select("feature_source_value", "specimen_source_value", E.numeric("value").alias("value"), F.lit(None).cast("double").alias("lod"))
    control = F.coalesce(F.upper(F.trim(_q("isControl"))) == "TRUE", F.lit(False)) if "isControl" in columns else F.lit(False)
    other = F.coalesce(_q("sample.type") != "subjects", F.lit(True)) if "sample.type" in columns else F.lit(False)
    raw = F.trim(_q("subject.id")) if "subject.id" in columns else F.lit(None).cast("string")
    person = F.when(raw.rlike(r"^\d+(\.0+)?$"), F.regexp_replace(raw, r"\.0+$", ""))
    plate = _q("plate").cast("string") if "plate" in columns else F.lit(None).cast("string")
    samples = wide.select(_q(key).cast("string").alias("specimen_source_value"), person.alias("person_source_value"), (control | other).alias("is_pool"), plate.alias("plate_id"), "src_ordinal")
    feats = spark.createDataFrame([(f, i) for i, f in enumerate(features)], "feature_source_value string, src_ordinal bigint")
    if s.source.options.get("feature_meta"):
        peptides = peptide_features(spark, s.source.options["feature_meta"])
        feats = feats.join(first_rows(peptides, ["feature_source_value"]).drop("src_ordinal"), "feature_source_value", "left")
    flagged = wide.agg(F.count_if(control | other).alias("n_flagged"), F.count(F.lit(1)).alias("n_samples"), F.count_if(control).alias("from_control"), F.count_if(other).alias("from_type"))
    return StratumFrames(s, cells, samples, feats, {"control_wells_flagged": flagged})


@register("somascan")
@leaves(colcheck_counts="colcheck")
def somascan(spark: SparkSession, s: Stratum) -> StratumFrames:
    """Samples are rows, aptamers columns; only human proteins stay; feature metadata keep-first."""
    wide = read_delimited(spark, _path(s))
    key, *features = [c for c in wide.columns if c != "src_ordinal"]
    meta = first_rows(read_delimited(spark, s.source.options["feature_meta"]), ["SeqId"])
    names = spark.createDataFrame([(f, i) for i, f in enumerate(features)], "feature_source_value string, src_ordinal bigint")
    m = meta.select(
        F.col("SeqId").alias("_id"), F.col("UniProt").alias("uniprot_raw"), F.col("EntrezGeneSymbol").alias("gene_raw"), F.col("Dilution").alias("dilution"),
        F.trim("Organism").alias("_organism"), F.trim("Type").alias("_type") if "Type" in meta.columns else F.lit("Protein").alias("_type"), F.col("ColCheck").alias("colcheck") if "ColCheck" in meta.columns else F.lit(None).cast("string").alias("colcheck"),
    )
    # one row per column of the matrix: small on both sides
    feats = names.join(m, F.col("feature_source_value") == F.col("_id"), "left").where("_organism = 'Human' and _type = 'Protein'").drop("_id", "_organism", "_type").withColumn("seq_id", F.col("feature_source_value"))
    long = unpivot(wide.select(_q(key).cast("string").alias("specimen_source_value"), *[_q(f) for f in features]), ["specimen_source_value"], "feature_source_value")
    cells = long.join(feats.select("feature_source_value"), "feature_source_value", "left_semi").select("feature_source_value", "specimen_source_value", E.numeric("value").alias("value"), F.lit(None).cast("double").alias("lod"))
    counts = feats.groupBy("colcheck").agg(F.count(F.lit(1)).alias("n"))
    return StratumFrames(s, cells, wide.select(_q(key).cast("string").alias("specimen_source_value"), "src_ordinal"), feats, {"colcheck_counts": counts, "sample_level_qc_in_deposit": None})


@register("olink")
@leaves(n_samples_by_warn_count="qc_warning")
def olink(spark: SparkSession, s: Stratum) -> StratumFrames:
    """Long panel files: withdraw plates, average NPX and LOD by (feature, sample), worst-of QC."""
    paths = s.source.files
    panels = s.source.options.get("panels") or [str(i) for i in range(len(paths))]
    rows = None
    for i, (p, panel) in enumerate(zip(paths, panels, strict=True)):
        one = read_delimited(spark, p).withColumns({"panel": F.lit(panel), "src_ordinal": F.struct(F.lit(i).alias("p"), F.col("src_ordinal").alias("o"))})
        rows = one if rows is None else rows.unionByName(one, allowMissingColumns=True)
    rows = rows.where(~E.blank("UniProt"))  # a null feature is dropped, never called "nan"
    notes: dict = {}
    if "PlateID" in rows.columns and s.source.options.get("withdrawn_plates"):
        rows, notes["withdrawn_samples"] = S.withdraw_plates(rows, list(s.source.options["withdrawn_plates"]))
    v = rows.select(F.col("UniProt").alias("feature_source_value"), F.col("sample_id").alias("specimen_source_value"), E.numeric("NPX").alias("value"), E.numeric("LOD").alias("lod"))
    # a limit may exist where no value does: one aggregate over both
    cells = v.groupBy("feature_source_value", "specimen_source_value").agg(F.avg("value").alias("value"), F.avg("lod").alias("lod"))
    freq = F.max(E.numeric("MissingFreq")) if "MissingFreq" in rows.columns else F.lit(None).cast("double")
    feats = rows.groupBy(F.col("UniProt").alias("feature_source_value")).agg(E.first_by("panel", "src_ordinal").alias("panel"), E.first_by("Panel_Lot_Nr", "src_ordinal").alias("panel_lot_nr"), freq.alias("missing_freq"), F.min("src_ordinal").alias("src_ordinal"))
    feats = feats.withColumn("uniprot_raw", F.col("feature_source_value"))
    first = rows.groupBy("sample_id").agg(E.first_by("participant_id", "src_ordinal").alias("person_source_value"), E.first_by("visit_month", "src_ordinal").alias("visit_month"), E.first_by("PlateID", "src_ordinal").alias("plate_id"), F.min("src_ordinal").alias("src_ordinal"))
    samples = first.join(S.qc_summary(rows, ["sample_id"]), "sample_id").withColumnRenamed("sample_id", "specimen_source_value")
    samples = samples.withColumn("visit_month", E.numeric("visit_month").cast("int")).withColumn("is_pool", F.lit(False))
    notes["n_samples_by_warn_count"] = samples.groupBy("qc_warn_count").agg(F.count(F.lit(1)).alias("n"))
    return StratumFrames(s, cells, samples, feats, notes)


@register("dia")
def dia(spark: SparkSession, s: Stratum) -> StratumFrames:
    """Long form: mean by (feature, sample), incomplete samples go, then empty features; log2."""
    rows = read_delimited(spark, _path(s)).where(~E.blank("UniProt"))
    v = rows.select(F.col("UniProt").alias("feature_key"), F.col("sample_id").alias("specimen_id"), E.numeric("protein_abundance").alias("value")).withColumn("stratum_key", F.lit(s.key))
    mean = stats.pivot_mean(v, "stratum_key", "feature_key", "specimen_id")
    found = stats.complete_samples(mean, s.source.options.get("min_sample_completeness", MIN_SAMPLE_COMPLETENESS))
    kept = found.where("kept")
    cells = mean.join(kept.select("specimen_id"), "specimen_id", "left_semi").select(F.col("feature_key").alias("feature_source_value"), F.col("specimen_id").alias("specimen_source_value"), E.safe_log2("value").alias("value"), F.lit(None).cast("double").alias("lod"))
    first = first_rows(rows, ["sample_id"]).select(F.col("sample_id").alias("specimen_source_value"), F.col("participant_id").alias("person_source_value"), E.numeric("visit_month").cast("int").alias("visit_month"), "src_ordinal")
    samples = first.join(kept.select(F.col("specimen_id").alias("specimen_source_value"), F.col("n_detected").cast("int").alias("n_detected"), "detection_rate"), "specimen_source_value").withColumn("is_pool", F.lit(False))
    every = rows.groupBy(F.col("UniProt").alias("feature_source_value")).agg(F.min("src_ordinal").alias("src_ordinal"))
    seen = cells.where(F.col("value").isNotNull()).select("feature_source_value").distinct()
    feats = every.join(seen, "feature_source_value", "left_semi").withColumn("uniprot_raw", F.col("feature_source_value"))
    cells = cells.join(feats.select("feature_source_value"), "feature_source_value", "left_semi")
    empty = every.join(seen, "feature_source_value", "left_anti").agg(F.count(F.lit(1)).alias("n"))
    dropped = dropped_samples(found)
    return StratumFrames(s, cells, samples, feats, {"transform": "log2", "samples_dropped_low_completeness": dropped, "n_features_dropped_empty": empty, "source_form": "long"})


@register("long_cells")
@leaves(n_samples_by_warn_count="qc_warning", samples_dropped_low_completeness="completeness")
def long_cells(spark: SparkSession, s: Stratum) -> StratumFrames:
    """A Parquet delivery that is long already: folders cells, samples and features under one path.

    cells: feature_source_value, specimen_source_value, value, lod; the others by their source values, in the order of
    src_ordinal. Withdrawn plates (plate_id) go, then incomplete samples if a limit is declared, then features
    without a value; columns of quality, where the delivery has them, leave their notes.
    """
    base = _path(s).rstrip("/")
    cells, samples, feats = (spark.read.parquet(f"{base}/{part}") for part in ("cells", "samples", "features"))
    notes: dict = {"source_form": "long"}
    plates = s.source.options.get("withdrawn_plates")
    if plates:
        kept, notes["withdrawn_samples"] = S.withdraw_plates(samples.withColumnsRenamed({"specimen_source_value": "sample_id", "person_source_value": "participant_id"}), list(plates), "plate_id")
        samples = kept.withColumnsRenamed({"sample_id": "specimen_source_value", "participant_id": "person_source_value"})
    if "is_pool" in samples.columns:
        notes["control_wells_flagged"] = samples.agg(F.count_if("is_pool").alias("n_flagged"), F.count(F.lit(1)).alias("n_samples"))
    limit = s.source.options.get("min_sample_completeness")
    cells = cells.withColumn("value", E.finite("value")).join(samples.select("specimen_source_value"), "specimen_source_value", "left_semi")
    if limit is not None:
        found = stats.complete_samples(cells.select(F.lit(s.key).alias("stratum_key"), F.col("feature_source_value").alias("feature_key"), F.col("specimen_source_value").alias("specimen_id"), "value"), limit)
        notes["samples_dropped_low_completeness"] = dropped_samples(found)
        gone = found.where(~F.col("kept")).select(F.col("specimen_id").alias("specimen_source_value"))
        samples, cells = (x.join(gone, "specimen_source_value", "left_anti") for x in (samples, cells))
    seen = cells.where(F.col("value").isNotNull()).select("feature_source_value").distinct()
    notes["n_features_dropped_empty"] = feats.join(seen, "feature_source_value", "left_anti").agg(F.count(F.lit(1)).alias("n"))
    feats = feats.join(seen, "feature_source_value", "left_semi")
    if "colcheck" in feats.columns:
        notes["colcheck_counts"] = feats.groupBy("colcheck").agg(F.count(F.lit(1)).alias("n"))
    if "qc_warn_count" in samples.columns:
        notes["n_samples_by_warn_count"] = samples.groupBy("qc_warn_count").agg(F.count(F.lit(1)).alias("n"))
    else:
        notes["sample_level_qc_in_deposit"] = None
    return StratumFrames(s, cells.select("feature_source_value", "specimen_source_value", "value", "lod"), samples, feats, notes)


def dropped_samples(found: DataFrame, k: int = 5) -> DataFrame:
    """One row: how many samples of stats.complete_samples are dropped, and the k lowest counts of features
    among them: an ordered take, not a list of all."""
    gone = found.where(~F.col("kept"))
    lowest = gone.select("n_detected").orderBy("n_detected").limit(k).agg(F.array_sort(F.collect_list("n_detected")).alias("lowest_counts"))
    return gone.agg(F.count(F.lit(1)).alias("n_dropped")).join(lowest, F.lit(True), "left")
