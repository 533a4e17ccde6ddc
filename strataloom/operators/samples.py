"""The sample table: identity, visits, sites, intervals, keys, files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataloom.functions import expr as E
from strataloom.model import ASSAY_COLUMNS, BRODMANN_CONVENTION, FILE_COLUMNS, HOURS_PER_UNIT, PLAUSIBLE_HOURS, Stratum
from strataloom.operators.lookups import any_of, first_rows, lookup_first, propagate

UNRESOLVED = "UNRESOLVED"


def with_identity(samples: DataFrame, namespace: str) -> DataFrame:
    """person_id as its source writes it, its namespace (a row's own first), and a global key."""
    own = F.col("person_source_namespace_row") if "person_source_namespace_row" in samples.columns else F.lit(None).cast("string")
    raw = F.col("person_source_value") if "person_source_value" in samples.columns else F.lit(None).cast("string")
    out = samples.withColumn("person_source_value", E.source_id(raw)).withColumn("person_source_namespace", F.coalesce(own, F.lit(namespace)))
    return out.withColumn("person_id", F.col("person_source_value")).withColumn("person_global_key", E.global_key("person_source_namespace", "person_source_value"))


def drop_unresolved(samples: DataFrame, resolvable: bool = True) -> DataFrame:
    """Samples without a donor go, unless they are pools or the source cannot resolve donors."""
    if not resolvable or "person_source_value" not in samples.columns:
        return samples
    pool = F.coalesce(F.col("is_pool"), F.lit(False)) if "is_pool" in samples.columns else F.lit(False)
    return samples.where(E.source_id("person_source_value").isNotNull() | pool)


def with_visits(samples: DataFrame) -> DataFrame:
    """specimen_id = stratum:specimen; visit_occurrence_id from the month, else the index, else null."""
    out = samples.withColumn("specimen_id", F.concat_ws(":", "stratum_key", "specimen_source_value"))
    visit = F.when(F.col("visit_month").isNotNull(), F.concat(F.col("specimen_id"), F.lit("|M"), F.col("visit_month").cast("string")))
    visit = visit.when(F.col("visit_index").isNotNull(), F.concat(F.col("specimen_id"), F.lit("|V"), F.col("visit_index").cast("string")))
    return out.withColumn("visit_occurrence_id", visit)


def visit_month_from_index(index, months_per_visit: int = 12):
    """Months since baseline from a yearly visit number, and the evidence for it."""
    m = E.numeric(index).cast("int")
    return (m * months_per_visit).alias("visit_month"), F.when(m.isNotNull(), F.lit("derived_from_visit_index")).alias("visit_month_evidence")


def brodmann_fill(samples: DataFrame, site: str | None, source: DataFrame | None = None, keys: tuple[str, ...] = ("person_source_value", "anatomic_site_source")) -> DataFrame:
    """brodmann_area: as stated, else from another specimen of the donor and tissue, else by convention.

    A stated value is never overwritten; brodmann_area_evidence says where each value is from.
    """
    out = samples
    for c in ("brodmann_area", "brodmann_area_evidence"):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    stated = F.trim("brodmann_area")
    out = out.withColumn("brodmann_area", F.when(~stated.isin("", "nan", "NA", "None"), F.col("brodmann_area")))
    out = out.withColumn("brodmann_area_evidence", F.coalesce("brodmann_area_evidence", F.when(F.col("brodmann_area").isNotNull(), F.lit("source"))))
    if source is not None:
        out = propagate(out, source, list(keys), "brodmann_area", "brodmann_area_evidence")
    convention = BRODMANN_CONVENTION.get((site or "").strip().lower())
    if convention:
        need = F.col("brodmann_area").isNull()
        out = out.withColumn("brodmann_area_evidence", F.when(need, F.lit("convention")).otherwise(F.col("brodmann_area_evidence")))
        out = out.withColumn("brodmann_area", F.coalesce("brodmann_area", F.lit(convention)))
    return out


def brodmann_report(samples: DataFrame, site: str | None) -> DataFrame:
    """One row: how many values are stated, propagated, conventional, empty, and disagree."""
    convention = BRODMANN_CONVENTION.get((site or "").strip().lower())
    e, v = F.col("brodmann_area_evidence"), F.upper(F.trim("brodmann_area"))
    return samples.agg(
        F.count_if(e == "source").alias("n_source"), F.count_if(e == "propagated").alias("n_propagated"), F.count_if(e == "convention").alias("n_convention"), F.count_if(v.isNull()).alias("n_unfilled"),
        F.count_if((v != F.lit(convention or "").cast("string")) & (e != "convention")).alias("n_disagree") if convention else F.lit(0).cast("bigint").alias("n_disagree"),
    )


def infer_unit(median: float | None) -> tuple[str | None, bool]:
    """(unit read from the median, whether both bands would fit): hours are tested first."""
    if median is None:
        return None, False
    low, high = PLAUSIBLE_HOURS
    hours, minutes = low <= median <= high, low * 60 <= median <= high * 60
    return ("hours" if hours else "minutes" if minutes else None), hours and minutes


def attach_interval(samples: DataFrame, lookup: DataFrame | None, unit: str | None = None, reason: str = "source_not_acquired", key: str = "person_source_value") -> tuple[DataFrame, dict]:
    """pmi_hours with its evidence. lookup: (key, interval, src_ordinal), or None with the reason.

    Where the unit is not stated it is read from the median of the matched values (one number comes
    to the driver); an implausible median withholds all values. Never zero for unknown.
    """
    if lookup is None:
        none = F.lit(None)
        return samples.withColumns({"pmi_hours": none.cast("double"), "pmi_evidence": F.lit(reason), "pmi_source_unit": none.cast("string")}), {"evidence": reason}
    valid = lookup.withColumn("interval", E.numeric("interval")).where(F.col("interval").isNotNull())
    joined = lookup_first(samples, valid.select(key, "interval", "src_ordinal"), [key])
    note: dict = {"evidence": "converted_from_stated_unit", "unit": unit, "ambiguous": False}
    if unit is None:
        median = joined.agg(F.median("interval")).first()[0]
        unit, both = infer_unit(median)
        note = {"evidence": "inferred_from_distribution", "unit": unit, "ambiguous": both, "median_as_found": median}
    factor = HOURS_PER_UNIT.get((unit or "").lower())
    hours = F.col("interval") * factor if factor is not None else F.lit(None).cast("double")
    out = joined.withColumn("pmi_hours", hours)
    out = out.withColumn("pmi_evidence", F.when(F.col("pmi_hours").isNotNull(), F.lit(note["evidence"])).otherwise(F.lit("source_not_acquired")))
    return out.withColumn("pmi_source_unit", F.when(F.col("pmi_hours").isNotNull(), F.lit(unit))).drop("interval"), note


def interval_report(samples: DataFrame) -> DataFrame:
    low, high = PLAUSIBLE_HOURS
    p = F.col("pmi_hours")
    return samples.agg(F.count(p).alias("n_populated"), F.count(F.lit(1)).alias("n_samples"), F.min(p).alias("min_hours"), F.max(p).alias("max_hours"), F.median(p).alias("median_hours"), F.count_if((p < low) | (p > high)).alias("n_outside"))


def replicate_index(samples: DataFrame) -> DataFrame:
    """1, 2, ... for each person in source order; samples without a person count together."""
    who = F.coalesce(F.col("person_global_key"), F.lit(UNRESOLVED))
    return samples.withColumn("replicate_index", F.row_number().over(W.partitionBy(who).orderBy("sample_ordinal")))


def row_key(samples: DataFrame) -> DataFrame:
    """A key for each row, as short as the layer's data allow.

    person, then site if the layer has several, then month (or visit index) if any row has one, then
    stratum if that lowers the number of duplicates, then R<n> on what is still duplicated. Which
    parts apply is decided by one aggregate over the layer (one row comes to the driver).
    """
    who = F.coalesce(F.col("person_global_key"), F.lit(UNRESOLVED))
    site = F.coalesce(F.regexp_replace("anatomic_site", r"\s+", "-"), F.lit("NA"))
    a = samples.agg(F.count_distinct("anatomic_site").alias("sites"), F.count("visit_month").alias("months"), F.count("visit_index").alias("visits")).first()
    key = who
    if a["sites"] > 1:
        key = F.concat_ws("|", key, site)
    if a["months"]:
        key = F.concat(key, F.when(F.col("visit_month").isNotNull(), F.concat(F.lit("|M"), F.col("visit_month").cast("string"))).otherwise(F.lit("")))
    elif a["visits"]:
        key = F.concat(key, F.when(F.col("visit_index").isNotNull(), F.concat(F.lit("|V"), F.col("visit_index").cast("string"))).otherwise(F.lit("")))
    longer = F.concat_ws("|", key, "stratum_key")
    n = samples.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("short"), F.count_distinct(longer).alias("long")).first()
    if n["short"] < n["n"] and n["long"] > n["short"]:
        key = longer
    out = samples.withColumn("row_key", key)
    same = W.partitionBy("row_key")
    nth = F.row_number().over(same.orderBy("sample_ordinal"))
    return out.withColumn("_n", F.count(F.lit(1)).over(same)).withColumn("_i", nth).withColumn("row_key", F.when(F.col("_n") > 1, F.concat(F.col("row_key"), F.lit("|R"), F.col("_i").cast("string"))).otherwise(F.col("row_key"))).drop("_n", "_i")


def attach_assay_metadata(samples: DataFrame, meta: DataFrame, meta_key: str) -> DataFrame:
    """platform, reagent_lot (metadata first) and is_pool (control flag, control type, else as inferred)."""
    take = [c for c in ("platform", "isAssayControl", "controlType", "lotNumber", "fragmentation", "resolution") if c in meta.columns]
    m = first_rows(meta, [meta_key]).select(F.col(meta_key).cast("string").alias("specimen_source_value"), *[F.col(c).alias(f"_{c}") for c in take])
    out = samples.join(m, "specimen_source_value", "left")
    if "platform" in take:
        out = out.withColumn("platform", F.coalesce(F.col("_platform"), F.col("platform")) if "platform" in samples.columns else F.col("_platform"))
    if "lotNumber" in take:
        out = out.withColumn("reagent_lot", F.coalesce(F.col("_lotNumber"), F.col("reagent_lot")) if "reagent_lot" in samples.columns else F.col("_lotNumber"))
    for c in ("fragmentation", "resolution"):  # acquisition as the metadata states it
        if c in take:
            out = out.withColumn(c, F.coalesce(F.col(f"_{c}"), F.col(c)) if c in samples.columns else F.col(f"_{c}"))
    stated = [F.lit(None).cast("boolean")]
    if "isAssayControl" in take:
        stated.append(F.when(F.upper(F.trim("_isAssayControl")).isin("TRUE", "1", "YES"), True).when(F.upper(F.trim("_isAssayControl")).isin("FALSE", "0", "NO"), False))
    if "controlType" in take:
        stated.append(F.when(F.upper(F.trim("_controlType")) == "GIS", True))
    inferred = F.col("is_pool") if "is_pool" in samples.columns else F.lit(False)
    return out.withColumn("is_pool", F.coalesce(*stated, inferred)).drop(*[f"_{c}" for c in take])


def observed_platform(samples: DataFrame, declared: str | None = None) -> DataFrame:
    """One row per stratum: the platform's one name, or ``mixed per sample: a (n/N); ...``."""
    n = samples.where(F.col("platform").isNotNull()).groupBy("stratum_key", "platform").agg(F.count(F.lit(1)).alias("n"))
    parts = n.groupBy("stratum_key").agg(F.array_sort(F.collect_list(F.struct("platform", "n"))).alias("p"), F.sum("n").alias("total"))
    mixed = F.concat(F.lit("mixed per sample: "), F.array_join(F.transform("p", lambda x: F.concat(x["platform"], F.lit(" ("), x["n"].cast("string"), F.lit("/"), F.col("total").cast("string"), F.lit(")"))), "; "))
    name = F.when(F.size("p") == 1, F.col("p")[0]["platform"]).otherwise(mixed)
    return parts.select("stratum_key", F.coalesce(name, F.lit(declared)).alias("platform"), F.lit("A").alias("evidence"))


def qc_summary(rows: DataFrame, keys: list[str], flags: tuple[str, ...] = ("QC_Warning", "Distribution_QC", "Outliers_QC")) -> DataFrame:
    """Worst of each flag by keys: qc_status, qc_warn_count, qc_detail. Nulls are ignored."""
    worst = [F.bool_or(F.upper(F.trim(f)) != "PASS").alias(f) for f in flags]
    out = rows.groupBy(*keys).agg(*worst)
    bad = [F.coalesce(F.col(f), F.lit(False)) for f in flags]
    out = out.withColumn("qc_warn_count", sum((b.cast("int") for b in bad[1:]), bad[0].cast("int")))
    verdicts = F.concat_ws("|", *[F.when(b, "WARN").otherwise("PASS") for b in bad])
    detail = F.concat(F.lit("|".join(flags) + "="), verdicts)
    return out.withColumn("qc_detail", detail).withColumn("qc_status", F.when(any_of(*bad), F.lit("WARN")).otherwise(F.lit("PASS"))).drop(*flags)


def withdraw_plates(rows: DataFrame, plates: list[str], plate: str = "PlateID") -> tuple[DataFrame, DataFrame]:
    """(rows of other plates, one row of counts: samples withdrawn, persons that lose all samples)."""
    gone = F.coalesce(F.col(plate).isin(*plates), F.lit(False))
    kept = rows.where(~gone)
    withdrawn = rows.where(gone)
    lost = withdrawn.join(kept.select("participant_id").distinct(), "participant_id", "left_anti").agg(F.count_distinct("participant_id").alias("n_persons_lost"))
    counts = withdrawn.agg(F.count_distinct("sample_id").alias("n_samples")).withColumn("_l", F.lit(1)).join(lost.withColumn("_l", F.lit(1)), "_l").drop("_l")
    return kept, counts


def sample_files(samples: DataFrame, files: DataFrame) -> DataFrame:
    """One row for each pair of sample and matrix file of its stratum."""
    f = files.select("stratum_key", "file_id", "file_role")
    return samples.select("stratum_key", "specimen_id").join(f, "stratum_key", "left")


def with_sole_file(samples: DataFrame, files: DataFrame) -> DataFrame:
    """file columns on the sample where its stratum has exactly one matrix file, else null."""
    m = files.where("file_role = 'matrix'")
    n = m.groupBy("stratum_key").agg(F.count(F.lit(1)).alias("_n"))
    take = [c for c in FILE_COLUMNS if c in files.columns and c not in samples.columns]
    one = m.join(n.where("_n = 1").select("stratum_key"), "stratum_key", "left_semi").select("stratum_key", *take)
    return samples.join(one, "stratum_key", "left")


def _emitted(s: Stratum) -> dict[str, str | None]:
    """Columns of the contract that a declaration fills."""
    o, m, x = s.origin, s.material, s.method
    return {
        "study": o.study, "grant": o.grant, "cohort": o.cohort, "tissue": m.tissue, "biosample_type": m.kind, "anatomic_site": m.site, "value_scale": s.scale.name, "value_unit": s.scale.unit, "visit_name": s.visit,
        "assay_type": x.assay, "suspension_type": m.suspension, "analyte_type": m.analyte, "analysis_pipeline": x.pipeline.value, "array_type": x.array,
    }


def declared_columns(samples: DataFrame, strata: list[Stratum]) -> DataFrame:
    """Columns a stratum declares, by a join on a small dimension; a sample's own platform goes first."""
    spark = samples.sparkSession
    emitted = [_emitted(s) for s in strata]
    names = list(emitted[0]) if emitted else []
    rows = [(s.key, f"{s.key}:assay", s.method.platform.value, *e.values()) for s, e in zip(strata, emitted, strict=True)]
    dim = spark.createDataFrame(rows, "stratum_key string, assay_id string, _platform string, " + ", ".join(f"{n} string" for n in names))
    out = samples.drop(*[n for n in (*names, "assay_id") if n in samples.columns]).join(F.broadcast(dim), "stratum_key", "left")  # one row per stratum
    own = F.col("platform") if "platform" in samples.columns else F.lit(None).cast("string")
    return out.withColumn("platform", F.coalesce(own, F.col("_platform"))).drop("_platform").withColumn("assay_source_value", F.col("assay_type"))


def assay_table(strata: list[Stratum], spark) -> DataFrame:
    """One row for each stratum: what was measured and how."""
    rows = [(s.key, f"{s.key}:assay", s.method.assay, s.method.assay, s.method.platform.value, s.method.platform.grade, s.material.suspension, s.material.analyte, s.method.pipeline.value, s.method.pipeline.grade, s.origin.study, s.origin.grant, s.origin.cohort, s.material.tissue, s.material.kind, s.scale.name, s.scale.unit, s.scale.steps) for s in strata]
    return spark.createDataFrame(rows, "stratum_key string, " + ", ".join(f"{c} string" for c in (*ASSAY_COLUMNS[:4], "platform_evidence", *ASSAY_COLUMNS[4:], "pipeline_evidence", "study", "grant", "cohort", "tissue", "biosample_type", "value_scale", "value_unit", "transform_chain")))


def files_table(strata: list[Stratum], manifest: DataFrame, spark) -> DataFrame:
    """One row for each declared file, with what the manifest knows of it."""
    rows = []
    for s in strata:
        paths = s.source.files
        rows += [(s.key, f"{s.key}:{i}", p, "matrix", s.origin.study, s.origin.grant, f"{s.key}:assay", s.method.array, s.material.kind, s.material.tissue) for i, p in enumerate(paths)]
        if s.source.annotation:
            rows.append((s.key, f"{s.key}:annotation", s.source.annotation, "annotation", s.origin.study, s.origin.grant, f"{s.key}:assay", s.method.array, s.material.kind, s.material.tissue))
    names = ("stratum_key", "file_id", "relative_path", "file_role", "study", "grant", "assay_id", "array_type", "biosample_type", "tissue")
    out = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names))
    out = out.join(manifest.select("relative_path", "file_format", "file_size_bytes", "sha256"), "relative_path", "left")
    none = F.lit(None)
    return out.withColumns({"file_name": F.element_at(F.split("relative_path", "/"), -1), "species": F.lit("Homo sapiens"), "processing_status": F.lit("processed"), "analysis_type": none.cast("string"), "cell_type": none.cast("string"), "current_version": none.cast("string"), "created_on": none.cast("timestamp"), "modified_on": none.cast("timestamp"), "drs_id": none.cast("string")})
