"""The build: declared layers in, audited tables out.

Stages for each layer: read strata, attach annotation, identity and files, resolve and filter
features, decide the layer's policy, transform and scale, merge, gate, write, audit on what was
written. The driver sees scalars only: a few rows a stratum for the policy, keys and the audit.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.audit import checks, measure
from strataloom.functions import expr as E
from strataloom.model import MIN_PRESENT, LayerSpec, Stratum, StratumFrames
from strataloom.operators import contract, stats
from strataloom.operators import features as FE
from strataloom.operators import layer as L
from strataloom.operators import policy as P
from strataloom.operators import samples as S
from strataloom.operators.lineage import staged
from strataloom.operators.lookups import coalesce_annotation
from strataloom.sinks import writers as Wr
from strataloom.sources import annotations as A
from strataloom.sources import manifest as M
from strataloom.sources import readers as R


@dataclass
class Harmonised:
    """A stratum after identity, resolution, filter and collapse."""

    stratum: Stratum
    cells: DataFrame
    samples: DataFrame
    features: DataFrame
    status: DataFrame
    notes: dict = field(default_factory=dict)


@dataclass
class BuildResult:
    path: str
    layers: list[dict]
    audit: DataFrame
    summary: dict


def read(spark: SparkSession, s: Stratum, root: str) -> StratumFrames:
    """A stratum's frames with annotation, assay metadata, donors and intervals, in that order."""
    paths = s.source.files
    at = lambda p: p if "://" in p or p.startswith("/") else f"{root.rstrip('/')}/{p}"
    extra = {k: at(v) if k in ("feature_meta", "assay_meta", "biospecimen_meta") and isinstance(v, str) else v for k, v in s.source.options.items()}
    s = replace(s, source=replace(s.source, files=tuple(at(p) for p in paths), annotation=at(s.source.annotation) if s.source.annotation else None, options=extra))
    f = R.read_stratum(spark, s)
    samples = f.samples
    if s.source.annotation_reader:
        annotation = A.ANNOTATION_READERS[s.source.annotation_reader](spark, s, samples)
        samples = coalesce_annotation(samples, annotation.drop("src_ordinal"))
    if extra.get("assay_meta") and extra.get("assay_meta_key"):
        samples = S.attach_assay_metadata(samples, A.assay_metadata(spark, extra["assay_meta"]), extra["assay_meta_key"])
    if extra.get("biospecimen_meta"):
        direct, f.other_specimens = A.biospecimen_sites(spark, extra["biospecimen_meta"], extra.get("biospecimen_assay"))
        samples = coalesce_annotation(samples, direct)
    if s.source.annotation_reader == "biospecimen":
        f.notes["exclusions"] = samples.agg(F.count_if(F.col("qc_status") == "EXCLUDED_BY_SOURCE").alias("n_flagged"), F.count(F.lit(1)).alias("n_specimens"))
    if "is_pool" not in samples.columns:
        samples = samples.withColumn("is_pool", F.lit(False))
    before = samples
    samples = S.drop_unresolved(samples, s.donors.resolvable)
    f.notes["unresolved"] = before.select("specimen_source_value").join(samples.select("specimen_source_value"), "specimen_source_value", "left_anti")
    source = extra.get("pmi")
    if source and source.get("path"):
        lookup = A.interval_lookup(spark, at(source["path"]), source["key"], source["column"])
        samples, f.notes["pmi"] = S.attach_interval(samples.withColumn("person_source_value", E.source_id("person_source_value")), lookup, source.get("unit"))
    else:
        samples, f.notes["pmi"] = S.attach_interval(samples, None, reason=(source or {}).get("reason", "source_not_acquired"))
    f.cells = f.cells.join(samples.select("specimen_source_value"), "specimen_source_value", "left_semi")
    f.stratum, f.samples = s, samples
    return f


def harmonise(spark: SparkSession, s: Stratum, root: str, reference: DataFrame | None = None, collapse: bool = True) -> Harmonised:
    f = read(spark, s, root)
    key = F.lit(s.key)
    feats = FE.resolve(f.features, s.source.reader, reference).withColumn("stratum_key", key)
    feats = FE.with_feature_key(feats)
    samples = f.samples.withColumn("stratum_key", key)
    for c in ("visit_month", "visit_index"):
        if c not in samples.columns:
            samples = samples.withColumn(c, F.lit(None).cast("int"))
    samples = S.with_visits(S.with_identity(samples, s.donors.namespace))
    samples = S.brodmann_fill(samples, s.material.site, f.other_specimens, ("_donor", "anatomic_site_source")).drop("_donor")
    named = feats.where(F.col("feature_key").isNotNull())
    cells = f.cells.join(named.select("feature_source_value", "feature_key"), "feature_source_value")
    cells = cells.join(samples.select("specimen_source_value", "specimen_id"), "specimen_source_value").select(key.alias("stratum_key"), "feature_key", "specimen_id", "value", "lod")
    status = L.kept_features(cells, samples, MIN_PRESENT)
    kept = status.where("status = 'kept'")
    own = cells.join(kept.select("feature_key"), "feature_key", "left_semi")
    kept_feats = named.join(kept.select("feature_key"), "feature_key", "left_semi")
    if collapse:
        own, kept_feats = FE.collapse(own, kept_feats)
        status = status.where("status <> 'kept'").unionByName(kept_feats.select("stratum_key", "feature_key", F.lit("kept").alias("status")))
    flags = FE.below_lod_features(own.where(F.col("lod").isNotNull() | F.col("value").isNotNull())).drop("n_below", "n_values")
    kept_feats = kept_feats.join(flags, ["stratum_key", "feature_key"], "left")
    return Harmonised(s, own.persist(), samples.persist(), kept_feats.persist(), status.persist(), f.notes | _filter_notes(status, cells, kept_feats))


def _filter_notes(status: DataFrame, cells: DataFrame, features: DataFrame) -> dict:
    """What the presence filter dropped, and the features flagged for values below their limits: null where
    the stratum has no limits."""
    dropped = status.agg(F.count_if(F.col("status") != "kept").alias("n"))
    limits = cells.agg(F.max(F.col("lod").isNotNull()).alias("_any"))
    flagged = features.agg(F.count("lod_flag").alias("n")).join(limits.where("_any"), F.lit(True), "left_semi")
    return {"n_features_dropped": dropped, "lod_flags": flagged}


def _source_order(samples: DataFrame, rank: int) -> DataFrame:
    """samples with sample_ordinal instead of src_ordinal: stratum, part, file, split and row of the source,
    in one type for every reader."""
    o, kind = F.col("src_ordinal"), samples.schema["src_ordinal"].dataType.simpleString()
    part = F.lit(0)
    if kind.startswith("struct<p:"):
        part, o, kind = o["p"].cast("int"), o["o"], kind.split(",o:", 1)[1]
    place = (o["f"], o["s"], o["i"]) if kind.startswith("struct<f:") else (F.lit(""), F.lit(0).cast("bigint"), o.cast("bigint"))
    fields = [c.alias(n) for c, n in zip((F.lit(rank), part, *place), "spfbi", strict=True)]
    return samples.withColumn("sample_ordinal", F.struct(*fields)).drop("src_ordinal")


def build(
    spark: SparkSession, registry: list[LayerSpec], root: str, out: str, reference: DataFrame | None = None, name: str | None = None, bundles: bool = True,
    crosswalk: str | None = None, wanted: DataFrame | None = None, tracking: DataFrame | None = None, document_claims: tuple = (),
) -> BuildResult:
    """Builds every layer of the registry into out/<name>; nothing appears there until all is written.

    reference: uniprot and symbol of features; crosswalk: path of a donor id bridge; wanted: objects
    whose presence is decided by content (with size_bytes, only files of those sizes are hashed); tracking: numbers and sites that a sheet states.
    """
    name = name or f"build-{date.today():%Y%m%d}-{uuid.uuid4().hex[:8]}"
    earlier = Wr.previous_builds(spark, out, "build-")
    staging = f"{out.rstrip('/')}/_staging-{name}"
    manifest = M.file_manifest(spark, root).persist()
    context: dict = {"strata": [], "layers": [], "sample_columns": {}, "feature_columns": {}, "filled_columns": {}}
    entries, all_samples, all_features, held = [], [], [], [manifest]
    for spec in registry:
        if not spec.strata:
            entries.append({"layer_key": spec.key, "status": "deferred", "reason": spec.deferred_reason or "no strata declared"})
            continue
        parts = [harmonise(spark, s, root, reference, spec.collapse_duplicates) for s in spec.strata]
        for p in parts:
            L.guard_features(p.features.count(), p.stratum.key)
        context["strata"] += measure.strata(parts)
        cells = L.union_all([p.cells for p in parts])
        declared = {p.stratum.key: p.stratum.scale.name for p in parts}
        policy = P.decide(spec.key, cells, declared, stored=True)
        scaled = P.apply(cells, policy)
        own = [x for p in parts for x in (p.cells, p.samples, p.features, p.status)]
        samples = L.union_all([_source_order(p.samples, i) for i, p in enumerate(parts)])
        files = S.files_table(list(spec.strata), manifest, spark)
        samples = S.with_sole_file(S.declared_columns(samples, list(spec.strata)), files)
        samples = S.replicate_index(S.row_key(samples)).withColumn("layer_key", F.lit(spec.key)).persist()
        features = L.feature_union(L.union_all([p.features.drop("src_ordinal") for p in parts]), [p.stratum.key for p in parts]).persist()
        status = L.union_all([p.status for p in parts])
        merged = L.merge(scaled, samples, status)
        contract.scope_gate([*merged.columns, *samples.columns, *features.columns])
        if bundles:  # else they are read once
            merged = staged(merged)
        Wr.write_cells(merged, staging, spec.key)
        Wr.emit(L.union_all([S.assay_table(list(spec.strata), spark)]), f"{staging}/assay/{spec.key}")
        Wr.emit(S.sample_files(samples, files.where("file_role = 'matrix'")), f"{staging}/sample_files/{spec.key}")
        Wr.emit(files, f"{staging}/files/{spec.key}")
        back = spark.read.parquet(f"{staging}/cells/layer_key={spec.key}")
        keys = samples.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_key").alias("k")).first()
        shape = back.agg(F.count_distinct("feature_key").alias("f"), F.count_distinct("stratum_key", "specimen_id").alias("s")).first()
        n_features = features.count()
        layer = {
            "layer": spec.key, "policy": policy, "policy_again": P.decide(spec.key, back.select("stratum_key", "feature_key", "specimen_id", F.col("value").cast("double").alias("value")).where("value is not null"), declared, stored=True), "n_rows": keys["n"], "n_keys": keys["k"], "n_features": n_features, "shape": (shape["f"], shape["s"]),
            "numeric_space": P.numeric_space(scaled, policy).first().asDict(), "surfaces": _surfaces(back, cells, policy), "file_ids": _file_ids(samples, files),
        }
        if bundles:
            info = Wr.write_bundle(merged, samples, features, f"{staging}/bundles/{spec.key}", policy.z_applied)
            shape = Wr.bundle_shape(spark, f"{staging}/bundles/{spec.key}", info)
            layer["bundle"] = {"n_features": shape[0], "n_specimens": shape[1], "n_sample_rows": spark.read.parquet(f"{staging}/bundles/{spec.key}/samples.parquet").count(), "n_feature_rows": spark.read.parquet(f"{staging}/bundles/{spec.key}/features.parquet").count(), "surface": info["value_surface"]}
        context["layers"].append(layer)
        for x in own:  # nothing of another layer reads them
            x.unpersist()
        entries.append({"layer_key": spec.key, "status": "built", "n_features": n_features, "n_samples": keys["n"], "policy": json.dumps(policy.as_dict())})
        held += [samples, features]
        all_samples.append((spec, samples))
        all_features.append((spec, features))
    if all_samples:
        names = L.column_union([s for _, s in all_samples])
        contract.scope_gate(names)
        fnames = L.column_union([f for _, f in all_features])
        for spec, s in all_samples:
            Wr.emit(Wr.conform(s.drop("sample_ordinal"), [c for c in (*spec.columns("samples"), *names) if c != "sample_ordinal"]), f"{staging}/samples/{spec.key}", tsv=False)
            written = spark.read.parquet(f"{staging}/samples/{spec.key}.parquet")
            context["sample_columns"][spec.key] = written.columns
            filled = [c for c in written.columns if c not in s.columns]
            context["filled_columns"][spec.key] = written.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in filled]).first().asDict() if filled else {}
        for spec, f in all_features:
            Wr.emit(Wr.conform(f, fnames), f"{staging}/features/{spec.key}", tsv=False)
            context["feature_columns"][spec.key] = spark.read.parquet(f"{staging}/features/{spec.key}.parquet").columns
        everyone = L.union_all([s.drop("sample_ordinal") for _, s in all_samples])
        context["returns"] = [r.asDict() for r in Wr.write_returns(everyone, f"{staging}/returns").groupBy("grant").agg(F.sum("n_specimens").alias("n_specimens"), F.sum("n_foreign").alias("n_foreign")).collect()]
        context["undeclared"] = contract.undeclared(names, registry)
    inventory = _inventory(spark, context["strata"])
    tables = {"file_manifest": manifest, "derived_inventory": inventory}
    if crosswalk:
        Wr.emit(A.crosswalk(spark, crosswalk), f"{staging}/person_crosswalk")
    if wanted is not None:
        tables["missing_objects"] = M.missing_objects(wanted, M.content_index(spark, root, sizes=wanted if "size_bytes" in wanted.columns else None))
    if tracking is not None:
        diff = M.tracking_diff(tracking, M.measured_rows(inventory, tracking)).persist()
        tables["tracking_diff"] = diff
        context["tracking"] = [r.asDict() for r in diff.collect()]  # as long as the sheet
    context["document_claims"] = document_claims
    Wr.write_manifest(spark, staging, entries)
    audit = checks.run(spark, context).persist()
    summary = checks.summarise(audit).first().asDict()
    Wr.write_inventory(tables | {"audit": audit}, f"{staging}/inventory")
    from strataloom.report import render

    Wr.write_text(spark, f"{staging}/README.md", render(name, entries, summary, audit, context))
    Wr.write_text(spark, f"{staging}/build_report.json", json.dumps({"name": name, "previous": earlier[-1] if earlier else None, "layers": entries, "audit": summary}, indent=1))
    Wr.publish(spark, staging, f"{out.rstrip('/')}/{name}")
    for x in held:
        x.unpersist()
    return BuildResult(f"{out.rstrip('/')}/{name}", entries, audit, summary)


def _inventory(spark: SparkSession, strata: list[dict]) -> DataFrame:
    """One row for each stratum: what the build measured."""
    rows = [(s["stratum"].layer, s["stratum"].key, s["stratum"].origin.study, s["stratum"].material.site, s["n_features"], s["n_nonpool"] + s["n_pool"], s["n_resolved"], s["n_pool"], s["pct_missing"], s.get("p1"), s.get("p99")) for s in strata]
    schema = "layer_key string, stratum_key string, study string, site string, n_features bigint, n_samples bigint, n_resolved bigint, n_pool bigint, pct_missing double, p1 double, p99 double"
    return M.derived_inventory(spark.createDataFrame(rows, schema))


def _surfaces(back: DataFrame, cells: DataFrame, policy: P.Policy) -> list[dict]:
    """What the audit needs of the written cells: centre and spread of Z, or how many values are not the source's."""
    if policy.z_applied:
        z = stats.feature_stats(back.select("stratum_key", "feature_key", F.col("value_z").cast("double").alias("value")), stored=True)
        before = "value_t" if "value_t" in back.columns else "value"
        normal = stats.scale_diagnostics(back.select("stratum_key", "feature_key", F.col(before).cast("double").alias("value")), stored=True)
        out = z.groupBy("stratum_key").agg(F.median("median").alias("z_median"), F.median("sd").alias("z_sd")).join(normal.select("stratum_key", "median_abs_skew", "normality_ok"), "stratum_key", "left")
        return [r.asDict() for r in out.collect()]
    key = ["stratum_key", "feature_key", "specimen_id"]
    written = back.where("value is not null").select(*key, F.col("value").alias("_v"))  # a row that is not there counts as one without a value
    both = cells.where("value is not null").join(written, key, "left")
    return [r.asDict() for r in both.groupBy("stratum_key").agg(F.count_if(~F.col("_v").eqNullSafe(F.col("value").cast("float"))).alias("n_changed")).collect()]


def _file_ids(samples: DataFrame, files: DataFrame) -> dict:
    j = samples.select("file_id").join(files.select("file_id", F.lit(True).alias("_k")).distinct(), "file_id", "left")
    return j.agg(F.count("file_id").alias("n_present"), F.count_if(F.col("file_id").isNull()).alias("n_null"), F.count_if(F.col("file_id").isNotNull() & F.col("_k").isNull()).alias("n_unresolved")).first().asDict()
