"""Readers on tiny synthetic files, the manifest, and a build from files to an audited artifact."""

import gzip
import zipfile

import pytest
from pyspark.sql import functions as F

from strataloom.audit import measure
from strataloom.model import Donors, LayerSpec, Material, Method, Origin, QcStep, Scale, Source, Stated, Stratum
from strataloom.plans.build import build
from strataloom.sources import annotations as A
from strataloom.sources import manifest as M
from strataloom.sources import readers as R
from strataloom.sources.tabular import column_index, read_sheet_table, sheet_rows


def gz(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as f:
        f.write(text)
    return str(path)


def xlsx(path, rows):
    """A minimal workbook with shared strings, inline strings and numbers."""
    shared, body = [], []
    for i, row in enumerate(rows, 1):
        cells = []
        for j, v in enumerate(row):
            if v is None:
                continue
            ref = f"{chr(65 + j)}{i}"
            if isinstance(v, str):
                shared.append(v)
                cells.append(f'<c r="{ref}" t="s"><v>{len(shared) - 1}</v></c>')
            else:
                cells.append(f'<c r="{ref}"><v>{v}</v></c>')
        body.append(f'<row r="{i}">{"".join(cells)}</row>')
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{s.replace('|', '|')}</t></si>" for s in shared) + "</sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{''.join(body)}</sheetData></worksheet>")
    return str(path)


def stratum(reader, path, annot_path=None, extra=None):
    files = (path,) if isinstance(path, str) else tuple(path)
    return Stratum("s", "l", Origin("study", "g", "c"), Source(files, reader, annot_path, options=extra or {}))


def values(f):
    return {(r["feature_source_value"], r["specimen_source_value"]): r["value"] for r in f.cells.collect()}


def test_csv_matrix(spark, tmp_path):
    p = gz(tmp_path / "m.csv.gz", "id,S1,S2\nAPP|P05067,1.5,\nNA|P12345,x,NaN\n")
    f = R.read_stratum(spark, stratum("csv_matrix", p))
    assert values(f) == {("APP|P05067", "S1"): 1.5, ("APP|P05067", "S2"): None, ("NA|P12345", "S1"): None, ("NA|P12345", "S2"): None}
    assert [r["specimen_source_value"] for r in f.samples.orderBy("src_ordinal").collect()] == ["S1", "S2"]


def test_reporter_xlsx(spark, tmp_path):
    rows = [["note"], [], [], ["x"], ["h", "gene", "acc", "d", "S1", "S2"], ["1", "APP", "sp|P05067|A4_HUMAN", "d", 8, 0], ["2", None, None, "d", 4, 4], ["3", None, "sp|Q9H0H5|X", "d", -1, 2]]
    f = R.read_stratum(spark, stratum("reporter_xlsx", xlsx(tmp_path / "m.xlsx", rows)))
    assert values(f) == {("APP|sp|P05067|A4_HUMAN", "S1"): 3.0, ("APP|sp|P05067|A4_HUMAN", "S2"): None, ("|sp|Q9H0H5|X", "S1"): None, ("|sp|Q9H0H5|X", "S2"): 1.0}


def test_maxquant(spark, tmp_path):
    head = "Protein IDs\tMajority protein IDs\tReverse\tPotential contaminant\tOnly identified by site\tLFQ intensity b1_1\tLFQ intensity Pool_2\tIntensity x"
    p = gz(tmp_path / "m.txt.gz", head + "\nP05067\tP05067;P2\t\t\t\t8\t0\t1\nR\tREV\t+\t\t\t4\t4\t1\nQ9H0H5\t\t \t\t\t2\t4\t1\n")
    f = R.read_stratum(spark, stratum("maxquant", p))
    assert values(f) == {("P05067;P2", "b1_1"): 3.0, ("P05067;P2", "Pool_2"): None, ("Q9H0H5", "b1_1"): 1.0, ("Q9H0H5", "Pool_2"): 2.0}
    assert {r["specimen_source_value"]: (r["is_pool"], r["batch"]) for r in f.samples.collect()} == {"b1_1": (False, "b1"), "Pool_2": (True, "Pool")}
    assert f.notes["n_decoy_contaminant_dropped"].first()["n"] == 1


def test_pd_ratio(spark, tmp_path):
    cols = [f"Abundance Ratio: (F{p}, {c}) / (F{p}, 126)" for p in (1, 2) for c in ("127N", "128C")]
    head = "\t".join(["Accession", "Gene Symbol", *cols, "Abundance Ratio Adj. P-Value: (F1, 127N) / (F1, 126)"])
    p = gz(tmp_path / "m.txt.gz", head + "\nP1\tAPP\t2\t4\t8\t8\t0\nP2\tX\t2\t\t\t\t0\n\tnone\t1\t1\t1\t1\t0\n")
    f = R.read_stratum(spark, stratum("pd_ratio", p))
    v = values(f)
    # per-plex medians 1.5 and 3, centre 2.25
    assert v["APP|P1", "F1.127N"] == -1.25 and v["APP|P1", "F2.128C"] == 0.75 and v["X|P2", "F1.127N"] == 0.0 and v["X|P2", "F2.127N"] is None and len(v) == 8
    s = f.notes["structured_missingness"].first()
    assert (s["features_partial"], s["features_empty"], s["mean_plexes"]) == (1, 0, 1.5)


def test_srm(spark, tmp_path):
    p = gz(tmp_path / "m.txt.gz", "sample_id\tplate\tsubject.id\tisControl\tsample.type\tBIN1_3\ttau_PHF1_s404\nw1\t1\t1005.0\tFALSE\tsubjects\t1\t2\nw2\t1\tcontrol\tTRUE\tpool\t3\tx\n")
    f = R.read_stratum(spark, stratum("srm", p))
    assert values(f)["tau_PHF1_s404", "w2"] is None and values(f)["BIN1_3", "w1"] == 1.0
    assert {r["specimen_source_value"]: (r["person_source_value"], r["is_pool"]) for r in f.samples.collect()} == {"w1": ("1005", False), "w2": (None, True)}
    assert f.notes["control_wells_flagged"].first()["n_flagged"] == 1


def test_somascan(spark, tmp_path):
    p = gz(tmp_path / "m.csv.gz", "projid_visit,10-1,11-2,12-3\n1_0,1,2,3\n2_0,4,,6\n")
    meta = gz(tmp_path / "f.csv.gz", "SeqId,UniProt,EntrezGeneSymbol,Dilution,Organism,Type,ColCheck\n10-1,P05067,APP,20,Human,Protein,PASS\n10-1,Q0,DUP,20,Human,Protein,PASS\n11-2,Q9H0H5,RACGAP1,20,Human ,Protein,FLAG\n12-3,P1,X,20,Mouse,Protein,PASS\n")
    f = R.read_stratum(spark, stratum("somascan", p, extra={"feature_meta": meta}))
    assert values(f) == {("10-1", "1_0"): 1.0, ("10-1", "2_0"): 4.0, ("11-2", "1_0"): 2.0, ("11-2", "2_0"): None}
    assert {r["feature_source_value"]: r["gene_raw"] for r in f.features.collect()} == {"10-1": "APP", "11-2": "RACGAP1"}


PANEL = "sample_id,participant_id,UniProt,NPX,LOD,PlateID,Panel_Lot_Nr,QC_Warning,Distribution_QC,Outliers_QC,visit_month,MissingFreq\n"


def test_olink(spark, tmp_path):
    a = gz(tmp_path / "a.csv.gz", PANEL + "s1,p1,P1,1,0.5,A,L1,PASS,WARN,,0,0.1\ns1,p1,P1,3,0.5,A,L1,PASS,PASS,PASS,0,0.2\ns2,p2,P1,,0.7,A,L1,PASS,,pass,6,0.1\n")
    b = gz(tmp_path / "b.csv.gz", PANEL + "s1,p1,P2,9,1,A,L2,PASS,PASS,PASS,0,0.3\ns9,p9,P2,5,1,BAD,L2,PASS,PASS,PASS,0,0.3\ns1,p1,,5,1,A,L2,PASS,PASS,PASS,0,0.3\n")
    f = R.read_stratum(spark, stratum("olink", (a, b), extra={"panels": ["one", "two"], "withdrawn_plates": ["BAD"]}))
    got = {(r["feature_source_value"], r["specimen_source_value"]): (r["value"], r["lod"]) for r in f.cells.collect()}
    assert got == {("P1", "s1"): (2.0, 0.5), ("P1", "s2"): (None, 0.7), ("P2", "s1"): (9.0, 1.0)}
    s = {r["specimen_source_value"]: (r["qc_status"], r["qc_warn_count"], r["qc_detail"]) for r in f.samples.collect()}
    assert s == {"s1": ("WARN", 1, "QC_Warning|Distribution_QC|Outliers_QC=PASS|WARN|PASS"), "s2": ("PASS", 0, "QC_Warning|Distribution_QC|Outliers_QC=PASS|PASS|PASS")}
    assert {r["feature_source_value"]: (r["panel"], r["panel_lot_nr"], r["missing_freq"]) for r in f.features.collect()} == {"P1": ("one", "L1", 0.2), "P2": ("two", "L2", 0.3)}
    assert f.notes["withdrawn_samples"].first().asDict() == {"n_samples": 1, "n_persons_lost": 1}


def test_dia(spark, tmp_path):
    rows = ["sample_id,participant_id,UniProt,protein_abundance,visit_month"] + [f"s{i},p{i},P{k},8,12" for i in range(3) for k in range(3)] + ["s9,p9,P9,4,0", "s0,p0,P0,8,12"]
    f = R.read_stratum(spark, stratum("dia", gz(tmp_path / "m.csv.gz", "\n".join(rows) + "\n")))
    assert set(values(f).values()) == {3.0} and len(values(f)) == 9
    assert {r["specimen_source_value"] for r in f.samples.collect()} == {"s0", "s1", "s2"} and {r["feature_source_value"] for r in f.features.collect()} == {"P0", "P1", "P2"}
    d = f.notes["samples_dropped_low_completeness"].first()
    assert (d["n_dropped"], list(d["lowest_counts"])) == (1, [1])


def test_annotations(spark, tmp_path):
    traits = xlsx(tmp_path / "t.xlsx", [["ID", "individualID", "projID"], ["b1.126", "I1", None], ["b2.127N", "NA", "77"], ["b3.1", "GIS", ""]])
    got = {r["specimen_source_value"]: (r["person_source_value"], r["person_source_namespace_row"], r["batch"], r["channel"], r["is_pool"]) for r in A.dc_traits(spark, stratum("x", "", annot_path=traits)).collect()}
    assert got == {"b1.126": ("I1", "individualID", "b1", "126", False), "b2.127N": ("77", "projid", "b2", "127N", False), "b3.1": (None, None, "b3", "1", True)}
    bio = gz(tmp_path / "b.csv.gz", "individualID,specimenID,tissue,BrodmannArea,assay,exclude,excludeReason,sex\nD1,b1_1601_03,cortex,BA10,TMT,TRUE,swap,F\nD2,b1_1601_03,cortex,BA9,TMT,,,F\n")
    s = spark.createDataFrame([("b1_03_1601", 1), ("gis_1", 2)], "specimen_source_value string, src_ordinal int")
    frame = A.biospecimen(spark, stratum("x", "", annot_path=bio, extra={"key_rewrite": "plex_channel"}), s)
    got = {r["specimen_source_value"]: (r["person_source_value"], r["qc_status"], r["is_pool"], r["exclude_reason"]) for r in frame.collect()}
    assert got == {"b1_03_1601": ("D1", "EXCLUDED_BY_SOURCE", False, "swap"), "gis_1": (None, "not_assessed", True, None)}
    assert "sex" not in frame._jdf.queryExecution().executedPlan().toString()
    sheet = xlsx(tmp_path / "l.xlsx", [["Plex", "Channel", "ProjID", "Lot #"], ["3", "127_N", "55", "L"], ["3", "126", "9", "L"]])
    assert {r["specimen_source_value"]: (r["person_source_value"], r["is_pool"]) for r in A.labelling_sheet(spark, stratum("x", "", annot_path=sheet)).collect()} == {"F3.127N": ("55", False), "F3.126": (None, True)}
    assert column_index("AB12") == 27 and read_sheet_table(spark, sheet).count() == 2 and len(list(sheet_rows(open(sheet, "rb").read()))) == 3


def test_manifest_and_presence(spark, tmp_path):
    gz(tmp_path / "d/syn123/a.csv.gz", "x,y\n1,2\n3,4\n")
    (tmp_path / "d/b.csv").write_text("x,y\n1,2\n3,4\n")
    (tmp_path / "d/skip").mkdir()
    (tmp_path / "d/skip/c.txt").write_text("no")
    root = str(tmp_path / "d")
    m = {r["relative_path"]: r for r in M.file_manifest(spark, root, ("skip",)).collect()}
    assert set(m) == {"syn123/a.csv.gz", "b.csv"} and m["syn123/a.csv.gz"]["synapse_id"] == "syn123" and m["b.csv"]["n_rows"] == 2 and m["b.csv"]["n_cols"] == 2 and m["syn123/a.csv.gz"]["file_format"] == "csv.gz"
    index = M.content_index(spark, root, ("skip",))
    assert {tuple(r["paths"]) for r in index.collect()} == {("b.csv", "syn123/a.csv.gz")}
    md5 = index.first()["content_md5"]
    wanted = spark.createDataFrame([("o1", md5, "matrix", False), ("o2", "0" * 32, "matrix", True)], "object_id string, content_md5 string, kind string, critical boolean")
    assert [(r["object_id"], r["present"], r["held_as"]) for r in M.missing_objects(wanted, index).collect()] == [("o2", False, None), ("o1", True, "b.csv; syn123/a.csv.gz")]


def test_build_end_to_end(spark, tmp_path):
    import random

    rnd = random.Random(2)
    for k, (shift, n) in {"one": (0, 8), "two": (4, 7)}.items():
        rows = [",".join(["id", *[f"{k}{j}" for j in range(n)]])]
        for f in range(10):
            rows.append(",".join([f"G{f}|P{10000 + f}", *["" if f == 9 and j > 1 else f"{shift + rnd.gauss(0, 1):.4f}" for j in range(n)]]))
        rows.append(",".join(["DUP|P10000", *["1.0"] * n]))
        gz(tmp_path / f"in/{k}.csv.gz", "\n".join(rows) + "\n")
        gz(tmp_path / f"in/{k}_samples.csv.gz", "participant_id,sample_id,visit_month\n" + "".join(f"D{j},{k}{j},{j * 6}\n" for j in range(n - 1)) + f"Unknown,{k}{n - 1},0\n")
    strata = tuple(Stratum(k, "layer_a", Origin("study", f"grant_{k}", "c"), Source((f"{k}.csv.gz",), "csv_matrix", f"{k}_samples.csv.gz", "olink_samples"), Donors("study.id"), Material(site="superior temporal gyrus"), Scale("log2_ratio"), steps=(QcStep("features <50% missing", False, "doc"), QcStep("batch", True, "doc"))) for k in ("one", "two"))
    gz(tmp_path / "x.csv.gz", "projid,individualID,Study,sex\n1,I1,S,F\n2,,S,M\n")
    tracking = spark.createDataFrame([("one", "n_features", "9"), ("one", "n_samples", "~8?"), ("two", "site", "temporal"), ("three", "n_features", "1")], "tracking_row string, field string, tracking_value string")
    wanted = spark.createDataFrame([("o1", "0" * 32, "matrix", True)], "object_id string, content_md5 string, kind string, critical boolean")
    layers = [LayerSpec("layer_a", strata), LayerSpec("layer_b", deferred_reason="no data yet")]
    out = build(spark, layers, str(tmp_path / "in"), str(tmp_path / "out"), name="b1", crosswalk=str(tmp_path / "x.csv.gz"), wanted=wanted, tracking=tracking, document_claims=(("layer_a", "averaged", "readme", None, "not recorded"),))
    cells = spark.read.parquet(f"{out.path}/cells")
    assert {r["missing_reason"] for r in cells.select("missing_reason").distinct().collect()} == {0}
    assert cells.count() == 9 * (7 + 6) and "value_z" in cells.columns
    assert {x["layer_key"]: x["status"] for x in out.layers} == {"layer_a": "built", "layer_b": "deferred"}
    v = {(r["check"], r["subject"]): r["verdict"] for r in out.audit.collect()}
    assert v["row_key_unique", "layer_a"] == v["shape_consistency", "layer_a"] == v["tabs_bundle", "layer_a"] == v["return_boundary", "grant_one"] == v["z_decision", "layer_a"] == v["common_numeric_space", "layer_a"] == "PASS"
    assert v["unresolved_donor_dropped", "one"] == "FAIL" and v["brodmann_area", "one"] == "UNVERIFIABLE" and v["file_id_resolves", "layer_a"] == "PASS" and v["source_qc", "two"] == "UNVERIFIABLE"
    track = sorted((r["subject"], r["verdict"]) for r in out.audit.where("check = 'tracking'").collect())
    assert track == [("one", "FAIL"), ("one", "PASS"), ("three", "UNVERIFIABLE"), ("two", "PASS")] and v["readme", "layer_a"] == "UNVERIFIABLE"
    assert spark.read.parquet(f"{out.path}/person_crosswalk.parquet").collect()[0].asDict() == {"projid": "1", "individual_id": "I1", "study": "S"}
    s = spark.read.parquet(f"{out.path}/samples/layer_a.parquet")
    assert s.where(F.col("brodmann_area") == "BA22").count() == 13 and s.select("row_key").distinct().count() == 13
    assert (tmp_path / "out/b1/README.md").exists() and not list((tmp_path / "out").glob("_staging*"))
    with pytest.raises(OSError):
        build(spark, [LayerSpec("layer_b", deferred_reason="x")], str(tmp_path / "in"), str(tmp_path / "out"), name="b1")


@pytest.mark.parametrize("match", [0, 25, 59])
def test_audit_sees_every_site_and_every_count(spark, match):
    from strataloom.audit import checks

    samples = spark.createDataFrame([(f"place {k:02}" if k != match else f"place {k:02}, Temporal Gyrus",) for k in range(60)] + [(None,)], "anatomic_site_source string")
    none = F.lit(None).cast("string")
    samples = samples.withColumns({"stratum_key": F.lit("k"), "is_pool": F.lit(False), "person_id": none, "brodmann_area": none, "brodmann_area_evidence": none, "pmi_hours": F.lit(None).cast("double")})
    for stated, want in (("temporal gyrus", "PASS"), ("cerebellum", "FAIL")):
        st = Stratum("k", "l", Origin("s", "g", "c"), Source(("k.csv",), "csv_matrix"), material=Material(site=stated))
        seen = measure.by_stratum(measure.of_samples(samples, [st]))["k"] | {"sites": measure.sites(samples)["k"]}
        (got,) = checks.anatomic_site({"strata": [{"stratum": st} | seen]})
        assert want in tuple(got.values() if isinstance(got, dict) else got)
        assert "and 40 more" in str(got)
    assert measure.sites(samples.limit(0)) == {}
    counts = spark.createDataFrame([(f"flag {k:02}", 2) for k in range(60)], "flag string, n bigint")
    assert sum(measure.notes({"k": {"c": counts}})["k"]["c"].values()) == 120


def test_notes_of_all_strata_come_in_one_job(spark):
    """Values as each reader's frames hold them; several rows, or none, cannot be stated."""
    one = spark.createDataFrame([(3, None, [1, 2], True)], "a bigint, b string, c array<int>, d boolean")
    several, none = spark.createDataFrame([(1,), (2,)], "a int"), spark.createDataFrame([], "a int")
    flags = spark.createDataFrame([("x", 2), (None, 1), ("a", 5)], "flag string, n bigint")
    context = spark.sparkContext
    context.setJobGroup("notes", "notes")
    try:
        got = measure.notes({"p": {"row": one, "value": one.select("a"), "text": "long", "flags": flags}, "q": {"several": several, "none": none, "absent": None, "flags": flags.where("false")}, "r": {}})
        jobs = len(context.statusTracker().getJobIdsForGroup("notes"))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert got == {"p": {"row": {"a": 3, "b": None, "c": [1, 2], "d": True}, "value": 3, "text": "long", "flags": {"None": 1, "a": 5, "x": 2}}, "q": {"several": None, "none": None, "absent": None, "flags": {}}, "r": {}}
    assert list(got["p"]["flags"]) == ["None", "a", "x"] and jobs <= 5


def test_samples_keep_the_order_of_the_source(spark, tmp_path):
    """Row keys and replicates number by stratum and source row, not by name."""
    from strataloom.plans import build as B

    gz(tmp_path / "in/m.csv.gz", "id,Z9,A1,M5\n" + "".join(f"G{f}|P{10000 + f},{f},{f + 1},{f + 2}\n" for f in range(5)))
    f = R.read_stratum(spark, stratum("csv_matrix", str(tmp_path / "in/m.csv.gz")))
    o = B._source_order(f.samples, 3).orderBy("sample_ordinal").collect()
    assert [r["specimen_source_value"] for r in o] == ["Z9", "A1", "M5"] and {r["sample_ordinal"]["s"] for r in o} == {3}
    gz(tmp_path / "in/p.csv.gz", "UniProt,sample_id,participant_id,visit_month,PlateID,Panel_Lot_Nr,NPX,LOD,QC_Warning,Distribution_QC,Outliers_QC\nP1,z,1,0,p,l,1,0,PASS,PASS,PASS\nP1,b,2,0,p,l,2,0,PASS,PASS,PASS\n")
    g = R.read_stratum(spark, stratum("olink", [str(tmp_path / "in/p.csv.gz")]))
    both = B._source_order(g.samples, 0).select("specimen_source_value", "sample_ordinal").unionByName(B._source_order(f.samples, 1).select("specimen_source_value", "sample_ordinal"))
    assert [r[0] for r in both.orderBy("sample_ordinal").collect()] == ["z", "b", "Z9", "A1", "M5"]


def test_cross_assay_areas_reach_the_samples(spark, tmp_path):
    from strataloom.plans import build as B

    gz(tmp_path / "m.csv.gz", "id,s1,s2,s3\nG|P10000,1,2,3\n")
    gz(tmp_path / "a.csv.gz", "participant_id,sample_id,visit_month\nD1,s1,0\nD2,s2,0\nD3,s3,0\n")
    gz(tmp_path / "b.csv.gz", "individualID,specimenID,tissue,BrodmannArea,assay,samplingAge\nD1,s1,cortex,BA4,TMT,90\nD2,s2,cortex,,TMT,90\nD3,s3,cortex,,TMT,90\nD2,r2,cortex,BA10,rnaSeq,90\nD3,r3,cerebellum,BA1,rnaSeq,90\n")
    st = Stratum("s", "l", Origin("x", "g", "c"), Source(("m.csv.gz",), "csv_matrix", "a.csv.gz", "olink_samples", {"biospecimen_meta": "b.csv.gz", "biospecimen_assay": "TMT"}), material=Material(site="somewhere"))
    h = B.harmonise(spark, st, str(tmp_path))
    got = {r["specimen_source_value"]: (r["brodmann_area"], r["brodmann_area_evidence"]) for r in h.samples.collect()}
    assert got == {"s1": ("BA4", "source"), "s2": ("BA10", "propagated"), "s3": (None, None)}


def test_source_qc_is_decided_by_what_was_measured(spark):
    from strataloom.audit import checks

    steps = (("Reverse / contaminant rows removed", False, "d"), ("log2 transform", False, "d"), ("centring", False, "d"), ("batch correction", True, "d"), ("features <50% missing removed", True, "d"), ("GIS channels removed", True, "d"))
    st = Stratum("s", "l", steps=tuple(QcStep(*x) for x in steps))
    rows = lambda notes, **kw: [r[4] for r in checks.source_qc({"strata": [{"stratum": st, "notes": notes} | kw]})]
    assert rows({"n_decoy_contaminant_dropped": 3, "transform": "log2", "n_features_dropped": 0}, n_pool=0) == ["PASS", "PASS", "FAIL", "UNVERIFIABLE", "PASS", "PASS"]
    assert rows({"n_features_dropped": 4}, n_pool=2) == ["FAIL", "FAIL", "FAIL", "UNVERIFIABLE", "FAIL", "FAIL"]
    assert rows({}) == ["FAIL", "FAIL", "FAIL", "UNVERIFIABLE", "UNVERIFIABLE", "UNVERIFIABLE"]


def test_conflicts_and_exclusions_reach_the_audit(spark):
    from strataloom.audit import checks

    st = Stratum("s", "l", source=Source(options={"ms_order": "MS2"}), method=Method(platform=Stated("Orbitrap")))
    c = {"strata": [{"stratum": st, "platforms_observed": {"Exploris": 4}, "acquisition_observed": {"resolution": {"30000": 4}}, "notes": {"exclusions": {"n_flagged": 1, "n_specimens": 4}, "n_features_dropped_empty": 2}}], "filled_columns": {"l": {"panel": 0, "lod": 0}, "m": {"x": 3}}}
    got = {(r[0], r[1], r[4]) for f in (checks.declared_conflict, checks.qc_metadata, checks.exclusions, checks.columns) for r in f(c)}
    assert {("cde_conflict", "s", "FAIL"), ("cde_conflict", "s", "UNVERIFIABLE"), ("source_exclusion", "s", "PASS"), ("features_dropped_empty", "s", "FAIL"), ("column_union_fill", "l", "PASS"), ("column_union_fill", "m", "FAIL")} <= got


def test_long_cells_reader(spark, tmp_path):
    """Plates, completeness and empty features of a long delivery; what it lacks leaves no note."""
    base = str(tmp_path / "d")
    cells = [(f"P1000{f}", s, float(f) if f < n else None, 1.5) for s, n in (("a", 4), ("b", 1), ("c", 3), ("gone", 4)) for f in range(5)] + [("P10000", "unknown sample", 1.0, None), ("P10001", "c", float("nan"), None)]
    spark.createDataFrame(cells, "feature_source_value string, specimen_source_value string, value double, lod double").write.parquet(base + "/cells")
    samples = [("a", "1", "P1", True, 0, 1), ("b", "2", "P1", False, 1, 2), ("c", None, None, False, 0, 3), ("gone", "4", "P0", False, 0, 4)]
    spark.createDataFrame(samples, "specimen_source_value string, person_source_value string, plate_id string, is_pool boolean, qc_warn_count int, src_ordinal bigint").write.parquet(base + "/samples")
    spark.createDataFrame([(f"P1000{f}", f"P1000{f}", "PASS", f) for f in range(6)], "feature_source_value string, uniprot_raw string, colcheck string, src_ordinal bigint").write.parquet(base + "/features")
    f = R.read_stratum(spark, stratum("long_cells", base, extra={"withdrawn_plates": ["P0"], "min_sample_completeness": 0.5}))
    assert {r[0] for r in f.samples.select("specimen_source_value").collect()} == {"a", "c"}
    assert sorted((r["feature_source_value"], r["specimen_source_value"]) for r in f.cells.where("value is not null").collect()) == sorted([(f"P1000{k}", s) for s, n in (("a", 4), ("c", 3)) for k in range(n)])
    assert {r[0] for r in f.features.select("feature_source_value").collect()} == {f"P1000{k}" for k in range(4)}
    assert f.notes["withdrawn_samples"].first().asDict() == {"n_samples": 1, "n_persons_lost": 1}
    assert f.notes["samples_dropped_low_completeness"].first().asDict() == {"n_dropped": 1, "lowest_counts": [1]}
    assert f.notes["n_features_dropped_empty"].first()[0] == 2 and f.notes["control_wells_flagged"].first().asDict() == {"n_flagged": 1, "n_samples": 3}
    assert {r["qc_warn_count"]: r["n"] for r in f.notes["n_samples_by_warn_count"].collect()} == {0: 2} and f.notes["colcheck_counts"].first()["n"] == 4
    spark.read.parquet(base + "/samples").drop("qc_warn_count", "is_pool", "plate_id").write.parquet(str(tmp_path / "e/samples"))
    for part in ("cells", "features"):
        spark.read.parquet(f"{base}/{part}").drop("colcheck").write.parquet(str(tmp_path / f"e/{part}"))
    g = R.read_stratum(spark, stratum("long_cells", str(tmp_path / "e")))
    assert g.samples.count() == 4 and set(g.notes) == {"source_form", "n_features_dropped_empty", "sample_level_qc_in_deposit"}


def test_dropped_samples_list_the_lowest_only(spark):
    rows = [("s", f"x{i}", i, 40, i / 40, i >= 20) for i in range(40)]
    found = spark.createDataFrame(rows, "stratum_key string, specimen_id string, n_detected bigint, n_features bigint, detection_rate double, kept boolean")
    assert R.dropped_samples(found).first().asDict() == {"n_dropped": 20, "lowest_counts": [0, 1, 2, 3, 4]}
    assert R.dropped_samples(found.where("kept")).first().asDict() == {"n_dropped": 0, "lowest_counts": []}


def test_content_of_other_sizes_is_never_hashed(spark, tmp_path):
    """Plain and packed copies by size; an empty file, a short one, and one whose trailer is none."""
    import hashlib

    root = tmp_path / "in"
    root.mkdir()
    files = {"a.txt": b"x" * 500, "b.txt": b"y" * 500, "c.txt": b"z" * 501, "empty": b"", "two": b"\x1f\x8b", "d.bin": bytes(range(256)) * 9}
    for name, raw in files.items():
        (root / name).write_bytes(raw)
    for name in ("a.txt", "c.txt", "d.bin"):
        with gzip.open(root / f"{name}.gz", "wb") as f:
            f.write(files[name])
    sizes = spark.createDataFrame([(500,), (500,), (None,), (2304,)], "size_bytes bigint")
    got = {r["content_md5"]: list(r["paths"]) for r in M.content_index(spark, str(root), sizes=sizes).collect()}
    md5 = lambda n: hashlib.md5(files[n]).hexdigest()
    assert got == {md5("a.txt"): ["a.txt", "a.txt.gz"], md5("b.txt"): ["b.txt"], md5("d.bin"): ["d.bin", "d.bin.gz"]}
    # what is hashed: the candidates alone
    content = spark.read.format("binaryFile").load(str(root)).select("path", "length", "content")
    assert sorted(r["path"].rpartition("/")[2] for r in M._candidates(content, sizes).select("path").collect()) == ["a.txt", "a.txt.gz", "b.txt", "d.bin", "d.bin.gz"]
    big = spark.createDataFrame([((1 << 32) + 500,)], "size_bytes bigint")  # a trailer holds the size modulo 2^32
    assert [r["path"].rpartition("/")[2] for r in M._candidates(content, big).select("path").collect()] == ["a.txt.gz"]
    assert len(M.content_index(spark, str(root)).where("content_md5 is not null").collect()) >= 4
