"""Expressions, statistics, policy, merge, keys: hand-computed cases and invariants."""

import math
from statistics import NormalDist

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataloom.functions import expr as E
from strataloom.model import LayerSpec, Method, Origin, QcStep, Source, Stated, Stratum, load_registry
from strataloom.operators import contract, lookups, stats
from strataloom.operators import features as FE
from strataloom.operators import layer as L
from strataloom.operators import policy as P
from strataloom.operators import samples as S
from strataloom.sources import manifest as M

CELLS = "stratum_key string, feature_key string, specimen_id string, value double, lod double"


def one(spark, rows, schema, *cols):
    return [r[0] if len(cols) == 1 else tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_safe_log2(spark):
    got = one(spark, [(8.0,), (0.0,), (-1.0,), (None,), (float("nan"),), (float("inf"),)], "v double", E.safe_log2("v"))
    assert got == [3.0, None, None, None, None, None]


def test_identifiers(spark):
    got = one(spark, [(" PD-1 ",), ("1005.0",), ("Unknown",), ("",), (None,), ("12.5",), ("NaN",)], "v string", E.source_id("v"))
    assert got == ["PD-1", "1005", None, None, None, "12.5", None]


def test_key_rewrites(spark):
    assert one(spark, [("b1_03_1601",), ("b7r2_03_1752",), ("x",)], "v string", E.plex_channel_key("v")) == ["b1_1601_03", "r2b7_1752_03", "x"]
    assert one(spark, [("site_b1_001_11",), ("x",)], "v string", E.prefixed_key("v")) == ["b1_001", "x"]


def test_below_lod_is_tri_state(spark):
    assert one(spark, [(None, 1.0), (1.0, None), (1.0, 2.0), (3.0, 2.0)], "v double, l double", E.below_lod("v", "l")) == [None, False, True, False]


def test_lod_flag_bounds(spark):
    assert one(spark, [(0.25,), (0.5,), (0.24,)], "f double", E.lod_flag("f")) == ["gt25pct_below_lod", "gt50pct_below_lod", "ok"]


def test_average_rank(spark):
    d = spark.createDataFrame([("a", v) for v in (1.0, 2.0, 3.0, 3.0, 3.0)], "k string, v double")
    assert sorted(r[0] for r in d.select(E.average_rank("v", "k")).collect()) == [1.0, 2.0, 4.0, 4.0, 4.0]


def test_norm_ppf(spark):
    ps = [1e-12, 1e-6, 0.01, 0.075, 0.2, 0.5, 0.77, 0.925, 0.99, 1 - 1e-9]
    got = one(spark, [(p,) for p in [*ps, 0.0, 1.0]], "p double", E.norm_ppf("p"))
    assert all(math.isclose(g, NormalDist().inv_cdf(p), rel_tol=1e-12, abs_tol=1e-12) for g, p in zip(got, ps)) and got[-2:] == [None, None]


def cells(spark, rows):
    return spark.createDataFrame([(*r, None) if len(r) == 4 else r for r in rows], CELLS)


def test_presence_is_inclusive_and_uses_samples(spark):
    c = cells(spark, [("s", "f", str(i), 1.0) for i in range(3)] + [("s", "g", str(i), 1.0) for i in range(2)])
    s = spark.createDataFrame([("s", str(i)) for i in range(6)], "stratum_key string, specimen_id string")
    assert {r["feature_key"]: r["kept"] for r in stats.presence(c, s).collect()} == {"f": True, "g": False}


def test_stats_equal_numpy(spark):
    rng = np.random.default_rng(7)
    x = rng.lognormal(size=(4, 25))
    x[1, :10] = np.nan
    c = cells(spark, [("s", f"f{i}", str(j), None if np.isnan(x[i, j]) else float(x[i, j])) for i in range(4) for j in range(25)])
    for r in stats.feature_stats(c).collect():
        v = x[int(r["feature_key"][1])]
        v = v[~np.isnan(v)]
        assert r["n"] == len(v) and math.isclose(r["mean"], v.mean()) and math.isclose(r["sd"], v.std(ddof=1)) and math.isclose(r["median"], np.median(v))
        assert math.isclose(r["skew"], (((v - v.mean()) / v.std(ddof=1)) ** 3).mean(), rel_tol=1e-9)


def test_single_value_has_no_z(spark):
    z = P.zscore(cells(spark, [("s", "f", "1", 5.0), ("s", "g", "1", 2.0), ("s", "g", "2", 2.0)])).collect()
    assert all(r["value_z"] is None for r in z)


def test_rank_transform_needs_four(spark):
    c = cells(spark, [("s", "a", str(i), float(i)) for i in range(3)] + [("s", "b", str(i), float(i * i)) for i in range(4)] + [("s", "b", "x", None)])
    got = {(r["feature_key"], r["specimen_id"]): r["value_t"] for r in P.rank_inverse_normal(c).collect()}
    assert all(got["a", str(i)] is None for i in range(3)) and got["b", "x"] is None
    assert all(math.isclose(got["b", str(i)], NormalDist().inv_cdf((i + 1 - 0.375) / 4.25), rel_tol=1e-12) for i in range(4))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=4, max_size=30, unique=True))
def test_rank_transform_keeps_order(spark, values):
    c = cells(spark, [("s", "f", str(i), v) for i, v in enumerate(values)])
    rows = sorted(P.rank_inverse_normal(c).collect(), key=lambda r: r["value"])
    t = [r["value_t"] for r in rows]
    assert all(a < b for a, b in zip(t, t[1:]))


def layer_cells(spark, shift=0.0, scale=1.0, skew=False):
    rng = np.random.default_rng(1)
    rows = []
    for k, (m, sd) in {"s1": (0.0, 1.0), "s2": (shift, scale)}.items():
        for f in range(12):
            v = rng.normal(f * 0.01, 1.0, 40)
            v = np.exp(2 * v) if skew else v
            rows += [(k, f"f{f}", f"{k}:{j}", float(m + sd * x)) for j, x in enumerate(v)]
    return cells(spark, rows)


def test_policy_native_z_and_rank(spark):
    same = P.decide("x", layer_cells(spark))
    assert not same.z_applied and set(same.transforms.values()) == {"none"}
    far = P.decide("x", layer_cells(spark, 5.0, 4.0), {"s1": "log2", "s2": "log2"})
    assert far.z_applied and far.label_vs_data
    skewed = P.decide("x", layer_cells(spark, 500.0, 9.0, True))
    assert skewed.z_applied and set(skewed.transforms.values()) == {"rank_int"}
    c = layer_cells(spark, 500.0, 9.0, True)
    out = P.apply(c, skewed)
    assert out.select("value").exceptAll(c.select("value")).count() == 0  # native values stay
    r = out.where("value_z is not null").groupBy("stratum_key", "feature_key").agg(F.avg("value_z").alias("m"), F.stddev_samp("value_z").alias("s")).collect()
    assert all(abs(x["m"]) < 1e-9 and abs(x["s"] - 1) < 1e-9 for x in r)
    back = out.select(F.max(F.abs(F.col("value_z") * F.col("z_scale") + F.col("z_center") - F.col("value_t")))).first()[0]
    assert back < 1e-9
    assert P.numeric_space(out, skewed).first()["verified"]


def test_merge_reasons(spark):
    c = cells(spark, [("s1", "a", "1", 1.0), ("s1", "a", "2", None), ("s1", "b", "1", 1.0), ("s2", "b", "3", 2.0), ("s2", "c", "3", 3.0)])
    s = spark.createDataFrame([("s1", "1"), ("s1", "2"), ("s2", "3")], "stratum_key string, specimen_id string")
    status = spark.createDataFrame([("s1", "a", "kept"), ("s1", "b", "qc_dropped"), ("s2", "b", "kept"), ("s2", "c", "kept")], "stratum_key string, feature_key string, status string")
    m = L.merge(c, s, status)
    got = {(r["stratum_key"], r["specimen_id"], r["feature_key"]): (r["value"], r["missing_reason"]) for r in m.collect()}
    assert got == {
        ("s1", "1", "a"): (1.0, 0), ("s1", "2", "a"): (None, 1), ("s1", "1", "b"): (None, 3), ("s1", "2", "b"): (None, 3), ("s1", "1", "c"): (None, 2), ("s1", "2", "c"): (None, 2),
        ("s2", "3", "a"): (None, 2), ("s2", "3", "b"): (2.0, 0), ("s2", "3", "c"): (3.0, 0),
    }
    dense = {tuple(r) for r in m.groupBy("stratum_key", "missing_reason").count().collect()}
    assert dense == {tuple(r) for r in L.reason_counts(s, c, status).collect()}


def test_collapse_keeps_first_key(spark):
    f = spark.createDataFrame([("s", "P1__a", "P1", "a", 1, None), ("s", "P1__b", "P1", "b", 2, "G"), ("s", "P2", "P2", "c", 3, None)], "stratum_key string, feature_key string, feature_id string, feature_source_value string, src_ordinal int, gene_symbol string")
    c = cells(spark, [("s", "P1__a", "1", 1.0), ("s", "P1__b", "1", 3.0), ("s", "P1__b", "2", 5.0), ("s", "P2", "1", 7.0)])
    out, meta = FE.collapse(c, f)
    assert {(r["feature_key"], r["specimen_id"], r["value"]) for r in out.collect()} == {("P1__a", "1", 2.0), ("P1__a", "2", 5.0), ("P2", "1", 7.0)}
    assert {(r["feature_key"], r["gene_symbol"], r["n_collapsed"]) for r in meta.collect()} == {("P1__a", "G", 2), ("P2", None, 1)}
    assert {r["feature_key"] for r in FE.collapse(c, f, rekey=True)[0].collect()} == {"P1", "P2"}


@pytest.mark.parametrize("reader,value,extra,want", [
    ("csv_matrix", "APP|P05067", {}, ("P05067", "APP")), ("csv_matrix", "NA|P1", {}, ("P1", None)), ("reporter_xlsx", "APP|sp|P05067|A4_HUMAN", {}, ("P05067", "APP")),
    ("maxquant", "CON__x;P05067-2;Q9H0H5", {}, ("P05067", None)), ("srm", "tau_PHF1_s404", {}, ("P10636", "MAPT")), ("srm", "bA38", {}, ("P05067", "bA38")), ("srm", "BIN1_3", {}, ("O00499", "BIN1")),
    ("somascan", "seq.1", {"uniprot_raw": "P05067 Q9H0H5", "gene_raw": "APP"}, ("P05067", "APP")), ("olink", "x", {"uniprot_raw": "odd"}, ("odd", None)), ("dia", "P10636", {"uniprot_raw": "P10636"}, ("P10636", "MAPT")),
])
def test_resolution(spark, reader, value, extra, want):
    ref = spark.createDataFrame([("P10636", "MAPT", 1), ("O00499", "BIN1", 2), ("Q0", "BIN1", 3)], "uniprot string, symbol string, src_ordinal int")
    names = ["feature_source_value", *extra]
    f = spark.createDataFrame([(value, *extra.values())], ", ".join(f"{n} string" for n in names))
    r = FE.resolve(f, reader, ref).first()
    assert (r["feature_id"], r["gene_symbol"]) == want


def samples(spark, rows):
    return spark.createDataFrame(rows, "person_global_key string, anatomic_site string, visit_month int, visit_index int, stratum_key string, sample_ordinal int")


def test_row_key_parts(spark):
    key = lambda rows: [r["row_key"] for r in S.row_key(samples(spark, rows)).orderBy("sample_ordinal").collect()]
    assert key([("p:1", "a", None, None, "s", 1), ("p:2", "a", None, None, "s", 2)]) == ["p:1", "p:2"]
    assert key([("p:1", "a b", 12, None, "s", 1), (None, None, None, None, "s", 2), ("p:1", "c", 12, None, "s", 3)]) == ["p:1|a-b|M12", "UNRESOLVED|NA", "p:1|c|M12"]
    assert key([("p:1", "a", None, 1, "s", 1), ("p:1", "a", None, 1, "t", 2)]) == ["p:1|V1|s", "p:1|V1|t"]
    assert key([("p:1", "a", None, None, "s", 2), ("p:1", "a", None, None, "s", 1), ("p:2", "a", None, None, "s", 3)]) == ["p:1|R1", "p:1|R2", "p:2"]


def test_unit_inference():
    assert S.infer_unit(6.5) == ("hours", False) and S.infer_unit(400) == ("minutes", False) and S.infer_unit(9000)[0] is None and S.infer_unit(60)[1] and S.infer_unit(None) == (None, False)


def test_unique_lookup_raises(spark):
    left, right = spark.createDataFrame([("a",)], "k string"), spark.createDataFrame([("a", 1), ("a", 2)], "k string, v int")
    with pytest.raises(Exception, match="repeated key"):
        lookups.lookup_unique(left, right, ["k"]).collect()
    assert lookups.lookup_unique(left, right.where("v = 1"), ["k"]).collect()[0]["v"] == 1


def test_scope_gate():
    assert contract.denied(["reagent_lot", "age.at.visit", "page_id", "value", "msex"]) == ["age.at.visit", "page_id", "msex"]
    with pytest.raises(contract.ScopeError):
        contract.scope_gate(["sex"])


def test_zero_features_stop():
    with pytest.raises(ValueError, match="no feature is left"):
        L.guard_features(0, "s")


def test_registry_loads(tmp_path):
    p = tmp_path / "r.json"
    p.write_text('[{"key": "l", "strata": [{"key": "s", "origin": {"study": "x", "grant": "g", "cohort": "c"}, "source": {"files": ["m.csv"], "reader": "csv_matrix", "options": {"panels": ["p"]}}, "method": {"platform": {"value": "Orbitrap", "grade": "A"}}, "steps": [{"name": "log2", "upstream": false, "reference": "doc"}]}]}, {"key": "later", "deferred_reason": "no data"}]')
    a, b = load_registry(str(p))
    assert isinstance(a, LayerSpec) and b.deferred_reason
    assert a.strata[0] == Stratum("s", "l", Origin("x", "g", "c"), Source(("m.csv",), "csv_matrix", options={"panels": ["p"]}), method=Method(platform=Stated("Orbitrap", "A")), steps=(QcStep("log2", False, "doc"),))
    p.write_text('[{"key": "l", "strata": [{"key": "s", "oops": 1}]}]')
    with pytest.raises(ValueError, match="unknown fields"):
        load_registry(str(p))
    p.write_text('[{"key": "l", "strata": [{"key": "s", "origin": {"oops": 1}}]}]')
    with pytest.raises(ValueError, match="l.strata.origin: unknown fields"):
        load_registry(str(p))
    p.write_text('[{"key": "l", "strata": [{"key": "s"}]}, {"key": "m", "strata": [{"key": "s"}]}]')
    with pytest.raises(ValueError, match="unique"):
        load_registry(str(p))


def test_stated_int(spark):
    assert one(spark, [("~1,200?",), ("12.0",), ("twelve",), (None,)], "v string", M.stated_int(F.col("v"))) == [1200, 12, None, None]


def test_column_pruning_reaches_the_scan(spark, sf):
    plan = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").agg(F.sum("l_quantity"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in plan


def test_streaming_figures(spark, sf, tmp_path):
    from strataloom.streaming import incremental

    src = spark.read.parquet(f"{sf}/events.parquet")
    src.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    cells_ = stream.select(F.lit("e").alias("stratum_key"), F.col("event_type").alias("feature_key"), "value")
    for _ in range(2):  # a second run finds nothing new
        incremental.start(cells_, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {r["feature_key"]: (r["n"], round(r["mean"], 9), round(r["sd"], 6)) for r in incremental.figures(spark, str(tmp_path / "out")).collect()}
    want = {r["event_type"]: (r["n"], round(r["m"], 9), round(r["s"], 6)) for r in src.groupBy("event_type").agg(F.count("value").alias("n"), F.avg("value").alias("m"), F.stddev_samp("value").alias("s")).collect()}
    assert got == want


def test_percentiles_equal_sorting(spark):
    import numpy as np

    from strataloom.operators import stats

    rnd = np.random.default_rng(2)
    sets = {"a": rnd.normal(size=30_011), "b": np.round(rnd.random(5000), 2), "c": np.array([3.0]), "d": np.array([1.0, 2.0]), "e": np.repeat([1.0, 7.0], 501), "f": np.r_[rnd.random(999), 1e12]}
    rows = [(k, float(v)) for k, x in sets.items() for v in x] + [("a", None), ("none", None)]
    got = {r["stratum_key"]: (r["p1"], r["p50"], r["p99"]) for r in stats.percentiles(spark.createDataFrame(rows, "stratum_key string, value double").repartition(7)).collect()}
    assert set(got) == set(sets)
    for k, x in sets.items():
        assert got[k] == pytest.approx(tuple(np.quantile(x, [0.01, 0.5, 0.99])), rel=1e-12, abs=1e-12), k


def test_plan_guard_sees_what_is_read_and_not_what_is_pruned(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    other = pages.select("url").distinct()
    fine = [pages.select("url"), pages.groupBy("url").count(), pages.join(other, "url").select("html"), pages.drop("page_id"), spark.range(3)]
    for df in fine:
        assert contract.guarded(df) is df
    pages.createOrReplaceTempView("guarded_pages")
    assert sorted(contract.read_columns(spark.sql("SELECT url FROM guarded_pages WHERE length(url) > (SELECT avg(length(html)) FROM guarded_pages)"))) == ["html", "url"]
    hidden = "SELECT url FROM guarded_pages WHERE length(url) > (SELECT avg(page_id) FROM guarded_pages)"
    for df in (pages, pages.where("page_id > 3").select("url"), pages.groupBy("url").agg({"page_id": "max"}), pages.orderBy("page_id").select("url"), spark.sql(hidden)):
        with pytest.raises(contract.ScopeError, match="page_id"):
            contract.guarded(df)
    # refused by the plan alone: the file is gone, and nothing tries to open it
    copy = str(tmp_path / "gone.parquet")
    pages.write.parquet(copy)
    df = spark.read.parquet(copy)
    for f in (tmp_path / "gone.parquet").glob("part-*"):
        f.unlink()
    with pytest.raises(contract.ScopeError):
        contract.guarded(df)
