"""Work that must not grow faster than its input: what is computed once, and what no task or driver holds."""

import duckdb
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from strataloom.operators import layer, ranking, stats, wide
from strataloom.plans import build, file_queries
from strataloom.plans.registry import ORACLE_SQL, QUERIES
from strataloom.sinks import writers
from strataloom.sources import tables as T


def by_sql(sf, name, df):
    """Rows of a query and of its SQL, in one order."""
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    columns = ", ".join(f'"{c}"' for c in df.columns)
    return sorted(map(str, (tuple(r) for r in df.collect()))), sorted(map(str, con.execute(f"SELECT {columns} FROM ({ORACLE_SQL[name]})").fetchall()))


def test_ordered_samples_are_written_by_many_tasks(spark, sf, monkeypatch):
    written, inner = [], file_queries._delimited
    monkeypatch.setattr(file_queries, "_delimited", lambda df, name, sep=",": written.append(inner(df, name, sep)) or written[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got, want = by_sql(sf, "read_olink_samples", QUERIES["read_olink_samples"](spark, sf))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == want
    assert spark.read.text(written[0]).select(F.input_file_name()).distinct().count() > 1


def counted_cells(spark, n_rows=900, n_features=3):
    """Cells whose rows count each time they are computed, and the counter."""
    seen = spark.sparkContext.accumulator(0)

    def count(i):
        seen.add(1)
        return float(i * 7919 % 1000)

    value = F.udf(count, "double").asNondeterministic()  # no filter repeats it
    rows = spark.range(n_rows).select(F.lit("s").alias("stratum_key"), (F.col("id") % n_features).cast("string").alias("feature_key"), F.col("id").cast("string").alias("specimen_id"), (F.col("id") % 2).alias("plex"), value("id").alias("value"))
    return rows, seen


def test_statistics_of_large_features_compute_the_cells_once(spark, monkeypatch):
    monkeypatch.setattr(ranking, "ACCURACY", 100)
    for figure in (stats.feature_stats, stats.percentiles, stats.centre_on_plexes):
        cells, seen = counted_cells(spark)
        assert figure(cells).count() > 0 and seen.value == 900, figure


def test_layers_share_one_join_of_lines(spark, sf, monkeypatch):
    calls, inner = [], T.lines
    monkeypatch.setattr(T, "lines", lambda *a: calls.append(a) or inner(*a))
    got, want = by_sql(sf, "layer_policy", QUERIES["layer_policy"](spark, sf))
    assert got == want and len(calls) == 1


def test_bundles_of_more_specimens_than_columns_are_blocks(spark, sf, monkeypatch):
    monkeypatch.setattr(wide, "MAX_COLUMNS", 100)
    monkeypatch.setattr(wide, "BLOCK", 64)
    monkeypatch.setattr(wide, "BATCH_BLOCKS", 3)
    schemas, inner = [], wide.wide_rows
    monkeypatch.setattr(wide, "wide_rows", lambda *a: schemas.append(a) or inner(*a))
    got, want = by_sql(sf, "wide_bundle_orders", QUERIES["wide_bundle_orders"](spark, sf))
    assert got == want and not schemas


def exchanged(df, column):
    """The exchanges of a plan, not broadcasts, that deal rows by this column."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and f"{column}#" in line]


def test_dense_rows_are_laid_out_without_an_exchange(spark, sf):
    df = QUERIES["merge_layer_dense"](spark, sf)
    got, want = by_sql(sf, "merge_layer_dense", df)
    assert got == want
    assert not exchanged(df, "specimen_id")


def test_a_merge_of_cells_exchanges_cells_and_samples_only(spark, sf):
    cells = T.two_runs(spark, sf).withColumn("note", F.lit("kept")).localCheckpoint()
    samples = T.samples_of(cells).unionByName(spark.createDataFrame([("F", "without cells")], "stratum_key string, specimen_id string"))
    status = layer.kept_features(cells, samples)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = layer.merge(cells, samples, status)
        rows = {(r["stratum_key"], r["specimen_id"], r["feature_key"]): (r["value"], r["note"], r["missing_reason"]) for r in df.collect()}
        assert not [x for x in exchanged(df, "specimen_id") if "feature_key#" in x]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    state = {(r["stratum_key"], r["feature_key"]): r["status"] for r in status.collect()}
    union = {f for (_, f), s in state.items() if s == "kept"}
    values = {(r["stratum_key"], r["specimen_id"], r["feature_key"]): r["value"] for r in cells.collect()}
    want = {}
    for s, p in samples.collect():
        for f in union:
            v = values.get((s, p, f)) if state.get((s, f)) == "kept" else None
            want[s, p, f] = (v, None if v is None else "kept", 0 if v is not None else {"kept": 1, "qc_dropped": 3, None: 2}[state.get((s, f))])
    assert rows == want and len(rows) == df.count()


def test_layers_come_together_by_customer_once(spark, sf):
    assert len(exchanged(T.layers(spark, sf), "o_custkey")) == 1
    got, want = by_sql(sf, "stratum_similarity", QUERIES["stratum_similarity"](spark, sf))
    assert got == want


def test_lines_are_dealt_over_the_sessions_partitions(spark, sf):
    for cells in (T.cohorts, T.two_runs, T.mixed_scales):
        assert cells(spark, sf).rdd.getNumPartitions() == 4, cells
        assert len([x for x in exchanged(cells(spark, sf), "l_orderkey") if "REPARTITION_BY_NUM" in x]) == 1, cells
    for name in ("feature_stats", "audit_rows"):
        got, want = by_sql(sf, name, QUERIES[name](spark, sf))
        assert got == want, name


def test_row_groups_of_blocks_hold_few_rows(spark, tmp_path, monkeypatch):
    """A reader's batch of 4,096 rows of 4,096 values would not fit a task."""
    monkeypatch.setattr(wide, "MAX_COLUMNS", 5)
    monkeypatch.setattr(wide, "BLOCK", 4)
    monkeypatch.setattr(wide, "BATCH_BLOCKS", 3)
    cells = spark.range(40 * 9).select((F.col("id") % 40).cast("string").alias("feature_key"), F.floor(F.col("id") / 40).cast("string").alias("specimen_id"), F.col("id").cast("double").alias("value"))
    samples = spark.range(9).select(F.col("id").cast("string").alias("specimen_id"), F.col("id").cast("string").alias("row_key"), F.col("id").alias("sample_ordinal"))
    info = writers.write_bundle(cells, samples, cells.select("feature_key").distinct(), str(tmp_path), False)
    for name in ("matrix", "blocks"):
        files = [pq.ParquetFile(f).metadata for f in (tmp_path / f"{name}.parquet").glob("*.parquet")]
        assert max(m.row_group(i).num_rows for m in files for i in range(m.num_row_groups)) <= 3, name
    got = {(r["feature_key"], r["specimen_id"], r["value"]) for r in writers.bundle_cells(spark, str(tmp_path), info).collect()}
    assert got == {(str(i % 40), str(i // 40), float(i)) for i in range(360)}


def test_a_build_keeps_no_dense_layer_and_no_cells_of_a_layer_that_is_written(spark, sf, monkeypatch):
    dense, parts = [], []
    merge, harmonise, cells, returns = build.L.merge, build.harmonise, build.Wr.write_cells, build.Wr.write_returns
    monkeypatch.setattr(build.L, "merge", lambda *a: dense.append(merge(*a)) or dense[-1])
    monkeypatch.setattr(build, "harmonise", lambda *a: parts.append(harmonise(*a)) or parts[-1])

    def written(df, *a):
        assert not df.storageLevel.useMemory
        return cells(df, *a)

    def returned(*a):
        assert len(parts) == 2 and not any(x.storageLevel.useMemory for p in parts for x in (p.cells, p.samples, p.features, p.status))
        return returns(*a)

    monkeypatch.setattr(build.Wr, "write_cells", written)
    monkeypatch.setattr(build.Wr, "write_returns", returned)
    got, want = by_sql(sf, "samples_of_a_build", QUERIES["samples_of_a_build"](spark, sf))
    assert got == want and len(dense) == 1 and not dense[0].storageLevel.useMemory
