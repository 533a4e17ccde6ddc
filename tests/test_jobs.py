"""The jobs: two runs over growing copies of the tables, reruns, settings, refusals."""

import json
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from jobs import common, delivery_inventory, grant_returns

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def plain_inventory(docs):
    """By dictionaries: (doc_id, delivery, size_bytes, n_words, n_holders, first_doc_id, is_copy)."""
    held = {}
    for i, text, *_ in docs:
        held.setdefault(text or "", []).append(i)
    out = []
    for i, text, _, source, *_ in docs:
        ids = held[text or ""]
        first = min((x for x in ids if x is not None), default=None)
        words = (text or "").translate({c: " " for c in range(9, 14)}).split(" ")
        out.append((i, source or "unstated", len((text or "").encode()), sum(bool(w) for w in words), len(ids), first, i != first))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "delivery", "size_bytes", "n_words", "n_holders", "first_doc_id", "is_copy").collect()), key=str)


def test_inventory_takes_only_what_is_new(spark, tmp_path, caplog):
    first = [(1, "a b", "en", "web", 3), (2, "c d\te", "en", "web", 5), (5, None, "de", None, 0), (None, "a b", "en", "", 3)]
    second = [(0, "a b", "en", "books/x=1", 3), (7, "", "en", "web", 0), (2, "c d\te", "en", "web", 5)]
    source, out = str(tmp_path / "in" / "documents.parquet"), str(tmp_path / "out")
    run = lambda: delivery_inventory.run(spark, source, out, str(tmp_path / "mark"))
    spark.createDataFrame(first, DOCS).write.parquet(source)
    with caplog.at_level("INFO"):
        assert found(run()) == plain_inventory(first)
        assert "read 4 new documents" in caplog.text
        spark.createDataFrame(second, DOCS).repartition(2).write.mode("append").parquet(source)
        caplog.clear()
        out_rows = run()
        grown = rows(out_rows)
        assert found(out_rows) == plain_inventory(first + second)
        assert "read 3 new documents" in caplog.text
        caplog.clear()
        assert rows(run()) == rows(spark.read.parquet(f"{out}/inventory")) == grown
        assert "read 0 new documents" in caplog.text and "nothing new after batch 1" in caplog.text


def test_only_deliveries_that_hold_new_contents_are_renewed(spark, tmp_path):
    source, out, mark = str(tmp_path / "documents.parquet"), str(tmp_path / "out"), str(tmp_path / "mark")
    first = [(1, "x", "en", "a", 1), (2, "y", "en", "b", 1), (3, "z", "en", "c", 1)]
    spark.createDataFrame(first, DOCS).write.parquet(source)
    delivery_inventory.run(spark, source, out, mark)
    files = lambda d: sorted(p.name for p in (tmp_path / "out" / "inventory" / f"delivery={d}").iterdir())
    before = {d: files(d) for d in "abc"}
    second = [(0, "x", "en", "d", 1), (9, "new", "en", "c", 1)]
    spark.createDataFrame(second, DOCS).write.mode("append").parquet(source)
    assert found(delivery_inventory.run(spark, source, out, mark)) == plain_inventory(first + second)
    assert {d: files(d) == before[d] for d in "abc"} == {"a": False, "b": True, "c": False}
    # the mark was lost after the inventory was written: the same partitions are written again
    delivery_inventory.update(spark, f"{out}/manifest", f"{out}/inventory", f"{out}/other-mark")
    assert found(spark.read.parquet(f"{out}/inventory")) == plain_inventory(first + second)


def test_inventory_of_the_given_table_and_wanted_objects(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = docs.where("text IS NOT NULL").orderBy("doc_id").first()
    wanted = [("o1", text["text"], "file", True), ("o2", "never delivered", "file", True), ("o3", "neither", "note", False)]
    spark.createDataFrame(wanted, "object_id string, t string, kind string, critical boolean").withColumn("content_md5", F.md5("t")).drop("t").write.parquet(str(tmp_path / "wanted"))
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"wanted": str(tmp_path / "wanted"), "files_per_batch": 1}))
    out = delivery_inventory.run(spark, f"{sf}/documents.parquet", str(tmp_path / "out"), str(tmp_path / "mark"), str(config))
    assert found(out) == plain_inventory([tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()])
    got = {r["object_id"]: (r["present"], r["held_as"]) for r in spark.read.parquet(str(tmp_path / "out" / "presence")).collect()}
    assert got["o1"][0] and f"/{text['doc_id']}" in got["o1"][1]
    assert got["o2"] == got["o3"] == (False, None)


def test_a_run_that_stopped_between_the_steps_is_mended(spark, tmp_path):
    source, out, mark = str(tmp_path / "documents.parquet"), str(tmp_path / "out"), str(tmp_path / "mark")
    docs = [(1, "x", "en", "web", 1), (2, "x", "en", "web", 1)]
    spark.createDataFrame(docs, DOCS).write.parquet(source)
    delivery_inventory.take_new(spark, source, f"{out}/manifest", mark, delivery_inventory.SETTINGS)
    assert found(delivery_inventory.run(spark, source, out, mark)) == plain_inventory(docs)


def test_empty_delivery(spark, tmp_path):
    source = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(1, "x", "en", "web", 1)], DOCS).where("false").write.parquet(source)
    more = [(3, "y", "en", "web", 1)]
    spark.createDataFrame(more, DOCS).write.mode("append").parquet(source)
    assert found(delivery_inventory.run(spark, source, str(tmp_path / "out"), str(tmp_path / "mark"))) == plain_inventory(more)


def test_returns_are_the_same_after_a_rerun_and_renewed_by_grant(spark, sf, tmp_path, caplog):
    out, config = str(tmp_path / "out"), tmp_path / "c.json"
    config.write_text(json.dumps({"min_complete": 0.2, "min_present": 0.1}))
    with caplog.at_level("INFO"):
        before = rows(grant_returns.run(spark, sf, out, str(config)))
    assert before and "0 of other grants" in caplog.text
    assert rows(grant_returns.run(spark, sf, out, str(config))) == before
    config.write_text(json.dumps({"min_complete": 0.2, "min_present": 0.1, "grants": ["ASIA"]}))
    assert rows(grant_returns.run(spark, sf, out, str(config))) == before
    assert {r["grant"] for r in spark.read.parquet(f"{out}/returns").select("grant").distinct().collect()} == {"AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"}


def test_foreign_specimens_stop_the_returns(spark, sf, tmp_path):
    out, config = str(tmp_path / "out"), tmp_path / "c.json"
    config.write_text(json.dumps({"min_complete": 0.2, "min_present": 0.1}))
    df = grant_returns.run(spark, sf, out, str(config))
    df.where("grant = 'ASIA'").limit(1).withColumn("grant", F.lit("EUROPE")).write.mode("append").partitionBy("grant").parquet(f"{out}/returns")
    with pytest.raises(ValueError, match="EUROPE"):
        grant_returns.verify(spark, sf, out)


def test_a_grant_without_features_stops_the_job(spark, sf, tmp_path):
    config = tmp_path / "c.json"
    config.write_text(json.dumps({"min_present": 1.1}))
    with pytest.raises(ValueError, match="no feature is left"):
        grant_returns.run(spark, sf, str(tmp_path / "out"), str(config))


def test_unknown_settings_are_refused(spark, tmp_path):
    config = tmp_path / "c.json"
    config.write_text('{"min_presnt": 0.5}')
    with pytest.raises(ValueError, match="min_presnt"):
        common.read_config(spark, str(config), grant_returns.SETTINGS)


def test_command_line(sf, tmp_path):
    """The module as a program, twice, with its own session."""
    config = tmp_path / "c.json"
    config.write_text('{"files_per_batch": 5}')
    call = [sys.executable, "-m", "jobs.delivery_inventory", "--input", f"{sf}/documents.parquet", "--output", str(tmp_path / "out"), "--checkpoint", str(tmp_path / "mark"), "--config", str(config)]
    first, second = (subprocess.run(call, capture_output=True, text=True, check=True).stderr for _ in range(2))
    assert "read 0 new documents" not in first and "wrote" in first and "documents," in first
    assert "read 0 new documents" in second and "nothing new" in second


def test_jobs_do_not_need_the_llm_subpackage():
    code = "import sys; import jobs.delivery_inventory, jobs.grant_returns; sys.exit(any('llm' in m or m == 'corpus_pipeline' for m in sys.modules))"
    assert subprocess.run([sys.executable, "-c", code], check=False).returncode == 0
