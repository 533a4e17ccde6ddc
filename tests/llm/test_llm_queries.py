"""Every registered query of the subpackage on the small tables, against DuckDB where SQL can say it."""

import duckdb
import pytest

import corpus_pipeline
from strataloom.llm import chat_format, spotsigs, token_rollup
from strataloom.llm.queries import ORACLE_SQL, QUERIES

TABLES = ("documents", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


def rows(columns, data):
    return sorted((tuple("" if v is None else repr(v) for v in r) for r in data), key=str), columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = [tuple(r[c] for c in cols) for r in df.collect()]
    assert got
    if name in ORACLE_SQL:
        want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE_SQL[name]})").fetchall()
        assert rows(cols, got) == rows(cols, want)


@pytest.mark.parametrize("name,sql,keys", [("op8_chat_format", chat_format.OP8_INPUT_SQL, ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]), ("op2_spot_fingerprints", spotsigs.OP2_TEXT_SQL, ["doc_id", "n_chars", "edited_sha256"]),
                                           ("op6_token_counts", token_rollup.OP6_COUNT_SQL, ["source", "lang", "tokenizer", "n_docs", "n_words", "n_chars"])])
def test_sql_part(spark, sf, con, name, sql, keys):
    got = {tuple(r[k] for k in keys) for r in QUERIES[name](spark, sf).select(*keys).collect() if r[keys[0]] != -1}
    assert got == set(con.execute(f"SELECT {', '.join(keys)} FROM ({sql})").fetchall())


def stages(spark, docs, sf):
    """Output of each stage but the last, by name."""
    out = {}
    for k, f in corpus_pipeline.STAGES[:-1]:
        docs = out[k] = f(spark, docs, sf).cache()
    return out


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_join", "decontaminate", "mix_sources"]
    n = docs.count()
    for k, out in stages(spark, docs, sf).items():
        assert out.columns == names, k
        assert 0.8 * n < out.count() <= n, k
        docs = out
    out = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert out.count() == docs.count()
    assert corpus_pipeline.run(spark, sf).count() == docs.count()


def test_pipeline_removes_near_copies_and_keeps_the_rest(spark, sf="/root/testdata/sf0.01"):
    """Of the documents that the near-duplicate join finds before line dedup nine in ten are gone after
    both stages, of the others hardly any; no text that is left is without words unless it had none."""
    from strataloom.llm import ngram_join

    found = stages(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    joined = ngram_join.join(found["toxicity"], corpus_pipeline.SHINGLE, corpus_pipeline.NUMERATOR, corpus_pipeline.DENOMINATOR).collect()
    left = {r["doc_id"]: r["text"] for r in found["ngram_join"].collect()}
    copies = [r["doc_id"] for r in joined if r["component_id"] != r["doc_id"]]
    others = [r["doc_id"] for r in joined if r["component_id"] == r["doc_id"]]
    assert len(copies) > 10 and sum(i not in left for i in copies) >= 0.9 * len(copies)
    assert sum(i in left for i in others) >= 0.995 * len(others)
    had = {r["doc_id"]: r["text"] for r in found["toxicity"].collect()}
    assert all((left[i] or "").split() or not (had[i] or "").split() for i in left)


def test_pipeline_equals_brute_force(spark, tmp_path):
    """A small corpus with nulls, repeats, ties and clashing columns: every stage by hand."""
    from pyspark.sql import functions as F

    from tests.llm.test_llm_ops import brute_components, edited, words

    base, item = words(71, 80), words(72, 30)
    line = lambda k: "\n".join(" ".join(words(k * 10 + j, 9)) for j in range(6))
    rows = [(i, line(i) + (" awfulword nastyword" if i % 9 == 4 else ""), f"s{i % 3}") for i in range(60)]
    rows += [(100, line(7), "s0"), (101, line(7) + "\nmore in it", "s1"), (102, None, "s1"), (103, "", None), (102, None, "s1")]
    rows += [(200 + k, edited(base, k, k % 3), "s2") for k in range(6)]  # one line each: line dedup sees equal ones only
    rows += [(300, "so " + " ".join(item) + " end", "s0"), (None, line(3), "s0"), (301, line(301), "s2"), (301, line(302), "s2")]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    d = spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], schema)
    for c in ("_id", "_dropped", "_gone", "_gone_text", "_bad", "_toxicity", "node", "k1", "item_id", "a.b"):
        d = d.withColumn(c, F.lit(1))
    d.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i % 9 == 4)) for i in range(60)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, " ".join(item)), (2, None)], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    found = stages(spark, docs, str(tmp_path))
    texts = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    assert all(x.columns == docs.columns for x in found.values())
    clean = [(i, t) for i, t, _ in rows if "awfulword" not in (t or "")]
    assert texts(found["toxicity"]) == sorted(clean, key=str)
    # lines
    keys = {}
    for i, t in clean:
        for x in (t or "").split("\n"):
            k = x.strip(" \t\n\x0b\x0c\r").lower()
            if i is not None and len(k) >= 10:
                keys.setdefault(k, set()).add(i)
    kept = []
    for i, t in clean:
        ls = (t or "").split("\n")
        own = [x for x in ls if i is None or len(h := keys.get(x.strip(" \t\n\x0b\x0c\r").lower(), ())) < 2 or min(h) == i]
        if len(own) == len(ls):
            kept.append((i, t))
        elif len(" ".join(own).split()) >= 0.05 * len(t.split()):
            kept.append((i, "\n".join(own)))
    assert texts(found["line_dedup"]) == sorted(kept, key=str)
    assert {100} & {i for i, _ in kept} == set() and (101, "more in it") in kept
    # near duplicates: rows of one doc_id with other texts are sets of their own
    nodes = [(k, t) for k, (i, t) in enumerate(kept) if i is not None]
    comp = brute_components(nodes, 5, 80, 100)
    least = {}
    for k, _ in nodes:
        least[comp[k][1]] = min(least.get(comp[k][1], kept[k][0]), kept[k][0])
    one = [(i, t) for k, (i, t) in enumerate(kept) if i is None or least[comp[k][1]] == i]
    assert texts(found["ngram_join"]) == sorted(one, key=str) and len(one) < len(kept)
    # benchmark
    seen = " ".join(item)
    pure = [(i, t) for i, t in one if seen not in (t or "")]
    assert texts(found["decontaminate"]) == sorted(pure, key=str) and len(pure) == len(one) - 1
    # mixing, by its SQL
    found["decontaminate"].drop("a.b").write.parquet(str(tmp_path / "left.parquet"))
    from strataloom.llm import source_mixing

    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/left.parquet/*.parquet'")
    key = lambda r: (r[0] if r[0] is not None else -1, r[1], r[2], round(r[3], 6), r[4])
    want = sorted(map(key, c.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({source_mixing.OP4_SQL})").fetchall()))
    got = sorted(key((r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"])) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == want


def test_pipeline_empty_tables(spark, tmp_path):
    for name, schema in (("documents", "doc_id bigint, text string, lang string, source string, n_chars bigint"), ("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
