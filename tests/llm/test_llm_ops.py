"""Small cases with known answers for the ten operators: nulls, empties, ties, repeats, extra columns."""

import hashlib
import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from strataloom.llm import chat_format, decontaminate, html_mincut, importance_resampling, line_dedup, ngram_join, source_mixing, spotsigs, token_rollup, toxicity_knn

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, None) for i, t, s in rows], DOCS)


def words(seed, n):
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("w" + format(x % 5003, "x"))
    return out


# --- 2: spot signatures ---------------------------------------------------------------------------


def chained(*parts):
    """Spark's xxhash64 of string columns; nulls are skipped."""
    import xxhash

    h = 42
    for x in parts:
        if x is not None:
            h = xxhash.xxh64_intdigest(x.encode(), seed=h)
    return h & 0xFFFFFFFF


def brute_signatures(text, chosen):
    """The signature set by its definition, token by token; chosen: content words that are anchors by hash."""
    tok = [x for x in re.split(r"[\W_]+", text.lower()) if x]
    common = set(spotsigs.ANCHORS)

    def chain(i):
        after = [x for x in tok[i + 1 :] if x not in common][:2]
        return chained(tok[i], *after) if after else None

    found = {chain(i) for i, x in enumerate(tok) if x in common} - {None}
    found = found or {chain(i) for i, x in enumerate(tok) if x not in common and x in chosen} - {None}
    if not found and tok:
        found = {chained(*tok[i : i + 3]) for i in range(len(tok))}
    return found or ({chained(text)} if text else set())


def test_spotsigs_query_equals_brute_force(spark, tmp_path):
    some = [x for x in words(31, 60)]
    rows = [(i, " ".join(x if (k + i) % 4 else spotsigs.ANCHORS[(k * 7 + i) % 60] for k, x in enumerate(some[i : i + 25 + i])), "a") for i in range(12)]
    rows += [(50 + i, " ".join(some[i : i + 30]), "a") for i in range(4)]  # no common word
    rows += [(70, "the of and", "a"), (71, "?!", "a"), (72, None, "a"), (73, "Solo the", "a"), (74, "Die Größe, der Stadt... the END", "a"), (75, "x", "a")]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    vocabulary = sorted({x for _, t, _ in rows for x in re.split(r"[\W_]+", (t or "").lower()) if x})
    chosen = {r["w"] for r in spark.createDataFrame([(w,) for w in vocabulary], "w string").where(F.pmod(F.hash("w"), F.lit(spotsigs.CONTENT_ANCHOR)) == 0).collect()}
    texts = {i: t or "" for i, t, _ in rows}
    order = sorted(texts, reverse=True)
    text_of = lambda x: ",".join(format(v, "x") for v in sorted(x))
    like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
    got = {r["doc_id"]: r for r in spotsigs.op2_spot_fingerprints(spark, str(tmp_path)).collect()}
    assert set(got) == set(texts)
    for k, i in enumerate(order):
        t, after = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(t) // 2
        edited_text = t[: len(t) - half] + after[:half]
        own, other = brute_signatures(t, chosen), brute_signatures(edited_text, chosen)
        r = got[i]
        assert r["fingerprint"] == text_of(own), i
        assert r["near_next"] == pytest.approx(like(own, brute_signatures(after, chosen)))
        assert r["edited_sha256"] == hashlib.sha256(edited_text.encode()).hexdigest()
        cut_words = {w for w in re.split(r"[\W_]+", edited_text.lower()) if w} - set(vocabulary)
        if any(x in set(spotsigs.ANCHORS) for x in re.split(r"[\W_]+", edited_text.lower())[:-1]) or not cut_words:
            assert r["edited_fingerprint"] == text_of(other), i
            assert r["near_edited"] == pytest.approx(like(own, other))


def test_spotsigs_known_sets(spark):
    d = docs(spark, [(1, "The cat and the dog of a house ran", "a"), (2, "the CAT, and the dog; of a house ran!", "a"), (3, None, "a"), (4, "", "a"), (5, "!!!", "a"), (6, "solo", "a")])
    got = {r["doc_id"]: r for r in spotsigs.classes(d).collect()}
    assert got[1]["sigs"] == got[2]["sigs"] and got[2]["class_id"] == 1
    # anchors the(cat,dog), and+the(dog,house), of+a(house,ran) plus anchors chosen by hash
    assert len(got[1]["sigs"]) >= 5
    assert got[3]["sigs"] == [] and got[4]["sigs"] == [] and got[4]["class_id"] == 3
    assert len(got[5]["sigs"]) == 1 and len(got[6]["sigs"]) == 1


def test_spotsigs_query_contract(spark, tmp_path):
    rows = [(10, "the cat sat on the mat and the dog ran to the red house", "a"), (7, "the cat sat on the mat and the dog ran to the red house", "a"), (5, None, "a"), (3, "a b", "a"), (3, "a b", "a")]
    docs(spark, rows).withColumn("block", F.lit(9)).withColumn("tie", F.lit("x")).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(spotsigs.op2_spot_fingerprints(spark, str(tmp_path)).collect(), key=lambda r: -r["doc_id"])
    assert [r["doc_id"] for r in got] == [10, 7, 5, 3, 3]
    t = rows[0][1]
    n = len(t)
    assert got[0]["edited_sha256"] == hashlib.sha256((t[: n - n // 2] + t[: n // 2]).encode()).hexdigest()
    assert got[1]["edited_sha256"] == hashlib.sha256(t[: n - n // 2].encode()).hexdigest()
    assert got[0]["near_next"] == 1.0 and got[1]["near_next"] == 0.0 and 0 < got[1]["near_edited"] < 1
    assert got[2]["fingerprint"] == "" and got[2]["n_chars"] == 0
    # the last row is followed by the first
    assert {r["edited_sha256"] for r in got[3:]} == {hashlib.sha256(b"a a").hexdigest(), hashlib.sha256(b"a t").hexdigest()}


def test_spotsigs_ids_at_both_ends_of_bigint(spark, tmp_path, monkeypatch):
    top, words_ = (1 << 63) - 1, words(5, 40)
    ids = [-top - 1, -top, -5, 0, 7, top - 4096, top - 1, top]
    rows = [(i, f"the {' of '.join(words_[k : k + 6])}", "a") for k, i in enumerate(ids)] + [(None, "the null one", "a")]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    texts = {i: t for i, t, _ in rows}
    order = [*sorted(ids, reverse=True), None]
    for block_rows in (spotsigs.BLOCK_ROWS, 2):
        monkeypatch.setattr(spotsigs, "BLOCK_ROWS", block_rows)
        got = {r["doc_id"]: r["edited_sha256"] for r in spotsigs.op2_spot_fingerprints(spark, str(tmp_path)).collect()}
        for k, i in enumerate(order):
            t, after = texts[i], texts[order[(k + 1) % len(order)]]
            half = len(t) // 2
            assert got[i] == hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()


def test_spotsigs_pairs_equal_brute_force(spark):
    base = "the " + " of ".join(words(1, 60))
    near = base.replace(words(1, 60)[30], "changed")
    d = docs(spark, [(1, base, "a"), (2, near, "a"), (3, base, "a"), (4, "the " + " of ".join(words(2, 60)), "a")])
    sets = {r["doc_id"]: set(r["sigs"]) for r in spotsigs.classes(d).collect()}
    want = {(a, b) for a in (1, 2, 4) for b in (1, 2, 4) if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    assert {(r["class_a"], r["class_b"]) for r in spotsigs.similar_pairs(d, 0.8).collect()} == want == {(1, 2)}


def test_similar_pairs_at_the_threshold_and_under_one_doc_id(spark):
    same = [f"the w{i} v{i}" for i in range(80)]
    rows = [(1, " ".join(same[:4]), "a"), (2, " ".join(same[:5]), "a"), (2, " ".join(same[40:50]), "a"), (2, " ".join(same[40:50]), "a"), (None, " ".join(same[40:52]), "a"), (9, None, "a")]
    rows += [(20 + i, " ".join(same[: 30 + i]), "a") for i in range(12)]
    d = docs(spark, rows)
    known = {r["key"]: (r["doc_id"], set(r["sigs"])) for r in spotsigs._keyed(d).collect() if r["sigs"]}
    names, want = sorted(known), []
    for i, x in enumerate(names):
        for y in names[i + 1 :]:
            (p, sx), (q, sy) = known[x], known[y]
            if len(sx & sy) / len(sx | sy) >= 0.8:
                want.append((sorted([p, q], key=str), len(sx & sy) / len(sx | sy)))
    got = [(sorted([r["class_a"], r["class_b"]], key=str), r["jaccard"]) for r in spotsigs.similar_pairs(d, 0.8).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert ([1, 2], 0.8) in got and len(got) > 20


def test_blocks_hold_with_clustered_ids(spark):
    rows = [(i, f"text {i}", "a") for i in range(300)] + [(10**15, "far", "a")]
    got = spotsigs.with_next(docs(spark, rows)).collect()
    nxt = {r["doc_id"]: r["next_text"] for r in got}
    assert nxt[10**15] == "text 299" and nxt[0] == "far" and all(nxt[i] == f"text {i - 1}" for i in range(1, 300))


def test_blocks_of_any_size_and_null_ids(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "BLOCK_ROWS", 3)
    rows = [(i * i, f"text {i}", "a") for i in range(60)] + [(None, f"null {i}", "a") for i in range(40)]
    got = spotsigs.with_next(docs(spark, rows)).collect()
    assert len(got) == 100 and len({r["text"] for r in got}) == 100
    nxt = {r["text"]: r["next_text"] for r in got}
    assert all(nxt[f"text {i}"] == f"text {i - 1}" for i in range(1, 60)) and nxt["text 0"].startswith("null")
    at, seen = "text 59", []
    for _ in range(100):
        seen.append(at)
        at = nxt[at]
    assert at == "text 59" and len(set(seen)) == 100  # one round through all rows


# --- 3: n-gram join -------------------------------------------------------------------------------


def brute_components(rows, n, num, den):
    sets = {}
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = set(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else ({tuple(w)} if w else set())
    comp = {i: i for i in sets}
    links = dict.fromkeys(sets, 0)
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and den * len(sets[x] & sets[y]) >= num * len(sets[x] | sets[y]):
                links[x] += 1
                links[y] += 1
                a, b = comp[x], comp[y]
                for k, v in comp.items():
                    if v == max(a, b):
                        comp[k] = min(a, b)
    return {i: (len(sets[i]), comp[i], links[i]) for i in ids}


def edited(base, seed, k):
    w = list(base)
    for j, x in enumerate(words(seed, k)):
        w[(seed * 37 + j * 53) % len(w)] = x
    return " ".join(w)


@pytest.mark.parametrize("n,num", [(4, 85), (5, 80)])
def test_ngram_join_equals_brute_force(spark, n, num):
    rows = []
    for g in range(4):
        base = words(100 + g, 90)
        rows += [(1000 * g + k, edited(base, 10 * g + k, k % 7), "a") for k in range(45)]
    shared = " ".join(words(7, 30))
    rows += [(9000 + k, shared + " " + " ".join(words(500 + k, 20)), "a") for k in range(40)]
    rows += [(9900, "Few words", "a"), (9901, "few  words", "a"), (9902, None, "a"), (9903, " \t", "a"), (9904, "one", "a"), (9905, " ".join(words(3, 6000)), "a"), (9906, " ".join(words(3, 6000)[:5900]), "a")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_join.join(docs(spark, rows), n, num, 100).collect()}
    assert got == brute_components(rows, n, num, 100)


def test_ngram_join_tiles_and_streams(spark, monkeypatch):
    """Tile pairs and the streamed large partition give the same result as one tile."""
    base = words(42, 80)
    rows = [(k, edited(base, k, k % 6), "a") for k in range(120)]
    want = brute_components(rows, 5, 80, 100)
    monkeypatch.setattr(ngram_join, "TILE_NODES", 25)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_join.join(docs(spark, rows)).collect()}
    assert got == want


@pytest.mark.parametrize("n_first,n_next", [(22, 0), (22, 2), (24, 3), (17, 1), (40, 30)])
def test_ngram_join_streamed_partition_is_united_to_its_end(spark, monkeypatch, n_first, n_next):
    """Rows that come after a streamed part meet all rows of that part, not only its last one."""
    import numpy as np

    monkeypatch.setattr(ngram_join, "STREAM_ROWS", 10)
    monkeypatch.setattr(ngram_join, "BATCH_ROWS", 8, raising=False)
    low, high = ([int(x) for x in np.repeat(np.uint8(v), 64).view("<i8")] for v in (0, 4))
    left, right = [*high[:4], *low[4:]], [*low[:4], *high[4:]]  # counts in one half of the groups
    rows = [(7, k, 100 + k // 2, 1, 1, *(right if k == 15 else left)) for k in range(n_first)]
    rows += [(8, 1000 + k, 100, 1, 1, *(left if k % 2 else right)) for k in range(n_next)]
    names = ["part", "node", "size", "own", "scale", *ngram_join._VEC]
    points = spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c in ('size', 'own', 'scale') else 'bigint'}" for c in names)).coalesce(1).sortWithinPartitions("part", "size", "node")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    try:
        edges = [tuple(r) for r in ngram_join._cloud_edges(points, 80, 100).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    u = ngram_join._Union(1000 + n_next)
    for a, b in edges:
        u.join(a, b)
    assert {u.find(k) for k in range(n_first)} == {0}
    assert all(a >= 1000 or b < 1000 for a, b in edges)


def test_ngram_join_small_stream_bounds_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "STREAM_ROWS", 12)
    monkeypatch.setattr(ngram_join, "BATCH_ROWS", 8, raising=False)
    rows = []
    for g in range(3):
        base = words(300 + g, 90)
        rows += [(1000 * g + k, edited(base, 10 * g + k, k % 7), "a") for k in range(45)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "8")
    try:
        got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in ngram_join.join(docs(spark, rows), 5, 80, 100).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_components(rows, 5, 80, 100)


@pytest.mark.parametrize("leaf,fanout", [(4, 2), (8, 3), (32, 16), (256, 16)])
def test_rtree_edges_span_the_relation(monkeypatch, leaf, fanout):
    import numpy as np

    monkeypatch.setattr(ngram_join, "LEAF", leaf)
    monkeypatch.setattr(ngram_join, "FANOUT", fanout)

    sets = [ngram_join.ngram_set(edited(words(5, 100), k, k % 9), 5) for k in range(200)]
    sets.sort(key=len)
    size = np.array([len(s) for s in sets])
    vec = np.stack([ngram_join.count_vector(s)[0].astype(np.int32) * ngram_join.count_vector(s)[1] for s in sets])
    u = ngram_join._Union(len(sets))
    for a, b in ngram_join.tree_edges(size, vec, 80, 100):
        u.join(a, b)
    for i in range(len(sets)):
        for j in range(i):
            over = len(np.intersect1d(sets[i], sets[j]))
            assert over <= np.minimum(vec[i], vec[j]).sum()
            if 100 * over >= 80 * (size[i] + size[j] - over):
                assert u.find(i) == u.find(j)


def test_rtree_edges_of_sizes_far_apart(monkeypatch):
    """Boxes out of reach by size or bound are not opened; nothing in reach is lost."""
    import numpy as np

    monkeypatch.setattr(ngram_join, "LEAF", 4)
    monkeypatch.setattr(ngram_join, "FANOUT", 2)
    sets = [ngram_join.ngram_set(edited(words(20 + k % 5, 30 * (1 + k % 4)), k, k % 4), 3) for k in range(150)]
    sets.sort(key=len)
    size = np.array([len(s) for s in sets])
    vec = np.stack([ngram_join.count_vector(s)[0].astype(np.int32) * ngram_join.count_vector(s)[1] for s in sets])
    u, v = ngram_join._Union(len(sets)), ngram_join._Union(len(sets))
    for a, b in ngram_join.tree_edges(size, vec, 70, 100):
        u.join(a, b)
    over = np.minimum(vec[:, None], vec[None]).sum(axis=2)
    for i in range(len(sets)):
        for j in range(i):
            if 170 * over[i, j] >= 70 * (size[i] + size[j]) and 100 * size[j] >= 70 * size[i]:
                v.join(i, j)
    assert [u.find(i) for i in range(len(sets))] == [v.find(i) for i in range(len(sets))]


def test_ngram_join_repeated_doc_ids(spark):
    """Rows of one doc_id with other texts are nodes of their own, each with its own links."""
    a, b = words(61, 60), words(62, 60)
    rows = [(1, " ".join(a), "x"), (1, " ".join(b), "x"), (2, edited(a, 1, 1), "x"), (3, edited(b, 2, 1), "x"), (1, " ".join(a), "x")]
    got = sorted((r["doc_id"], r["component_id"], r["n_links"]) for r in ngram_join.join(docs(spark, rows)).collect())
    assert got == [(1, 1, 1), (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]
    rows = [(5, " ".join(a), "x"), (5, " ".join(b), "x"), (2, edited(a, 1, 1), "x")]
    kept = [(r["doc_id"], r["text"]) for r in ngram_join.keep_one(docs(spark, rows)).collect()]
    assert sorted(kept) == sorted([(2, edited(a, 1, 1)), (5, " ".join(b))])


def test_spanning_equals_union_find():
    import numpy as np

    rnd = np.random.default_rng(5)
    for n, p in ((30, 0.02), (30, 0.1), (1, 0.0), (40, 0.5)):
        ok = np.triu(rnd.random((n, n)) < p, 1)
        ok |= ok.T
        every = np.arange(n)
        u = ngram_join._Union(n)
        for x, y in zip(*np.nonzero(ok), strict=True):
            u.join(int(x), int(y))
        assert ngram_join.spanning(ok, every, every, n).tolist() == [u.find(x) for x in range(n)]
        left, right = every[: n // 3], every[n // 3 :]
        u = ngram_join._Union(n)
        for x in left:
            for y in right[ok[x][right]]:
                u.join(int(x), int(y))
        assert ngram_join.spanning(ok[np.ix_(left, right)], left, right, n).tolist() == [u.find(x) for x in range(n)]


def test_ngram_join_edge_tables(spark):
    assert ngram_join.join(docs(spark, [])).count() == 0
    d = docs(spark, [(None, "a b c d e f", "x"), (1, "a b c d e f", "x"), (1, "a b c d e f", "x")]).withColumn("cloud", F.lit(1)).withColumn("rep", F.lit(2))
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1) for r in ngram_join.join(d).collect())
    assert got == [(-1, -1), (1, 1), (1, 1)]
    kept = ngram_join.keep_one(docs(spark, [(5, "a b c d e f", "x"), (2, "A b c d e f", "y"), (9, "other words here now again", "z")]).withColumn("cloud", F.lit(1)))
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 9] and "cloud" in kept.columns


def test_components_long_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in ngram_join.components(e).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


# --- 4: mixing ------------------------------------------------------------------------------------


def water_fill(sizes, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        t = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if t[s] > 3 * sizes[s]]
        if not over:
            return fixed | t
        fixed |= {s: 3 * sizes[s] for s in over}


def test_mixing_targets_and_taken(spark):
    rows = [(i, " ".join(words(i, 1 + i % 40)), f"s{i % 5}") for i in range(400)] + [(1000, "tiny one", None), (1001, None, "s0"), (1002, "", "s9"), (1003, "x " * 5000, "big")]
    d = docs(spark, rows).withColumn("target", F.lit(1)).withColumn("bucket", F.lit(1))
    got = source_mixing.mix(d, bucket_rows=16).collect()
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(re.findall(r"[^\x20\x09-\x0d]+", t or ""))
    want = water_fill(sizes)
    src = {i: s for i, _, s in rows}
    taken = {}
    for r in got:
        s = src[r["doc_id"]]
        assert r["source_size"] == sizes[s] and math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= 1 + 1e-6 for s in sizes)
    again = {(r["doc_id"], r["taken"]) for r in source_mixing.mix(d.repartition(7), bucket_rows=4096).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in got}


def test_mixing_empty_and_repeats(spark):
    assert source_mixing.mix(docs(spark, [])).count() == 0
    got = source_mixing.mix(docs(spark, [(1, "a b c", "x"), (1, "a b c", "x"), (None, "d", "y")])).collect()
    assert len(got) == 3 and sum(r["size"] for r in got) == 7


def test_word_count_matches_pattern(spark):
    texts = [" a  b\t\nc ", " x y", "", None, "\x0b\x0c", "a\rb", "ü ß z"]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in d.select(source_mixing.word_count(F.col("text"))).collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0d]+", t or "")) for t in texts]


# --- 5: html --------------------------------------------------------------------------------------

PAGE = """<!doctype html><html><head><title>t</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><a href=/>Home</a></header><nav class="menu"><ul><li><a href=a>A</a><li><a href=b>B</a></ul></nav><div class="cookie-notice">We use cookies</div>
<article><h1>Caf&eacute; &amp; tea</h1><p>First   para with <b>bold</b> and&nbsp;more text here.<p>Second<br>line.<ul><li>one</li><li>two</li></ul>
<div class="ad">Buy</div><form><label>Mail</label><input></form><p>&#8220;Last&#x201D;</p></article>
<section id=comments><p>I liked this very much, thank you for writing it!</p></section><footer>&copy; x</footer></body></html>"""


def test_html_main_text():
    assert html_mincut.extract(PAGE) == "Café & tea\nFirst para with bold and more text here.\nSecond line.\none\ntwo\n“Last”"
    assert html_mincut.extract(None) == "" and html_mincut.extract("") == "" and html_mincut.extract("<nav>x</nav>") == ""
    assert html_mincut.extract("plain words") == "plain words"
    assert html_mincut.extract("<p>a<p>b</i></p></div>c") == "a\nb\nc"


NAV = "<nav class='main-nav'><ul><li><a href=/a>Home</a></li><li><a href=/b>World news</a></li></ul></nav>"
FOOT = "<footer><p>Contact us by letter or by phone at any time of the day.</p><p>© 2024 The Paper</p></footer>"
SIDE = "<aside class='sidebar'><h3>Most read</h3><p>A long teaser of another story that has nothing to do with this page but many words in it, really many of them.</p></aside>"
REMARKS = "".join(f"<div><p>Reader {k} says that this is a very good story, and goes on to tell one of their own at some length.</p></div>" for k in range(6))
#: Page templates around a body of known blocks.
TEMPLATES = {
    "layout class": "<html><body class='has-sidebar search-results'><div class='site has-sidebar'>{nav}<article>{body}</article>{side}</div>{foot}</body></html>",
    "page-wide form": "<html><body><form id='aspnetForm' method=post><input type=hidden name=v value=x>{nav}<div id=content>{body}</div>{side}{foot}</form></body></html>",
    "topic in the class": "<html><body>{nav}<article class='post search-and-rescue category-popular legal'>{body}</article>{side}{foot}</body></html>",
    "comments without article": "<html><body>{nav}<div class=story>{body}</div><section id=responses>{remarks}</section>{foot}</body></html>",
    "comments under a heading": "<html><body>{nav}<main>{body}<h2>6 Comments</h2>{remarks}</main>{foot}</body></html>",
    "comments as articles": "<html><body>{nav}<article>{body}</article><ol><li><article class='comment byuser'><p>I liked this very much, thank you for writing it!</p></article></ol>{foot}</body></html>",
    "teasers as articles": "<html><body>{nav}<div id=content>{body}</div><div class=related><article><h3>Another</h3><p>A teaser of another story, with some words.</p></article></div>{foot}</body></html>",
    "notices": "<html><body><div class='cookie-banner' role=dialog><p>We use cookies. By going on you agree to that, whatever it may mean to you.</p><button>Accept</button></div>{nav}<div class='wrapper popular-pages'><article>{body}<div class=newsletter-signup><p>Sign up for our letter, it comes every single week of the year to you.</p></div></article></div>{foot}</body></html>",
    "aside in the article": "<html><body>{nav}<article>{body}{side}</article>{foot}</body></html>",
    "tables and divs": "<html><body><table><tr><td class=leftmenu>{nav}</td><td class=text>{body}</td></tr></table>{foot}</body></html>",
    "schema marks": "<html><body>{nav}<div role=main>{body}</div><div itemscope itemtype='https://schema.org/Comment'><p itemprop=text>One more remark by somebody who has read all of it to its end.</p></div>{foot}</body></html>",
    "loose page": "{nav}<div class='page-header'><p>The Paper</p></div>{body}{foot}",
}


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_html_templates_give_the_article_back(name):
    """The blocks put into a page of this template, and nothing else, come out of it."""
    for k in range(5):
        blocks = [("h1", f"The title of story {k}")] + [("p", " ".join(words(k * 10 + j, 12 + 9 * j)).capitalize() + ".") for j in range(3 + k)]
        blocks.insert(3, ("h2", "A middle heading"))
        body = "".join(f"<{t}>{x}</{t}>" if i % 2 else f"<{t}>{x.replace(' ', ' &#32;', 1)}</{t}>\n" for i, (t, x) in enumerate(blocks))
        page = TEMPLATES[name].format(body=body, nav=NAV, foot=FOOT, side=SIDE, remarks=REMARKS)
        assert html_mincut.extract(page) == "\n".join(x for _, x in blocks), k


def test_min_cut_equals_brute_force():
    import itertools
    import random

    rnd = random.Random(5)
    for _ in range(60):
        n = rnd.randint(2, 8)
        s = [rnd.choice([-2.0, -1.0, 1.0, 2.0, 0.5, -0.5]) for _ in range(n)]
        edges = [(i, j, rnd.choice([0.3, 0.7, 1.5])) for i in range(n) for j in range(i + 1, n) if rnd.random() < 0.5]

        def cost(lab, s=s, edges=edges):
            return sum(-x if x < 0 and on else x if x > 0 and not on else 0 for x, on in zip(s, lab)) + sum(c for i, j, c in edges if lab[i] != lab[j])

        best = min(cost(x) for x in itertools.product([False, True], repeat=len(s)))
        assert math.isclose(cost(html_mincut.label(s, edges)), best, abs_tol=1e-6)


def test_html_odd_markup_is_linear():
    import time

    t = time.time()
    assert html_mincut.extract("<article>" + "<b>" * 30000 + "deep" + "<p>x" * 30000).count("x") == 30000
    assert html_mincut.extract("<article>" + "<div>" * 30000 + "deep words here</article>") == "deep words here"
    assert html_mincut.extract("<p>a < b << c <3 &amp") == "a < b << c <3 &"
    html_mincut.extract("<a<" * 100000)
    html_mincut.extract('<p title="' + "x'" * 100000)
    html_mincut.extract("<!--" * 50000 + "<script>" * 1000)
    assert time.time() - t < 30


@pytest.mark.parametrize("depth", [20, 600, 5000])
def test_html_stack_is_exact_at_any_depth(depth):
    """Deep elements keep their marks, and their end tags close nothing else."""
    para = "<p>A paragraph of the article with quite a number of words in it, {}.</p>"
    deep = "<div>" * depth + "<nav>Home and more</nav><div style='display:none'>unseen</div><button>Press</button>" + para.format("deep") + "</div>" * depth
    html = "<div><article>" + para.format("first") + deep + para.format("last") + "</article></div><p>Outside of it</p>"
    text = para[3:-4]
    assert html_mincut.extract(html) == "\n".join(text.format(x) for x in ("first", "deep", "last"))


def test_html_deep_stack_is_linear():
    import time

    n = 40_000
    pages = ["<div>" * n + "x" + "</i></div>" * n, "<b>" * n + "<div>x</div>" * n, "<b>" * n + "<li>x" * n, "<article>" + "<span>" * n + "<td>x</td>" * n]
    start = time.monotonic()
    assert [len(html_mincut.blocks_of(x)) for x in pages] == [1, n, n, n]
    assert time.monotonic() - start < 30


def test_html_many_blocks_and_query(spark):
    long = "<article>" + "".join(f"<p>para {i} of the page</p>" for i in range(5000)) + "</article><footer>bye</footer>"
    d = spark.createDataFrame([(1, "u", long), (2, None, None), (None, "v", PAGE), (2, None, None)], "page_id bigint, url string, html string").withColumn("text", F.lit("clash"))
    got = html_mincut.extract_pages(d).collect()
    assert len(got) == 4 and got[0]["text"].count("\n") == 4999 and got[1]["n_chars"] == 0


# --- 6: token counts ------------------------------------------------------------------------------


def test_token_rollup_is_reversible_and_idempotent(spark, tmp_path):
    r = token_rollup.TokenRollup(spark, str(tmp_path / "r"))
    a = docs(spark, [(1, "hello world", "x"), (2, None, "x"), (3, "three small words", None)])
    assert r.apply("b1", upserts=a) and not r.apply("b1", upserts=a)
    first = {tuple(x) for x in r.totals().collect()}
    assert sum(x[3] for x in first) == 3 and sum(x[5] for x in first) == 5
    r.apply("b2", upserts=docs(spark, [(1, "hello there big world", "y")]), deletes=docs(spark, [(3, "", ""), (77, "", "")]), version="v2")
    by = {(x["source"], x["tokenizer"]): (x["n_docs"], x["n_words"]) for x in r.totals().collect()}
    assert by == {("x", "v1"): (1, 0), ("y", "v2"): (1, 4)}
    r.apply("b3", upserts=docs(spark, [(1, "hello world", "x"), (3, "three small words", None)]), deletes=None)
    assert {tuple(x) for x in r.totals().collect()} == first
    assert r.apply("empty", upserts=docs(spark, []))
    assert {tuple(x) for x in r.totals().collect()} == first


def test_token_rollup_reads_batches_of_any_id(spark, tmp_path):
    r = token_rollup.TokenRollup(spark, str(tmp_path / "r"))
    ids = ["_b", ".b", "a/b", "../up", "b%2F", "100%", "é ", "_staged", "a:b?*", "x" * 240]
    for i, b in enumerate(ids):
        assert r.apply(b, upserts=docs(spark, [(i, "one two", "x")])) and not r.apply(b, upserts=docs(spark, [(i, "one two", "x")]))
    assert r.committed() == sorted(ids)
    assert [(x["n_docs"], x["n_words"]) for x in r.totals().collect()] == [(len(ids), 2 * len(ids))]
    assert r.compact() and [(x["n_docs"], x["n_words"]) for x in r.totals().collect()] == [(len(ids), 2 * len(ids))]
    for b in ("", "x" * 241, "é" * 41):
        with pytest.raises(ValueError, match="batch id"):
            r.apply(b, upserts=docs(spark, [(1, "one", "x")]))


def test_token_counts_equal_a_second_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = ["", "Hello  world, it's 2024!", "東京 🙂 naïve\n\n\tcafé", "<|endoftext|> x", " ".join(words(3, 400)), "a" * 3000 + " " * 3000 + "b", " \n" * 2000, "x\r\n" * 500]
    assert token_rollup.token_counts([None, *texts], token_rollup.TOKENIZER) == [0, *[len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]]


def test_long_runs_of_white_space(spark, tmp_path):
    """A million spaces, line feeds or mixed ones, alone and between words, are counted and formatted."""
    runs = [" " * 1_000_000, "\n" * 1_000_000, "a " + " \t\u00a0" * 400_000 + "b", "x" * 1_000_000, " " * 4097, "-" * 1_000_000]
    for x in runs:
        assert "".join(token_rollup.pieces(x)) == x
    assert token_rollup.pieces("ab" + " " * 4096 + "c") == ["ab" + " " * 4096 + "c"]
    counts = token_rollup.token_counts(runs, token_rollup.TOKENIZER)
    assert all(0 < n <= len(x) for n, x in zip(counts, runs, strict=True))
    talk = [(i, k, "assistant" if k else "user", x) for i, x in enumerate(runs) for k in (0, 1)]
    c = spark.createDataFrame(talk, "conv_id bigint, turn bigint, role string, text string")
    got = {r["conv_id"]: r for r in chat_format.digests(chat_format.format_conversations(c)).collect()}
    for i, x in enumerate(runs):
        assert got[i]["loss_chars"] == len(x) and got[i]["loss_sha256"] == hashlib.sha256(x.encode()).hexdigest() and got[i]["n_turns"] == 2


def test_token_rollup_compacts(spark, tmp_path):
    r = token_rollup.TokenRollup(spark, str(tmp_path / "r"))
    assert not r.compact()
    r.apply("b1", upserts=docs(spark, [(1, "hello world", "x"), (2, "two", "x"), (3, "three small words", None)]))
    r.apply("b2", upserts=docs(spark, [(1, "hello there big world", "y")]), deletes=docs(spark, [(2, "", "")]))
    before, live = {tuple(x) for x in r.totals().collect()}, {tuple(x) for x in r.counts().collect()}
    assert r.compact() and not r.compact()
    assert {tuple(x) for x in r.totals().collect()} == before and {tuple(x) for x in r.counts().collect()} == live
    assert r._base()["batches"] == ["b1", "b2"] == r.committed() and not r.apply("b1", upserts=docs(spark, [(9, "x", "x")]))
    assert r.apply("b3", deletes=docs(spark, [(1, "", "")]))
    assert {(x["source"], x["n_docs"]) for x in r.totals().collect()} == {(None, 1)}
    assert r.compact() and {(x["doc_id"], x["n_words"]) for x in r.counts().collect()} == {(3, 3)}
    assert not r._put("commits/b3", {"folder": "other"})  # a commit is never replaced
    assert r._load("commits/b3")["folder"] != "other"


def test_token_query_restores_the_rows_it_withdrew(spark, tmp_path):
    rows = [(1, "hola mundo", "es", "x", None), (1, "hello big world", "en", "x", None), (1, "salut", None, "y", None), (None, "sin id", "es", "x", None), (2, "uno", "es", "y", None), (3, "three words here", "en", None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    want = {}
    for _, t, lang, s, _ in rows:
        n, w = want.get((s, lang), (0, 0))
        want[s, lang] = (n + 1, w + len(t.split()))
    got = token_rollup.op6_token_counts(spark, str(tmp_path)).collect()
    assert {(r["source"], r["lang"]): (r["n_docs"], r["n_words"]) for r in got} == want


# --- 7: line dedup --------------------------------------------------------------------------------


def brute_lines(rows):
    owner, holders = {}, {}
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    for i, t in rows:
        for x in (t or "").split("\n"):
            k = key(x)
            if i is not None and len(k) >= 10:
                holders.setdefault(k, set()).add(i)
    owner = {k: min(v) for k, v in holders.items() if len(v) > 1}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or owner.get(key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


LINES = [(3, "Shared line here\nown line of three\n\nshort"), (1, "  SHARED LINE HERE \nshort\nown of one, only"), (2, "shared line here\nshared line here"), (4, None), (5, ""), (2, "shared line here\nshared line here"),
         (None, "shared line here"), (6, "zehn zeichü\nÄÖÜ ÄÖÜ ÄÖÜ"), (7, "zehn zeichü\näöü ÄÖÜ ÄÖÜ"), (8, "x\x0b\n" + "long " * 20000)]


def test_line_dedup_equals_brute_force(spark):
    d = docs(spark, [(i, t, "s") for i, t in LINES]).withColumn("dropped", F.lit(1)).withColumn("k1", F.lit(1))
    got = sorted((tuple(r) for r in line_dedup.line_dedup_digests(d).collect()), key=str)
    assert got == brute_lines(LINES)
    kept = line_dedup.dedup_lines(d)
    assert kept.columns == d.columns and {r["doc_id"]: r["text"] for r in kept.collect()}[2] == ""
    assert line_dedup.line_dedup_digests(docs(spark, [])).count() == 0


def test_line_dedup_without_filters(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    got = sorted((tuple(r) for r in line_dedup.line_dedup_digests(docs(spark, [(i, t, "s") for i, t in LINES])).collect()), key=str)
    assert got == brute_lines(LINES)


def test_line_dedup_probes_in_shards(spark, monkeypatch):
    """The branch beyond the broadcast bound: the filters of many shards, met by dealt line rows."""
    monkeypatch.setattr(line_dedup, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 7)
    monkeypatch.setattr(line_dedup, "SALTS", 3)
    rows = [(i, "\n".join(["The line of all documents", f"line of class {i % 9} and more", f"only in document {i}", "short"] * (1 + i % 2)), "s") for i in range(120)]
    lines = [(i, t) for i, t, _ in rows]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        got = sorted((tuple(r) for r in line_dedup.line_dedup_digests(docs(spark, rows)).collect()), key=str)
        shared = line_dedup.shared_keys(line_dedup.line_refs(docs(spark, rows)))
        hits = line_dedup._probed(docs(spark, rows), line_dedup.build_filters(shared, 4), 4, 10**9, 10)
        n, k = hits.count(), hits.select("k1", "k2").distinct().count()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute_lines(lines)
    assert (n, k) == (240, 10)  # the filters let the 120 unshared keys go


def test_line_index_equals_brute_force_over_batches(spark):
    """Random batches in and out of a small index, whose filters must grow; every state equals brute force."""
    import random

    rnd = random.Random(4)
    text = lambda i: "\n".join(f"a line number {rnd.randrange(40 + i)} of the set" for _ in range(12))
    x, held = line_dedup.LineIndex(spark, n_shards=2), {}
    sizes = []
    for step in range(5):
        new = [(100 * step + i, text(60 * step), "s") for i in range(30)]
        x.insert(docs(spark, new))
        held |= {i: t for i, t, _ in new}
        if step:
            gone = rnd.sample(sorted(held), 25)
            x.delete(spark.createDataFrame([(i,) for i in [*gone, 99999]], "doc_id bigint"))
            for i in gone:
                del held[i]
        got = {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in x.kept(docs(spark, [(i, t, "s") for i, t in held.items()])).collect()}
        assert got == {r[0]: r[3] for r in brute_lines(sorted(held.items()))}, step
        sizes.append(sum(line_dedup.CuckooFilter.from_bytes(bytes(r["filter"])).table.size for r in x.filters.collect()))
        assert x.filters.agg(F.sum("n_keys")).first()[0] == line_dedup.shared_keys(x.refs).count()
    assert sizes[-1] > sizes[0]


def test_cuckoo_filter():
    import numpy as np

    keys = [tuple(x) for x in np.random.default_rng(1).integers(-(2**62), 2**62, (3000, 2)).tolist()]
    f = line_dedup.CuckooFilter(2000)  # overfull: the stash takes what finds no place
    for k in keys:
        f.add(*k)
    f = line_dedup.CuckooFilter.from_bytes(f.to_bytes())
    assert all(k in f for k in keys)
    others = np.random.default_rng(2).integers(-(2**62), 2**62, (20000, 2))
    assert f.probe(others[:, 0].copy(), others[:, 1].copy()).mean() < 0.01
    for k in keys:
        f.remove(*k)
    assert not f.stash and not f.table.any()


def test_line_index_insert_delete_restores(spark):
    x = line_dedup.LineIndex(spark, n_shards=3)
    a, b = docs(spark, [(1, "the very same line\nfirst", "s"), (2, "the very same line\nsecond", "s")]), docs(spark, [(0, "the very same line", "s")])
    x.insert(a)
    before = {r["doc_id"]: r["text"] for r in x.kept(a).collect()}
    assert before == {1: "the very same line\nfirst", 2: "second"}
    x.insert(b)
    assert {r["doc_id"]: r["text"] for r in x.kept(a.union(b)).collect()} == {0: "the very same line", 1: "first", 2: "second"}
    x.delete(b)
    assert {r["doc_id"]: r["text"] for r in x.kept(a).collect()} == before
    x.delete(a.where("doc_id = 1"))
    assert {r["doc_id"]: r["text"] for r in x.kept(a.where("doc_id = 2")).collect()} == {2: "the very same line\nsecond"}
    raw = [line_dedup.CuckooFilter.from_bytes(bytes(r["filter"])) for r in x.filters.collect()]
    assert all(not f.table.any() for f in raw)


# --- 8: chat --------------------------------------------------------------------------------------

TALK = [(1, 0, "system", "be [SYS] kind\\"), (1, 1, "user", "</s>[INST] ok [/INST]"), (1, 2, "assistant", "</s>[INST] ok [/INST]"), (1, 3, "assistant", ""), (1, 4, "tool[ROLE]", "r\\[/ROLE]x"), (1, 5, "assistant", " 東京 🙂 \n\n"),
        (2, None, None, None), (2, 1, "assistant", None), (3, 1, "assistant", "a"), (3, 1, "assistant", "a"), (None, 0, "user", "null id"), (4, 0, "assistant", "lang " * 60000)]


def test_chat_round_trip(spark):
    d = spark.createDataFrame(TALK, "conv_id bigint, turn bigint, role string, text string").withColumn("part", F.lit(1))
    for size in (1 << 20, 8):
        got = {r["conv_id"]: r for r in chat_format.digests(chat_format.format_conversations(d, part_chars=size)).collect()}
        for c in {t[0] for t in TALK}:
            turns = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in TALK if t[0] == c))
            want = hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest()
            loss = "".join(t for _, _, r, t in turns if r == "assistant")
            assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(turns), want)
            assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_escape_is_exact():
    for t in ("", "\\", "<s>", "<\\s>", "[INST][/INST]", "<<s>>", "\\\\[SYS]", "a</s></s>"):
        e = chat_format.escape(t)
        assert chat_format.unescape(e) == t and not any(c in e for c in chat_format.CONTROL)


# --- 9: decontamination ---------------------------------------------------------------------------


def test_decontamination_with_substitutions(spark):
    item = words(11, 40)
    sub = list(item)
    for k in range(0, 40, 6):
        sub[k] = "changed"
    rows = [(1, "before " + " ".join(item) + " after", "a"), (2, "x y " + " ".join(sub), "a"), (3, " ".join(item[:6]) + " " + " ".join(words(5, 60)), "a"), (4, " ".join(words(6, 80)), "a"), (5, None, "a"), (6, "", "a"), (7, " ".join(item[25:]).upper(), "a")]
    b = spark.createDataFrame([(100, " ".join(item)), (101, "too short"), (102, None), (100, " ".join(item))], "item_id bigint, text string").withColumn("pos", F.lit(1))
    d = docs(spark, rows).withColumn("item_id", F.lit(5)).withColumn("seed", F.lit(5))
    got = {(r["doc_id"], r["item_id"]): r["matched"] for r in decontaminate.contaminations(d, b).collect()}
    assert got == {(1, 100): 40, (2, 100): 33, (7, 100): 15}
    kept = decontaminate.decontaminate(d, b)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6] and kept.columns == d.columns
    assert decontaminate.contaminations(docs(spark, []), b).count() == 0
    assert decontaminate.contaminations(d, b.where("false")).count() == 0


@pytest.mark.parametrize("period", [3, 4, 5, 6, 7])
def test_decontamination_at_any_period(spark, period):
    item = words(21, 36)
    b = spark.createDataFrame([(1, " ".join(item))], "item_id bigint, text string")
    rows = [(k, "lead in " + " ".join("other" if (j + k) % period == 0 else x for j, x in enumerate(item)), "a") for k in range(period)]
    assert {r["doc_id"] for r in decontaminate.contaminations(docs(spark, rows), b).collect()} == set(range(period))


def test_decontamination_in_blocks(spark, monkeypatch):
    """A benchmark of more seeds than may be broadcast at once gives the same rows."""
    items = [(k, " ".join(words(700 + k, 20 + k))) for k in range(12)]
    rows = [(k, " ".join(words(50 + k, 9)) + " " + " ".join(x if j % 7 else "other" for j, x in enumerate(items[k % 12][1].split())), "a") for k in range(30)]
    b = spark.createDataFrame([*items, (None, items[0][1])], "item_id bigint, text string")
    want = sorted((tuple(r) for r in decontaminate.contaminations(docs(spark, rows), b).collect()), key=str)
    assert {r[0] for r in want} == set(range(30))
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 300)
    got = sorted((tuple(r) for r in decontaminate.contaminations(docs(spark, rows), b).collect()), key=str)
    assert got == want


def test_decontamination_holds_one_block_and_one_copy_of_an_item(spark, monkeypatch):
    """Copies of an item take no seeds of their own; blocks are found one after the other, and leave no broadcast behind."""
    text = " ".join(words(31, 30))
    copies = spark.createDataFrame([(k, text if k < 60 else f"  {text.upper()}!") for k in range(80)], "item_id bigint, text string")
    rows = [(1, f"lead in {text} end", "a"), (2, "nothing of it " * 5, "a")]
    sent, inner = [], decontaminate._hits
    monkeypatch.setattr(decontaminate, "_hits", lambda d, kinds, seeds: sent.append(seeds.count()) or inner(d, kinds, seeds))
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 200)
    found = decontaminate.contaminations(docs(spark, rows), copies)
    assert sorted(tuple(r) for r in found.collect()) == [(1, k, 30, 30) for k in range(80)]
    assert len(sent) == 1 and sent[0] <= 4 * 30
    assert [r["doc_id"] for r in decontaminate.decontaminate(docs(spark, rows), copies).collect()] == [2]

    others = spark.createDataFrame([(k, " ".join(words(900 + k, 20))) for k in range(12)], "item_id bigint, text string")
    sent.clear()
    found = decontaminate.contaminations(docs(spark, rows), others)
    assert len(sent) > 2 and "Generate" not in found._jdf.queryExecution().executedPlan().toString()


def test_decontaminated_documents_are_not_exchanged(spark):
    text = " ".join(words(31, 30))
    b = spark.createDataFrame([(1, text)], "item_id bigint, text string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = decontaminate.decontaminate(docs(spark, [(1, text, "a"), (2, "other words here", "a")]), b)
        assert [r["doc_id"] for r in kept.collect()] == [2]
        assert "hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# --- 10: toxicity ---------------------------------------------------------------------------------


@pytest.mark.parametrize("first,few,n,cheap", [(2, 0, 500, 0), (48, 96, 500, 10**6), (1, 40, 300, 0), (2, 40, 7, 0)])
def test_block_max_search_is_exact(monkeypatch, first, few, n, cheap):
    import numpy as np

    monkeypatch.setattr(toxicity_knn, "FIRST_TERMS", first)
    monkeypatch.setattr(toxicity_knn, "FEW", few)
    monkeypatch.setattr(toxicity_knn, "CHEAP", cheap)
    rnd = np.random.default_rng(3)
    names = [f"t{i}" for i in range(60)]
    share = 1.0 / np.arange(1, 61)
    counted = [{names[i]: int(c) for i, c in zip(rnd.choice(60, 9, replace=False, p=share / share.sum()), rnd.integers(1, 4, 9))} for _ in range(n)]
    x = toxicity_knn.build_index({w: i for i, w in enumerate(names)}, rnd.random(60) + 0.1, list(range(n)), [int(v) for v in rnd.random(n) < 0.2], counted)
    dense = np.zeros((n, 60))
    for e in range(n):
        at = slice(x.row_off[e], x.row_off[e + 1])
        dense[e, x.row_term[at]] = x.row_w[at]
    for q in [*counted[:60], {"t0": 1, "unheard": 3, "t1": 2}]:
        t, w = x.vector(q)
        v = np.zeros(60)
        v[t] = w
        cos = dense @ v
        for without in (-1, int(np.argmax(cos))):
            c = cos.copy()
            if without >= 0:
                c[without] = 0.0
            at, got = x.nearest(t, w, 10, without)
            want = np.lexsort((np.arange(n), -np.round(c, 9)))[:10]
            want = want[c[want] > 0]
            assert np.allclose(got, c[want]) and list(at) == list(want)


def test_toxicity_query_equals_brute_force(spark, tmp_path):
    """Every score of the query against plain dictionaries: all terms, all examples, no index."""
    rows = [(i, " ".join(words(i % 37, 25) + words(i, 5) + (["awfulword"] * (i % 3) + ["nasty"] if i % 5 == 0 else ["kind"])), "s") for i in range(200)]
    rows += [(500, None, "s"), (501, "", "s"), (502, "awfulword and 7 more", "s"), (503, "unheard of", "s"), (7, "kind again", "s")]
    labels = [(i, 1, int(i % 5 == 0)) for i in range(180)]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([*labels, (500, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    def tf(text):
        found = re.findall(r"[^\W\d_]+", (text or "").lower())
        return {w: 1 + math.log(found.count(w)) for w in found}

    texts = {}
    for i, t, _ in rows:
        texts[i] = min(t or "", texts.get(i, t or ""))
    used = [(i, y) for i, _, y in [*labels, (500, 1, 0)] if zlib.crc32(str(i).encode()) % 5]
    pos = sum(y for _, y in used)
    neg = len(used) - pos
    n, a = {}, {}
    for i, y in used:
        for w in tf(texts[i]):
            n[w] = n.get(w, 0) + 1
            a[w] = a.get(w, 0) + y
    weight = {}
    for w in n:
        share = n[w] / (pos + neg)
        spread = math.sqrt(share * (1 - share) * (1 / pos + 1 / neg))
        z = (a[w] / pos - (n[w] - a[w]) / neg) / spread if spread else 0.0
        df = sum(w in tf(t) for _, t, _ in rows)
        weight[w] = math.log((1 + len(rows)) / (1 + df)) * z * z / (z * z + 25)

    def unit(text):
        v = {w: x * weight[w] for w, x in tf(text).items() if weight.get(w, 0) > 0}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    examples = [(i, y, v) for i, y in used if (v := unit(texts[i]))]
    bare = [y for i, y in used if not unit(texts[i])]
    base = pos / len(used)

    def raw(v, but=None):
        c = sorted(((round(sum(x * e.get(w, 0) for w, x in v.items()), 9), y) for i, y, e in examples if i != but), key=lambda x: -x[0])
        if len(c) > 15:
            assert c[14][0] != c[15][0] or {y for s, y in c if s == c[14][0]} in ({0}, {1})  # no tie decides
        c = [(s / (1.1 - min(s, 1.0)), y) for s, y in c[:15] if s > 0]
        return (sum(s * y for s, y in c) + base) / (sum(s for s, _ in c) + 1) if c else None

    import numpy as np

    slope, shift = toxicity_knn._logistic(np.array([raw(v, i) for i, _, v in examples]), np.array([float(y) for _, y, _ in examples]))
    for r in toxicity_knn.op10_toxicity(spark, str(tmp_path)).collect():
        ways = []
        for t in [t for i, t, _ in rows if i == r["doc_id"]]:
            x = raw(v) if (v := unit(t)) else None
            ways.append((sum(bare) + base) / (len(bare) + 1) if x is None else 1 / (1 + math.exp(-(slope * math.log(x / (1 - x)) + shift))))
        assert min(abs(r["score"] - w) for w in ways) < 1e-6, r
        assert r["predicted"] == int(r["score"] >= 0.5) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_toxicity_learns_and_rejects(spark):
    rows, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        rows.append((i, " ".join(words(i, 30) + (["awfulword", "nastyword"] if bad else [])), "s"))
        labels.append((i, 1, int(bad)))
    rows += [(900, None, "s"), (901, "", "s"), (902, "AWFULWORD nastyword", "s"), (None, "nice", "s")]
    d = docs(spark, rows).withColumn("score", F.lit(3))
    lab = spark.createDataFrame([*labels, (3, None, None), (None, 1, 1), (0, 1, 1)], "doc_id bigint, quality int, toxic int")
    index = toxicity_knn.fit(d, lab)
    import numpy as np

    strong = {w for w, i in index.terms.items() if i in np.argsort(-index.weight)[:2]}
    used = {i for i in range(300) if zlib.crc32(str(i).encode()) % 5}
    assert len(index.terms) == len({w for i, t, _ in rows if i in used for w in toxicity_knn.words(t)}) and strong == {"awfulword", "nastyword"}
    got = {r["doc_id"]: r for r in toxicity_knn.score(d, index, evidence=3).collect()}
    for i in range(300):
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert got[i]["predicted"] == int(i % 4 == 0) == int(got[i]["score"] >= 0.5)
    assert got[902]["predicted"] == 1 and len(got[902]["evidence"]) == 3 and got[901]["predicted"] == 0 and got[900]["score"] == got[901]["score"]
    kept = toxicity_knn.reject_toxic(d, index)
    assert kept.columns == d.columns and kept.count() == 300 - 75 + 3
    none = toxicity_knn.fit(d, lab.where("false"))
    assert {r["score"] for r in toxicity_knn.score(d, none).collect()} == {0.0}
    assert toxicity_knn.score(docs(spark, []), index).count() == 0


# --- 1: resampling --------------------------------------------------------------------------------


def test_resampling_prefers_target_text(spark):
    good, bad = words(1, 50), words(999, 50)
    rows = [(i, " ".join((good if i % 3 else bad)[(i * 7) % 30 :][:20]), "s") for i in range(300)] + [(900, None, "s"), (None, "", "s")]
    d = docs(spark, rows).withColumn("noise", F.lit(1)).withColumn("bucket", F.lit(1))
    lab = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(150)] + [(1, None, 0), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = importance_resampling.resample(d, lab).collect()
    kept = [r["doc_id"] for r in got if r["kept"]]
    use = [i for i in range(150) if zlib.crc32(str(i).encode()) % 5]
    assert len(got) == 302 and len(kept) == round(302 * sum(i % 3 > 0 for i in use) / len(use))
    assert sum(1 for i in kept if i is not None and i < 300 and i % 3) >= 190
    few = importance_resampling.resample(d, lab, k=10).where("kept").collect()
    top = sorted(got, key=lambda r: -r["sample_key"])[:10]
    assert {r["doc_id"] for r in few} == {r["doc_id"] for r in top}
    assert importance_resampling.resample(d, lab, k=0).where("kept").count() == 0
    assert importance_resampling.resample(docs(spark, []), lab).count() == 0
    assert {r["log_weight"] for r in importance_resampling.resample(d, lab.where("false")).collect()} == {0.0}


def test_resampling_query_equals_brute_force(spark, tmp_path):
    """Weights, keys and the kept sample against plain dictionaries."""
    import struct

    import xxhash

    rows = [(i, " ".join(words(i % 11 if i % 3 else 900 + i % 5, 3 + i % 40)), "s") for i in range(120)] + [(500, None, "s"), (501, "", "s"), (502, "One two", "s")]
    labels = [(i, int(i % 3 > 0), 0) for i in range(90)]
    docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    b = importance_resampling.BUCKETS
    grams = {i: importance_resampling.ngram_buckets(t).tolist() for i, t, _ in rows}
    use = [(i, q) for i, q, _ in labels if zlib.crc32(str(i).encode()) % 5]
    raw, target = {}, {}
    for i, g in grams.items():
        for x in g:
            raw[x] = raw.get(x, 0) + 1
            target[x] = target.get(x, 0) + ((i, 1) in use)
    n_raw, n_target = sum(raw.values()), sum(target.values())
    keys = {}
    for i, g in grams.items():
        weight = sum(math.log((target[x] + 1) / (n_target + b)) - math.log((raw[x] + 1) / (n_raw + b)) for x in g)
        h = xxhash.xxh64_intdigest(struct.pack("<q", i), seed=xxhash.xxh64_intdigest(struct.pack("<i", importance_resampling.SEED), seed=42))
        keys[i] = (weight, weight - math.log(-math.log(((h >> 12) + 0.5) / 2**52)))
    k = round(sum(q for _, q in use) / len(use) * len(rows))
    kept = set(sorted(keys, key=lambda i: -keys[i][1])[:k])
    for r in importance_resampling.op1_importance_resampling(spark, str(tmp_path)).collect():
        assert (r["log_weight"], r["sample_key"]) == (pytest.approx(keys[r["doc_id"]][0], abs=1e-9), pytest.approx(keys[r["doc_id"]][1], abs=1e-9))
        assert r["kept"] == (r["doc_id"] in kept)


def test_kth_largest_is_exact(spark, monkeypatch):
    monkeypatch.setattr(importance_resampling, "FEW", 5)
    monkeypatch.setattr(importance_resampling, "CELLS", 4)
    s = spark.range(1000).select((F.pmod(F.col("id") * 7919, F.lit(500)) / 3).alias("sample_key"), F.col("id").alias("tie"))
    rows = sorted(((-r["sample_key"], r["tie"]) for r in s.collect()))
    for k in (1, 2, 250, 999, 1000):
        key, tie = importance_resampling.kth_largest(s, k)
        taken = [r for r in rows if r[0] < -key or (r[0] == -key and r[1] <= tie)]
        assert -key == rows[k - 1][0] and len(taken) in (k, k + 1)
