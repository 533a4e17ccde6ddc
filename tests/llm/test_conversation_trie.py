"""The prefix trie against a brute-force trie of Python tuples."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from strataloom.llm import conversation_trie as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def rebuild(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, x = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(r)}:{r}{x}".encode()).hexdigest(), r, x))
    turns = {c: [(t[3], t[4]) for t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + own[h:]
    return out


def brute(seqs):
    node, kids = defaultdict(list), defaultdict(set)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            node[tuple(s[:d])].append(c)
    for k in node:
        if k:
            kids[k[:-1]].add(k)
    below, out = {}, []
    for k in sorted(node, key=len, reverse=True):
        own = (len(node[k]) - 1) * len(k[-1][1].encode()) if k else 0
        below[k] = (sum(below[x][0] for x in kids[k]) or 1, own + sum(below[x][1] for x in kids[k]))
        ends = ",".join(str(c) for c in sorted(node[k]) if len(seqs[c]) == len(k))
        out.append((min(node[k]), len(k), min(node[k[:-1]]) if k else None, len(node[k]), len(kids[k]), *below[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def nodes(df, **how):
    return sorted((tuple(r) for r in T.trie(T.rebuilt(T.turns(df)), **how).collect()), key=str)


def talk(seed, n_convs, longest, words, copies):
    rng = random.Random(seed)
    rows, made = [], []
    for c in rng.sample(range(-40, 400), n_convs):
        if made and rng.random() < copies:
            turns = list(rng.choice(made))[: rng.randint(1, longest)]
        else:
            turns = [(rng.choice(["user", "assistant", None]), rng.choice(words)) for _ in range(rng.randint(1, longest))]
        made.append(turns)
        rows += [(c, i, r, x) for i, (r, x) in enumerate(turns)]
    return rows


@pytest.mark.parametrize("seed,segment,block,longest", [(1, 32, 1 << 18, 6), (2, 2, 5, 9), (3, 3, 4, 14), (4, 1, 7, 8), (5, 4, 1000, 30)])
def test_trie_equals_brute_force(spark, seed, segment, block, longest):
    rows = talk(seed, 60, longest, ["", "a", "bé", None, "long " * 9], 0.6)
    assert nodes(spark.createDataFrame(rows, SCHEMA), segment=segment, block=block) == brute(rebuild(rows))


def test_copies_over_many_blocks_are_hashed_in_order(spark):
    """Equal conversations that reach over several blocks, some of them longer, with several segments."""
    rows = [(5 * c, t, "user", str(t)) for c in range(60) for t in range(4 if c % 3 else 9)]
    for segment in (2, 4, 32):
        assert nodes(spark.createDataFrame(rows, SCHEMA), segment=segment, block=6) == brute(rebuild(rows))


def test_nulls_ties_repeats_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(T, "BUCKET", 3)
    rows = [(7, None, "user", "x"), (7, None, "user", "x"), (7, 3, None, None), (7, 3, "b", "y"), (7, -4, "u", "é" * 3), (None, 1, "user", "lost"), (5, 900, "user", "x"), (5, 1, "a", "z" * 50_000)]
    rows += [(9, t, "user", str(t % 4)) for t in range(25)] + [(-3, 2, "user", "1"), (9223372036854775807, 0, "u", "w"), (-9223372036854775808, 0, "u", "w")]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA + ", pos int, seg string")
    assert nodes(df, segment=3, block=4) == brute(rebuild(rows))


def test_turnless_conversations_are_members_of_the_root(spark):
    """Conversation 1 has fewer turns than its h and no base: nothing is left of it."""
    c = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(c, 0, "user", "gone"), (c, 1, "user", "kept?")]
    got = nodes(spark.createDataFrame(rows[:1], SCHEMA))
    assert got == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    more = [*rows[:1], (400, 0, "a", "b")]
    assert nodes(spark.createDataFrame(more, SCHEMA)) == brute(rebuild(more))


def test_empty_table(spark):
    assert nodes(spark.createDataFrame([], SCHEMA)) == []


def test_nearest_smaller_values_by_brute_force():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(50):
        k = T.Block.__new__(T.Block)
        k.lcp = rng.integers(-1, 4, rng.integers(1, 30))
        k.n = len(k.lcp)
        left, right, _ = k.nearest_smaller()
        for i, v in enumerate(k.lcp):
            assert left[i] == max((j for j in range(i) if k.lcp[j] < v), default=-1)
            assert right[i] == min((j for j in range(i + 1, k.n) if k.lcp[j] < v), default=k.n)
