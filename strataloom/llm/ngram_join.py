"""N-gram Jaccard join: an index of group-count vectors, with exact verification.

Documents are sets of hashed word n-grams (64 bits). Two documents link when
``denominator * intersection >= numerator * union``. Equal sets are one node from the start, so that
copies are never expanded into pairs.

1. Profile (scan 1): per document the set's size, its 128-bit digest and its count vector: n-grams
   are hashed to 64 groups and counted. A second, corpus-wide count over 65,536 groups is taken
   from the same scan.
2. Partition (scan 2): linked sets share at least k of their first ``n - ceil(t*n) + k`` n-grams in
   any common order; k is 1 + n/50, and the order used here is by corpus-wide group count, so that
   passages that many documents share come last and make no large partitions. Sharing n-grams only
   brings two nodes together; it decides nothing.
3. Index: the nodes of one partition are points (their count vectors); a partition is an n-gram and a
   band of set sizes, so that a hot n-gram is split: linked sets stand in one band or in neighbours, and
   each node also visits the band below its own. A packed R-tree over the points - leaves of ``LEAF``
   points, nodes of ``FANOUT`` children, each with its coordinate maxima and size range - is joined with
   itself from the root down; the overlap of two boxes, then of two points, is bounded by summed
   coordinate minima. A partition of at most ``SMALL`` points is one leaf, of which all pairs are bounded;
   such pairs must come together in k partitions. Larger partitions return the spanning edges of the
   relation only. What may link is united into clouds.
4. Verify: the clouds' n-gram sets are compared exactly, all pairs of a cloud inside tiles of bounded
   size, by products of 0/1 matrices over the n-grams that at least two members share. Each tile pair
   returns the spanning edges of its true links and the number of links of each node.
5. Components of the true links; all documents of a node get its component, named by the least doc_id
   in it. Nodes themselves are named by numbers of their own, given when their table is written.

Scale: scans never shuffle texts; what is shuffled are 15 % of the n-grams once (32 bytes each) and
the texts of nodes in clouds. A hot copy is emitted once per task and node. A large cloud is split
into tiles; a partition of more than ``STREAM_ROWS`` points is streamed in size order to its end, each point
joined to the next one in reach (no point between two that link is out of reach, so that no pair is
parted; verification is exact). Only the group counts (65,536 integers) come to the driver.

Defined results: a text with fewer words than n is one n-gram; a text without words (or null) is
empty, has size 0 and links with nothing, its component is its own doc_id. Rows that repeat a doc_id
are each returned, each with the links of its own text. Rows with a null doc_id are returned with a null component and link with nothing.
Empty tables give an empty result. Extra columns are carried by ``keep_one`` and ignored by ``join``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.llm.common import cut, fresh, stored, table, words_of

GROUPS = 64
CORPUS_GROUPS = 1 << 16
LEAF = 32
FANOUT = 16
SMALL = 256
BATCH_ROWS = 20_000
STREAM_ROWS = 50_000
TILE_NODES = 2048
EVEN_NODES, EVEN_TILES = 256, 8
TILE_NGRAMS = 4_000_000
BROADCAST_ROWS = 1_000_000
_M = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], dtype=np.uint64)
_VEC = [f"v{i}" for i in range(GROUPS // 8)]


def ngram_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; with fewer words the whole sequence as one."""
    w = words_of(text)
    if not w:
        return np.zeros(0, np.uint64)
    k = min(n, len(w))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), dtype=np.uint64, count=len(w))
    m = len(w) - k + 1
    s = np.full(m, k, dtype=np.uint64)
    for i in range(k):
        s = (s ^ (h[i : i + m] * _M[i])) * _M[(i + 3) % 8]
        s ^= s >> np.uint64(29)
    s *= _M[6]
    s ^= s >> np.uint64(32)
    return np.unique(s)


def least_shared(n):
    """How many n-grams two linked sets share in their prefixes, n being the smaller size."""
    return 1 + n // 50


def prefix_size(n: int, num: int, den: int) -> int:
    return min(n, n - -(-num * n // den) + least_shared(n))


def count_vector(s: np.ndarray) -> tuple[np.ndarray, int]:
    """(64 counts divided by the scale and rounded up, scale): counts * scale bounds the true counts."""
    c = np.bincount((s >> np.uint64(58)).astype(np.int64), minlength=GROUPS)
    scale = max(1, -(-int(c.max()) // 255)) if len(s) else 1
    return (-(-c // scale)).astype(np.uint8), scale


def _profile(docs: DataFrame, n: int) -> DataFrame:
    """Rows of documents (doc_id, size, d1, d2, scale, v0..v7) and of group counts (cell, cells)."""
    schema = "doc_id bigint, text_hash bigint, size int, d1 bigint, d2 bigint, scale int, " + ", ".join(f"{v} bigint" for v in _VEC) + ", cell int, cells bigint"

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus = np.zeros(CORPUS_GROUPS, np.int64)
        for b in batches:
            ids = b.column(0)
            k = len(ids)
            size, dig, scale, vec = np.zeros(k, np.int32), np.zeros((k, 2), np.int64), np.ones(k, np.int32), np.zeros((k, GROUPS), np.uint8)
            for i, text in enumerate(b.column(1).to_pylist()):
                s = ngram_set(text, n)
                if len(s):
                    size[i] = len(s)
                    dig[i] = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8")
                    vec[i], scale[i] = count_vector(s)
                    corpus += np.bincount((s & np.uint64(CORPUS_GROUPS - 1)).astype(np.int64), minlength=CORPUS_GROUPS)
            packed = vec.view("<i8").reshape(k, GROUPS // 8)
            cols = [ids, b.column(2), pa.array(size), pa.array(dig[:, 0].copy()), pa.array(dig[:, 1].copy()), pa.array(scale), *[pa.array(packed[:, i].copy()) for i in range(GROUPS // 8)]]
            none = [pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64())]
            yield pa.RecordBatch.from_arrays([*cols, *none], ["doc_id", "text_hash", "size", "d1", "d2", "scale", *_VEC, "cell", "cells"])
        at = np.flatnonzero(corpus)
        k = len(at)
        blank = [pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), *[pa.nulls(k, pa.int64()) for _ in _VEC]]
        yield pa.RecordBatch.from_arrays([*blank, pa.array(at.astype(np.int32)), pa.array(corpus[at])], ["doc_id", "text_hash", "size", "d1", "d2", "scale", *_VEC, "cell", "cells"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(rows, schema)


def _postings(docs: DataFrame, n: int, num: int, den: int, corpus: np.ndarray) -> DataFrame:
    """(gram, d1, d2): the prefix n-grams of each node, once per task."""
    sent = docs.sparkSession.sparkContext.broadcast(corpus)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        counts = sent.value
        for b in batches:
            grams, digs, reps = [], [], []
            for text in b.column(0).to_pylist():
                s = ngram_set(text, n)
                if not len(s):
                    continue
                d = xxhash.xxh3_128_digest(s.tobytes())
                if d in seen:
                    continue
                seen.add(d)
                p = prefix_size(len(s), num, den)
                weight = counts[(s & np.uint64(CORPUS_GROUPS - 1)).astype(np.int64)]
                grams.append(s[np.argsort(weight, kind="stable")[:p]])
                digs.append(d)
                reps.append(p)
            g = np.concatenate(grams).view(np.int64) if grams else np.zeros(0, np.int64)
            two = np.repeat(np.frombuffer(b"".join(digs), "<i8").reshape(-1, 2), reps, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(two[:, 0].copy()), pa.array(two[:, 1].copy())], ["gram", "d1", "d2"])

    return docs.where("doc_id is not null").select("text").mapInArrow(rows, "gram bigint, d1 bigint, d2 bigint")


def _runs(key: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)


def _shared(postings: DataFrame) -> DataFrame:
    """The postings of n-grams that at least two nodes hold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the last row so far, and whether it was emitted already
        sent = False
        for b in batches:
            if not b.num_rows:
                continue
            a = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            if last is not None:
                a = np.vstack([last[None], a])
            new = np.r_[True, (a[1:] != a[:-1]).any(axis=1)]  # the same node from two tasks counts once
            if last is not None:
                head_sent = sent
            else:
                head_sent = False
            u = a[new]
            same_next = np.r_[u[1:, 0] == u[:-1, 0], False]
            same_prev = np.r_[False, same_next[:-1]]
            keep = same_next | same_prev
            out = u[keep & ~np.r_[head_sent, np.zeros(len(u) - 1, bool)]]
            last = u[-1]
            sent = bool(keep[-1]) or (len(u) == 1 and head_sent)
            if len(out):
                yield pa.RecordBatch.from_arrays([pa.array(out[:, i].copy()) for i in range(3)], ["gram", "d1", "d2"])

    return postings.repartition("gram").sortWithinPartitions("gram", "d1", "d2").mapInArrow(rows, "gram bigint, d1 bigint, d2 bigint")


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def may_link(size_a: np.ndarray, size_b: np.ndarray, overlap: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether an overlap of at most ``overlap`` can reach the threshold."""
    return (den + num) * overlap >= num * (size_a + size_b)


def tree_edges(size: np.ndarray, vec: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Spanning edges of the may-link relation of points (ascending size), by a packed R-tree.

    The tree is joined with itself level by level from its root; pairs of leaves whose points are in
    one component already are not opened.
    """
    k = len(size)
    starts = np.arange(0, k, LEAF)
    levels = [(np.maximum.reduceat(vec, starts), size[starts], np.maximum.reduceat(size, starts))]
    while len(levels[-1][1]) > 1:
        top, lo, hi = levels[-1]
        at = np.arange(0, len(lo), FANOUT)
        levels.append((np.maximum.reduceat(top, at), lo[at], np.maximum.reduceat(hi, at)))
    i = j = np.zeros(1, np.int64)
    for below in reversed(range(len(levels))):
        top, lo, hi = levels[below]
        if below < len(levels) - 1:  # the children of each pair
            n, m = len(lo), np.arange(FANOUT)
            a, b = (i[:, None] * FANOUT + m).clip(max=n), (j[:, None] * FANOUT + m).clip(max=n)
            i, j = np.repeat(a, FANOUT, axis=1).ravel(), np.tile(b, (1, FANOUT)).ravel()
            i, j = i[(keep := (i <= j) & (j < n))], j[keep]
        ok = lo[j] * num <= hi[i] * den  # sizes ascend with the position: some pair is in reach
        i, j = i[ok], j[ok]
        ok = np.zeros(len(i), bool)
        for c in range(0, len(i), 20_000):
            x, y = i[c : c + 20_000], j[c : c + 20_000]
            ok[c : c + 20_000] = may_link(lo[x], lo[y], np.minimum(top[x], top[y]).sum(axis=1), num, den)
        i, j = i[ok], j[ok]
    u, edges = _Union(k), []
    one: dict[int, bool] = {}  # leaves whose points are one component, as found so far

    def united(leaf: int) -> bool:
        if not one.get(leaf):
            s = leaf * LEAF
            root = u.find(s)
            one[leaf] = all(u.find(x) == root for x in range(s + 1, min(s + LEAF, k)))
        return one[leaf]

    o = np.lexsort((i, j - i))  # near leaves first: they unite soonest
    for x, y in zip(i[o].tolist(), j[o].tolist(), strict=True):
        s, t = x * LEAF, y * LEAF
        if u.find(s) == u.find(t) and united(x) and united(y):
            continue
        a_size, b_size = size[s : s + LEAF], size[t : t + LEAF]
        over = np.minimum(vec[s : s + LEAF, None, :], vec[None, t : t + LEAF, :]).sum(axis=2)
        ok = may_link(a_size[:, None], b_size[None, :], over, num, den) & (a_size[:, None] * den >= b_size[None, :] * num) & (b_size[None, :] * den >= a_size[:, None] * num)
        for p, q in zip(*(v.tolist() for v in np.nonzero(ok)), strict=True):
            if p + s < q + t and u.join(p + s, q + t):
                edges.append((p + s, q + t))
    return edges


def band_of(size, num: int, den: int):
    """Bands of set sizes (a column): sets that link are in one band or in neighbours."""
    if num == den:
        return size.cast("int")
    return F.floor(F.log(size.cast("double")) / (math.log(den / num) * (1 + 1e-9))).cast("int")


def _cloud_edges(points: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): pairs that may link, complete up to the spanning edges of large partitions.

    points: rows (part, node, size, own, scale, v0..v7) sorted by part, size, node inside partitions.
    A pair of small partitions counts its partitions, once for each n-gram (where the smaller set is in
    its own band), one of a large partition stands by itself. A linked pair either has all the
    n-grams it must share in small partitions, or meets in a large one.
    """
    names = ["part", "node", "size", "own", "scale", *_VEC]
    schema = "a bigint, b bigint, n bigint, shared bigint, large boolean"

    def solve(a: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Edges of the complete runs in a (columns as in names); a is sorted by part, size."""
        vec = np.ascontiguousarray(a[:, 5:]).view(np.uint8).reshape(len(a), GROUPS).astype(np.int32) * a[:, 4:5].astype(np.int32)
        starts = _runs(a[:, 0])
        length = np.diff(np.r_[starts, len(a)])
        out = []
        small = np.repeat(length <= SMALL, length)
        at = np.flatnonzero(small & (a[:, 3] > 0))
        for lag in range(1, SMALL):
            at = at[at + lag < len(a)]
            at = i = at[(a[at + lag, 0] == a[at, 0]) & (a[at + lag, 2] * num <= a[at, 2] * den)]  # sizes ascend: no later lag reaches
            if not len(i):
                break
            for c in range(0, len(i), 20_000):
                x = i[c : c + 20_000]
                ok = x[may_link(a[x, 2], a[x + lag, 2], np.minimum(vec[x], vec[x + lag]).sum(axis=1), num, den)]
                out.append(np.stack([np.minimum(a[ok, 1], a[ok + lag, 1]), np.maximum(a[ok, 1], a[ok + lag, 1]), a[ok, 2]], axis=1))
        if out:
            pairs, count = np.unique(np.concatenate(out), axis=0, return_counts=True)
            yield emit(pairs, count, False)
        for s, k in zip(starts[length > SMALL], length[length > SMALL], strict=True):
            e = np.array(tree_edges(a[s : s + k, 2], vec[s : s + k], num, den), dtype=np.int64).reshape(-1, 2) + s
            yield emit(np.stack([a[e[:, 0], 1], a[e[:, 1], 1], a[e[:, 0], 2]], axis=1), np.ones(len(e), np.int64), True)

    def emit(pairs: np.ndarray, count: np.ndarray, large: bool) -> pa.RecordBatch:
        cols = [pa.array(pairs[:, i].copy()) for i in range(3)]
        return pa.RecordBatch.from_arrays([*cols, pa.array(count.astype(np.int64)), pa.array(np.full(len(pairs), large))], ["a", "b", "n", "shared", "large"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n_held = 0
        streamed = False  # the held rows begin with the last row of a very large partition united so far

        def chain(a: np.ndarray) -> pa.RecordBatch:
            """Edges of rows in size order, without the index: no row between two that link is out of reach."""
            near = np.flatnonzero(a[1:, 2] * num <= a[:-1, 2] * den)
            return emit(np.stack([a[near, 1], a[near + 1, 1], a[near, 2]], axis=1), np.ones(len(near), np.int64), True)

        for b in batches:
            if not b.num_rows:
                continue
            held.append(np.stack([b.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1).astype(np.int64))
            n_held += b.num_rows
            if n_held < BATCH_ROWS:
                continue
            a = np.concatenate(held)
            starts = _runs(a[:, 0])
            if streamed and len(starts) > 1:  # the very large partition ends here
                yield chain(a[: starts[1]])
                a, starts, streamed = a[starts[1] :], starts[1:] - starts[1], False
            cut_at = int(starts[-1])  # the last run may go on
            if cut_at:
                yield from solve(a[:cut_at])
                a = a[cut_at:]
            if streamed or len(a) > STREAM_ROWS:  # a very large partition: united in size order to its end
                yield chain(a)
                a, streamed = a[-1:], True
            held, n_held = [a], len(a)
        if held:
            a = np.concatenate(held)
            if streamed:
                end = int(np.searchsorted(a[:, 0], a[0, 0], side="right"))
                yield chain(a[:end])
                a = a[end:]
            if len(a):
                yield from solve(a)

    found = points.select(*names).mapInArrow(rows, schema)
    both = found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "n", "shared", "large").groupBy("a", "b")
    met = both.agg(F.min("n").alias("n"), F.sum("shared").alias("shared"), F.max("large").alias("large"))
    return met.where(F.col("large") | (F.col("shared") >= F.lit(1) + F.floor(F.col("n") / 50))).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes in edges (a, b): root is the smallest node of the component.

    Alternating large-star and small-star steps until the edges no longer change.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(low, "a")
        e = cut(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = e.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return cut(e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots))


def tile_links(sets: list[np.ndarray], side: np.ndarray, num: int, den: int) -> np.ndarray:
    """0/1 matrix of the exact links between sets; where side differs, only pairs across it count.

    side: the tile (0 or 1) of each set, all 0 for a tile with itself.
    """
    size = np.array([len(s) for s in sets], dtype=np.int64)
    grams = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), size)
    u, inverse, count = np.unique(grams, return_inverse=True, return_counts=True)
    used = count[inverse] >= 2
    column = np.cumsum(count >= 2) - 1
    inverse, owner = column[inverse[used]], owner[used]
    n_columns = int((count >= 2).sum())
    rows_, cols_ = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if side.any() else (np.arange(len(sets)), np.arange(len(sets)))
    over = np.zeros((len(rows_), len(cols_)), dtype=np.float32)
    order = np.argsort(inverse, kind="stable")
    inverse, owner = inverse[order], owner[order]
    step = max(256, min(4096, (8 << 20) // max(1, len(sets))))
    for c in range(0, n_columns, step):
        lo, hi = np.searchsorted(inverse, [c, c + step])
        x = np.zeros((len(sets), min(step, n_columns - c)), dtype=np.float32)
        x[owner[lo:hi], inverse[lo:hi] - c] = 1.0
        over += x[rows_] @ x[cols_].T
    ok = may_link(size[rows_][:, None], size[cols_][None, :], over.astype(np.int64), num, den) & (over > 0)
    if not side.any():
        np.fill_diagonal(ok, False)
    return ok


def spanning(ok: np.ndarray, rows_: np.ndarray, cols_: np.ndarray, n: int) -> np.ndarray:
    """The first member of each of n members' component under the links ok (rows_ x cols_)."""
    root = np.arange(n)
    open_rows, open_cols = np.ones(len(rows_), bool), np.ones(len(cols_), bool)
    same = len(rows_) == len(cols_) and np.array_equal(rows_, cols_)
    while open_rows.any():
        r = np.zeros(len(rows_), bool)
        r[np.argmax(open_rows)] = True
        seen_r, seen_c = r.copy(), r.copy() if same else np.zeros(len(cols_), bool)
        while r.any():
            c = ok[r].any(axis=0) & ~seen_c
            seen_c |= c
            r = (c if same else ok[:, c].any(axis=1)) & ~seen_r
            seen_r |= r
        members = rows_[seen_r] if same else np.concatenate([rows_[seen_r], cols_[seen_c]])
        root[members] = members.min()
        open_rows &= ~seen_r
        open_cols &= ~seen_c
    return root


def _verify(members: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """From rows (cloud, i, j, tile, node, copies, d1, text): (a, b, links) - a spanning edge of the
    true links (b null if none), and how many documents node a links with in this tile pair."""

    def solve(got: dict[int, tuple[int, int, np.ndarray]], i: int, j: int) -> Iterator[tuple[int, int | None, int]]:
        nodes = sorted(got, key=lambda r: (got[r][0], r))
        if len(nodes) < 2:
            return
        side = np.array([int(got[r][0] != i) for r in nodes])
        if i != j and (side.all() or not side.any()):
            return
        ok = tile_links([got[r][2] for r in nodes], side, num, den)
        every = np.arange(len(nodes))
        rows_, cols_ = (every[side == 0], every[side == 1]) if i != j else (every, every)
        copies = np.array([got[r][1] for r in nodes], dtype=np.int64)
        links = np.zeros(len(nodes), np.int64)
        links[rows_] += ok @ copies[cols_]
        if i != j:
            links[cols_] += ok.T @ copies[rows_]
        root = spanning(ok, rows_, cols_, len(nodes))
        for x in np.flatnonzero(links).tolist():
            yield nodes[x], nodes[root[x]] if root[x] != x else None, int(links[x])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, got = None, {}

        def emit(out: list[tuple[int, int | None, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([o[x] for o in out], pa.int64()) for x in range(3)], ["a", "b", "links"])

        for b in batches:
            out: list[tuple[int, int | None, int]] = []
            c = {name: b.column(name).to_pylist() for name in ("cloud", "i", "j", "tile", "node", "copies", "d1", "text")}
            for cloud, i, j, tile, node, copies, d1, text in zip(*c.values(), strict=True):
                if (cloud, i, j) != key:
                    if key is not None:
                        out.extend(solve(got, key[1], key[2]))
                    key, got = (cloud, i, j), {}
                if node in got:  # a row repeated in full
                    continue
                s = ngram_set(text, n)
                if len(s) and int(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8")[0]) == d1:
                    got[node] = (tile, copies, s)
            yield emit(out)
        if key is not None:
            yield emit(list(solve(got, key[1], key[2])))

    return members.mapInArrow(rows, "a bigint, b bigint, links bigint")


def join(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links (other documents it links with) of every row."""
    return _joined(docs, n, num, den).drop("text_hash")


def _joined(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """join() with text_hash, the xxhash64 of the row's text."""
    profile = stored(_profile(docs, n), "ngram-profile")
    cells = profile.where("cell is not null").groupBy("cell").agg(F.sum("cells").alias("n")).collect()  # at most CORPUS_GROUPS rows
    corpus = np.zeros(CORPUS_GROUPS, np.int64)
    for r in cells:
        corpus[r["cell"]] = r["n"]
    rows = profile.where("size is not null")
    named = rows.where("size > 0 and doc_id is not null")
    sets = named.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.count_distinct("doc_id").alias("copies"), F.first("size").alias("size"), F.first("scale").alias("scale"), *[F.first(v).alias(v) for v in _VEC])
    # a node's number: two sets may have one least doc_id, if rows repeat it with other texts
    nodes = stored(sets.withColumn("node", F.monotonically_increasing_id()), "ngram-nodes")
    shared = _shared(_postings(docs, n, num, den, corpus))
    points = shared.join(nodes, ["d1", "d2"]).withColumn("band", band_of(F.col("size"), num, den))
    visits = F.array(F.struct(F.col("band"), F.lit(1).alias("own")), *([F.struct((F.col("band") - 1).alias("band"), F.lit(0).alias("own"))] if num < den else []))
    points = points.select("gram", "node", "size", "scale", *_VEC, F.inline(visits)).withColumn("part", F.xxhash64("gram", "band"))
    points = points.select("part", "node", "size", "own", "scale", *_VEC).repartition("part").sortWithinPartitions("part", "size", "node")
    clouds = components(_cloud_edges(points, num, den)).withColumnRenamed("root", "cloud")
    members = clouds.join(nodes.select("node", "rep", "copies", "size", "d1"), "node")
    tiles = members.groupBy("cloud").agg(F.count(F.lit(1)).alias("m"), F.sum("size").alias("w"))
    even = F.least(F.lit(float(EVEN_TILES)), F.col("m") / EVEN_NODES)  # a cloud of some size is work for several tasks
    tiles = tiles.select("cloud", F.ceil(F.greatest(F.col("m") / TILE_NODES, F.col("w") / TILE_NGRAMS, even)).cast("int").alias("tiles"))
    members = members.join(tiles, "cloud").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    members = cut(members.select("node", F.col("rep").alias("_rep"), "copies", "d1", "cloud", "tile", other))
    members = members.select("_rep", "node", "copies", "d1", "cloud", "tile", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"))
    if members.count() <= BROADCAST_ROWS:  # at most 64 MB: the texts need no shuffle to find their clouds
        members = F.broadcast(members)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(members, F.col("doc_id") == F.col("_rep"))
    texts = texts.select("cloud", "i", "j", "tile", "node", "copies", "d1", "text").repartition("cloud", "i", "j").sortWithinPartitions("cloud", "i", "j", "node")
    verified = cut(_verify(texts, n, num, den))
    links = verified.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "node")
    roots = components(verified.where("b is not null").select("a", "b"))
    named = roots.join(nodes.select("node", "rep"), "node").groupBy("root").agg(F.min("rep").alias("component"))
    found = nodes.select("node", "d1", "d2", "rep", "copies").join(links, "node", "left").join(roots, "node", "left").join(named, "root", "left")
    found = found.select(F.col("d1").alias("_d1"), F.col("d2").alias("_d2"), F.coalesce("component", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    usable = (F.col("size") > 0) & F.col("doc_id").isNotNull()
    out = rows.withColumn("_usable", usable).join(found, F.col("_usable") & (F.col("d1") == F.col("_d1")) & (F.col("d2") == F.col("_d2")), "left")
    return out.select("doc_id", "text_hash", F.col("size").cast("bigint").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"))


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs (all columns) with the smallest doc_id of each component, and all unlinked rows."""
    a, b = fresh(docs, "_gone"), fresh(docs, "_gone_text")
    gone = _joined(docs, n, num, den).where("component_id <> doc_id").select(F.col("doc_id").alias(a), F.col("text_hash").alias(b)).distinct()
    return docs.join(gone, (F.col("doc_id") == F.col(a)) & (F.xxhash64("text") == F.col(b)), "left_anti")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


OP3_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), g AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS g FROM d)
), s AS (
  SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)
), r AS (
  SELECT doc_id AS node, doc_id AS root FROM d
  UNION
  SELECT l.b, r.root FROM r JOIN l ON l.a = r.node
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, c.component_id, coalesce(k.n_links, 0)::BIGINT AS n_links
FROM d LEFT JOIN s USING (doc_id)
JOIN (SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY node) c USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM l GROUP BY a) k USING (doc_id)
"""
