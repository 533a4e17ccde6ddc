"""Prefix trie of conversations: a Cartesian tree over the LCP array of the sorted conversations.

1. A turn is the first 16 bytes of the SHA-256 of its role and text, with the UTF-8 size of the text;
   texts are read once and never shuffled. Positions of turns are ranks inside buckets of
   ``BUCKET`` turn numbers, plus the counts of the buckets before.
2. A conversation is cut into segments of ``SEGMENT`` turns, one row each, with the class of all turns
   before the segment (a running exclusive-or of the segments' hashes). Segments are range-sorted by
   (segment, class, turns, conversation), so that equal prefixes are neighbours: every class is a tree
   of its own that hangs below a full segment. A conversation of a multiple of SEGMENT turns has an
   empty last segment.
3. Inside a block (one range partition) neighbours get their longest common prefix (LCP). Nearest
   smaller values on both sides give the intervals of the Cartesian tree; positions of equal LCP are
   one node. What a block cannot see is answered by the blocks' summaries: per depth, the last and
   first position of the block with a smaller LCP, and what lies beyond it (minima of conv_id, counts,
   sums). There are at most SEGMENT + 1 depths, so a summary has a fixed size, and the driver only
   ever holds these summaries (about 4 KB a block).
4. A node is an interval [l, r] with a range of depths (parent's LCP, own LCP]; the missing depths are
   expanded, and every figure is a difference of prefix sums over the sorted rows:
   saved_tokens = sum over (l, r] of the bytes that a row shares with the row before it, less those
   above the node; leaves = rows less those that the next row continues.
5. Segments after the first are counted once, by the smallest conversation of their tree, and added to
   all rows of that conversation above it.

Skew: equal conversations differ in their ids, so that a group of copies is spread over blocks; a long
conversation is spread over segments. ``ends_sha256`` of copies that reach over the end of a block
is hashed in one task from one comma-joined piece a block, piece by piece.

Defined results: turns are ordered by number (null first), then by the hash of role and text; repeated
rows are repeated turns; null roles and texts are empty. Rows without conv_id belong to no
conversation and are left out. An empty table has no node, not even a root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataloom.llm.common import stored, table

SEGMENT, BUCKET, BLOCK = 32, 4096, 1 << 18
NODE_SCHEMA = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"
_BIG = np.int64(np.iinfo(np.int64).max)
_EMPTY = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, key, size) of each row: what the trie needs of a turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    return conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), key.alias("key"), F.octet_length(text).cast("bigint").alias("size"))


def _h(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


def _total(conv_id: Column, n: Column, m: Column) -> Column:
    """Turns of a rebuilt conversation of n turns whose base has m."""
    return F.least(_h(conv_id), m) + F.greatest(n - _h(conv_id), F.lit(0))


def rebuilt(turn_rows: DataFrame) -> DataFrame:
    """(conv_id, total, pos, key, size): the first crc32(conv_id) % 9 turns of conversation
    conv_id - conv_id % 5, then the conversation's own turns after as many; and one row of null pos for each
    conversation.

    The conversations of one base are nine at most. Their sizes meet in the table of bucket counts; a
    turn then knows its places in all conversations that take it.
    """
    rows = turn_rows.withColumn("bucket", F.floor(F.col("turn") / BUCKET))
    counts = rows.groupBy("conv_id", "bucket").count().withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    by_conv, by_base = Window.partitionBy("base", "conv_id"), Window.partitionBy("base")
    before = F.sum("count").over(by_conv.orderBy(F.col("bucket").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumns({"n": F.sum("count").over(by_conv), "before": F.coalesce(before, F.lit(0))})
    is_base = F.col("conv_id") == F.col("base")
    counts = counts.withColumns({"m": F.coalesce(F.max(F.when(is_base, F.col("n"))).over(by_base), F.lit(0)), "members": F.collect_set(F.struct("conv_id", "n")).over(by_base)})
    offsets = counts.select("conv_id", "bucket", "before", "n", "m", F.when(is_base & (F.col("before") < 8), F.col("members")).alias("members"))
    in_bucket = Window.partitionBy("conv_id", "bucket").orderBy(F.col("turn").asc_nulls_first(), "key")
    r, o = rows.withColumn("at", F.row_number().over(in_bucket)).alias("r"), offsets.alias("o")
    met = r.join(o, (F.col("r.conv_id") == F.col("o.conv_id")) & F.col("r.bucket").eqNullSafe(F.col("o.bucket"))).select("r.conv_id", "key", "size", (F.col("at") + F.col("before")).alias("pos"), "n", "m", "members")
    c, pos, h = F.col("conv_id"), F.col("pos"), _h(F.col("conv_id"))
    row = lambda conv, total, at, key, size: F.struct(conv.alias("conv_id"), total.alias("total"), at.alias("pos"), key.alias("key"), size.alias("size"))
    total = _total(c, F.col("n"), F.col("m"))
    own = F.when(pos > h, row(c, total, F.least(h, F.col("m")) + pos - h, F.col("key"), F.col("size")))
    mark = F.when(pos == 1, row(c, total, F.lit(None).cast("bigint"), F.lit(None).cast("binary"), F.lit(None).cast("bigint")))
    heads = F.transform(F.filter("members", lambda x: pos <= _h(x["conv_id"])), lambda x: row(x["conv_id"], _total(x["conv_id"], x["n"], F.col("m")), pos, F.col("key"), F.col("size")))
    return met.select(F.inline(F.concat(F.array_compact(F.array(own, mark)), F.coalesce(heads, F.array_compact(F.array(F.when(F.lit(False), own)))))))


def segments(sequences: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation and segment, with its turns' keys and text sizes."""
    seg = F.coalesce(F.expr(f"(pos - 1) div {segment}"), F.expr(f"total div {segment}"))
    own = sequences.where(f"pos IS NOT NULL OR total % {segment} = 0").groupBy("conv_id", seg.alias("seg")).agg(F.first("total").alias("total"), F.sort_array(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "key", "size")))).alias("t"))
    return stored(own.select("conv_id", "seg", "total", F.col("t.key").alias("keys"), F.col("t.size").alias("sizes")), "trie-segments")


def classed(flat: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Adds to segments whether the conversation goes on after them, and the class of the turns before
    (p1, p2) and up to their end (q1, q2)."""
    full, none = F.size("keys") == segment, F.lit(0).cast("bigint")
    hashes = flat.where(f"total >= {segment}").select("conv_id", "seg", F.when(full, F.xxhash64("seg", "keys")).otherwise(none).alias("x1"), F.when(full, F.xxhash64(F.lit("second"), "keys", "seg")).otherwise(none).alias("x2"))
    w = Window.partitionBy("conv_id").orderBy("seg")
    upto, prior = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.unboundedPreceding, -1)
    classes = hashes.select("conv_id", "seg", *[F.coalesce(F.bit_xor(f"x{i}").over(span), none).alias(f"{c}{i}") for c, span in (("p", prior), ("q", upto)) for i in (1, 2)])
    many = flat.where(f"total >= {segment}").join(classes, ["conv_id", "seg"])
    one = flat.where(f"total < {segment}").withColumns({c: none for c in ("p1", "p2", "q1", "q2")})
    return many.unionByName(one).withColumn("more", F.col("total") > (F.col("seg") + 1) * segment)


def _lcp(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differs = np.flatnonzero((a[:n] != b[:n]).any(axis=1)) if n else np.zeros(0)
    return int(differs[0]) if len(differs) else n


def _keys(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint64).reshape(-1, 2) if values else np.zeros((0, 2), np.uint64)


def sorted_blocks(segs: DataFrame, n_blocks: int) -> DataFrame:
    """The segments in sorted order, with their block, their place in it and their LCP with the row
    before (null at the start of a block; -1 where a new class starts)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, idx, before, names = TaskContext.get().partitionId(), 0, None, None
        for b in batches:
            lcps, lens, prev = [], [], []
            names = names or b.schema.names
            for s, p1, p2, keys in zip(*(b.column(c).to_pylist() for c in ("seg", "p1", "p2", "keys")), strict=True):
                now = (s, p1, p2), _keys(keys)
                lcps.append(None if before is None else -1 if before[0] != now[0] else _lcp(before[1], now[1]))
                lens.append(len(keys))
                prev.append(None if before is None else len(before[1]))
                before = now
            n = len(lcps)
            more = [pa.array(np.full(n, block, np.int32)), pa.array(np.arange(idx, idx + n)), pa.array(lcps, pa.int32()), pa.array(lens, pa.int32()), pa.array(prev, pa.int32())]
            yield pa.RecordBatch.from_arrays([*b.columns, *more], [*names, "block", "idx", "lcp", "len", "prev_len"])
            idx += n

    cols = segs.select("conv_id", "seg", "p1", "p2", "q1", "q2", "keys", "sizes", "more")
    order = ["seg", "p1", "p2", "keys", "more", "conv_id"]
    dealt = cols.repartitionByRange(n_blocks, *order).sortWithinPartitions(*order)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cols.schema) + ", block int, idx bigint, lcp int, len int, prev_len int"
    return stored(dealt.mapInArrow(scan, schema), "trie-sorted")


def first_lcps(rows: DataFrame) -> dict[int, dict]:
    """Per block that has rows, in order: LCP of its first row with the last row before, and that row's
    length. One row a block comes to the driver, of at most two segments."""
    side = F.struct("seg", "p1", "p2", "keys")
    ends = rows.groupBy("block").agg(F.min_by(side, "idx").alias("a"), F.max_by(side, "idx").alias("z"), F.count("*").alias("n"))
    out, before = {}, None
    for r in sorted(ends.collect(), key=lambda r: r["block"]):
        a = r["a"]
        same = before is not None and (before["seg"], before["p1"], before["p2"]) == (a["seg"], a["p1"], a["p2"])
        out[r["block"]] = {"lcp": _lcp(_keys(before["keys"]), _keys(a["keys"])) if same else -1, "prev_len": len(before["keys"]) if before else -1, "n": r["n"]}
        before = r["z"]
    return out


def _with_first(rows: DataFrame, firsts: dict[int, dict]) -> DataFrame:
    """rows with their LCP at block starts too, and the length of the row before."""
    edge = rows.sparkSession.createDataFrame([(b, 0, f["lcp"], f["prev_len"]) for b, f in firsts.items()], "block int, idx bigint, first_lcp int, first_prev int")
    met = rows.join(F.broadcast(edge), ["block", "idx"], "left")
    return met.withColumns({"lcp": F.coalesce("lcp", "first_lcp"), "prev_len": F.coalesce("prev_len", "first_prev")}).drop("first_lcp", "first_prev")


def below(rows: DataFrame, firsts: dict[int, dict], segment: int) -> DataFrame:
    """For rows of conversations with several segments: what hangs below their segment.

    (conv_id, seg, kids, saved, leaves): children of the tree that continues the row's full segment, and
    the totals of all deeper trees whose smallest conversation this is.
    """
    deep = _with_first(rows.where("seg > 0"), firsts)
    shared = F.when(F.col("lcp") > 0, F.expr("aggregate(slice(sizes, 1, greatest(lcp, 0)), 0L, (a, x) -> a + x)")).otherwise(F.lit(0))
    trees = deep.groupBy("seg", "p1", "p2").agg(
        F.min("conv_id").alias("rep"),
        F.sum(shared).alias("saved"),
        (F.count("*") - F.sum(((F.col("lcp") >= 0) & (F.col("lcp") == F.col("prev_len"))).cast("bigint")) - F.sum(((F.col("len") == segment) & (F.col("lcp") < segment)).cast("bigint"))).alias("leaves"),
        (F.sum((F.col("lcp") == 0).cast("bigint")) + 1 - F.sum((F.col("len") == 0).cast("bigint"))).alias("kids"),
    )
    mine = rows.where("seg > 0").select("conv_id", "seg", "p1", "p2").join(trees, ["seg", "p1", "p2"])
    is_rep = F.col("conv_id") == F.col("rep")
    held = mine.select("conv_id", "seg", "kids", F.when(is_rep, F.col("saved")).otherwise(0).alias("s"), F.when(is_rep, F.col("leaves")).otherwise(0).alias("l"))
    # a row of seg s needs kids of s + 1 and the sums of all later segments: both stand at s + 1
    later = Window.partitionBy("conv_id").orderBy(F.col("seg").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return held.select("conv_id", (F.col("seg") - 1).alias("seg"), "kids", F.sum("s").over(later).alias("saved"), F.sum("l").over(later).alias("leaves"))


class Block:
    """The rows of one block as arrays, with all that its own rows say."""

    def __init__(self, t: pa.Table, first: dict, segment: int):
        t = t.sort_by("idx")
        col = lambda c: t.column(c).combine_chunks()
        num = lambda c: col(c).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.segment, self.n = segment, t.num_rows
        self.conv, self.seg, self.len, self.kids = num("conv_id"), num("seg"), num("len"), num("kids")
        self.lcp = num("lcp")
        self.lcp[0] = first["lcp"]
        self.elen = np.where(col("more").to_numpy(zero_copy_only=False), -1, self.len)
        sizes = col("sizes")
        self.off = np.r_[0, np.cumsum(self.len)]
        self.cum = np.r_[0, np.cumsum(sizes.flatten().to_numpy(zero_copy_only=False).astype(np.int64))]
        prev_len = np.r_[first["prev_len"], self.len[:-1]]
        # sums over (l, r]: shared bytes and rows less continued ones; at l itself without the latter
        self.saved_at, self.leaf_at = num("saved"), 1 - ((self.len == segment) & (self.lcp < segment)) + num("leaves")
        self.saved = self.saved_at + self.bytes_above(np.arange(self.n), np.maximum(self.lcp, 0))
        self.leaf = self.leaf_at - ((self.lcp >= 0) & (self.lcp == prev_len))
        self.sums = np.r_[0, np.cumsum(self.saved)], np.r_[0, np.cumsum(self.leaf)]
        self.by_lcp = np.sort((self.lcp + 1) * (self.n + 1) + np.arange(self.n))
        self.by_elen = np.sort((self.elen + 1) * (self.n + 1) + np.arange(self.n))
        # rows that go on with the run of equal, ending conversations of the row before
        self.goes_on = np.r_[False, (self.elen[1:] >= 0) & (self.elen[1:] == self.elen[:-1]) & (self.lcp[1:] == self.len[1:])]

    def bytes_above(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Text bytes of the first depth turns of rows' segments."""
        return self.cum[self.off[row] + depth] - self.cum[self.off[row]]

    def count(self, index: np.ndarray, value: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """How many rows of [lo, hi) have the value, by binary search."""
        base = (value + 1) * (self.n + 1)
        return np.searchsorted(index, base + hi) - np.searchsorted(index, base + lo)

    def nearest_smaller(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each row: nearest row on the left and on the right with a smaller LCP (-1, n: none in the
        block), and the first row of its group of equal LCP."""
        left, right, lead = np.full(self.n, -1), np.full(self.n, self.n), np.arange(self.n)
        lcp, stack = self.lcp.tolist(), []
        ends = {}  # of a group on the stack: its last row so far
        for i, v in enumerate(lcp):
            while stack and lcp[stack[-1]] > v:
                right[stack.pop()] = i
            if stack and lcp[stack[-1]] == v:
                lead[i] = stack[-1]
            else:
                left[i] = ends[stack[-1]] if stack else -1
                stack.append(i)
            ends[stack[-1]] = i
        return left[lead], right[lead], lead

    def smallest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest conv_id of the rows [lo, hi), by a table of minima over powers of two."""
        if not hasattr(self, "minima"):
            self.minima = [self.conv]
            while (w := 1 << (len(self.minima) - 1)) * 2 <= self.n:
                self.minima.append(np.minimum(self.minima[-1][:-w], self.minima[-1][w:]))
        out = np.full(len(lo), _BIG)
        some = np.flatnonzero(hi > lo)
        level = np.frexp((hi - lo)[some].astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = some[level == k]
            out[at] = np.minimum(self.minima[k][lo[at]], self.minima[k][hi[at] - (1 << int(k))])
        return out

    def summary(self) -> dict[str, np.ndarray]:
        """Per depth v = 0..segment: the last (z_) and first (a_) row with an LCP below v, and what lies
        beyond it in the block."""
        v = np.arange(self.segment + 1)
        hit = self.lcp[None, :] < v[:, None]
        some = hit.any(axis=1)
        a, z = np.where(some, hit.argmax(axis=1), self.n), np.where(some, self.n - 1 - hit[:, ::-1].argmax(axis=1), -1)
        z0, n, zero = np.maximum(z, 0), np.full(len(v), self.n), np.zeros(len(v), np.int64)
        return {
            "z": z, "z_lcp": self.lcp[z0], "z_saved": self.sums[0][z0 + 1], "z_leaf": self.sums[1][z0 + 1], "z_saved_at": self.saved_at[z0], "z_leaf_at": self.leaf_at[z0],
            "z_min": self.smallest(z0, n), "z_eq": self.count(self.by_lcp, v, z + 1, n), "z_ends": self.count(self.by_elen, v, z0, n),
            "a": a, "a_lcp": self.lcp[np.minimum(a, self.n - 1)], "a_saved": self.sums[0][a], "a_leaf": self.sums[1][a],
            "a_min": self.smallest(zero, a), "a_eq": self.count(self.by_lcp, v, zero, a), "a_ends": self.count(self.by_elen, v, zero, a),
            "total": np.array([self.sums[0][-1], self.sums[1][-1], self.n]), "run": np.array([self.n - self.tail(), self.elen[-1]]),
        }

    def tail(self) -> int:
        """Rows of the last run of equal, ending conversations."""
        breaks = np.flatnonzero(~self.goes_on)
        return self.n - int(breaks[-1])


def beyond(blocks: list[int], summaries: dict[int, dict], segment: int) -> dict[int, dict]:
    """Per block and depth: the nearest row on either side of the block with a smaller LCP, and the
    minima, counts and sums of what lies between it and the block. Places and sums are global."""
    base, at, saved, leaf = {}, 0, 0, 0
    for b in blocks:
        base[b] = (at, saved, leaf)
        s, l, n = summaries[b]["total"]
        at, saved, leaf = at + int(n), saved + int(s), leaf + int(l)
    out, width = {b: {"base": base[b]} for b in blocks}, segment + 1
    state = {k: np.zeros(width, np.int64) for k in ("lcp", "saved", "leaf", "saved_at", "leaf_at", "eq", "ends")} | {"pos": np.full(width, -1), "min": np.full(width, _BIG)}
    for b in blocks:
        out[b]["left"], s, (p, ps, pl) = state, summaries[b], base[b]
        new = s["z"] >= 0
        pick = lambda a, old: np.where(new, a, old)
        state = {
            "pos": pick(p + s["z"], state["pos"]), "lcp": pick(s["z_lcp"], state["lcp"]), "saved": pick(ps + s["z_saved"], state["saved"]), "leaf": pick(pl + s["z_leaf"], state["leaf"]),
            "saved_at": pick(s["z_saved_at"], state["saved_at"]), "leaf_at": pick(s["z_leaf_at"], state["leaf_at"]), "min": pick(s["z_min"], np.minimum(state["min"], s["z_min"])),
            "eq": pick(s["z_eq"], state["eq"] + s["z_eq"]), "ends": pick(s["z_ends"], state["ends"] + s["z_ends"]),
        }
    state = {"pos": np.full(width, at), "lcp": np.full(width, -1), "saved": np.full(width, saved), "leaf": np.full(width, leaf), "min": np.full(width, _BIG), "eq": np.zeros(width, np.int64), "ends": np.zeros(width, np.int64)}
    after = -1
    for b in reversed(blocks):
        out[b]["right"], out[b]["next_lcp"], s, (p, ps, pl) = state, after, summaries[b], base[b]
        new = s["a"] < s["total"][2]
        pick = lambda a, old: np.where(new, a, old)
        state = {
            "pos": pick(p + s["a"], state["pos"]), "lcp": pick(s["a_lcp"], state["lcp"]), "saved": pick(ps + s["a_saved"], state["saved"]), "leaf": pick(pl + s["a_leaf"], state["leaf"]),
            "min": pick(s["a_min"], np.minimum(state["min"], s["a_min"])), "eq": pick(s["a_eq"], state["eq"] + s["a_eq"]), "ends": pick(s["a_ends"], state["ends"] + s["a_ends"]),
        }
        after = summaries[b]["first_lcp"]
    return out


def block_nodes(k: Block, around: dict, digests: dict[int, str]) -> pa.Table:
    """The nodes whose first branching row (or only row) stands in the block."""
    base, base_saved, base_leaf = around["base"]
    lt, rt, n = around["left"], around["right"], k.n
    left, right, lead = k.nearest_smaller()
    s = k.summary()
    # smallest conv_id of the node of depth v that holds the row before, and the row after the block
    spans_start = np.minimum(np.minimum(lt["min"], s["a_min"]), np.where(s["a"] < n, _BIG, rt["min"]))
    spans_end = np.minimum(np.minimum(rt["min"], s["z_min"]), np.where(s["z"] >= 0, _BIG, lt["min"]))

    def node_min(rows: np.ndarray) -> np.ndarray:
        """Smallest conv_id of the nodes of the LCP groups of these rows."""
        v, lo, hi = np.maximum(k.lcp[rows], 0), left[rows], right[rows]
        inside = k.smallest(np.maximum(lo, 0), hi)
        return np.minimum(np.minimum(inside, np.where(lo < 0, lt["min"][v], _BIG)), np.where(hi >= n, rt["min"][v], _BIG))

    i = np.flatnonzero((lead == np.arange(n)) & (k.lcp >= 0))
    i = i[(left[i] >= 0) | (lt["eq"][k.lcp[i]] == 0)]
    v, lo, hi = k.lcp[i], left[i], right[i]
    lo0, out_l, out_r = np.maximum(lo, 0), lo < 0, hi >= n
    l = np.where(out_l, lt["pos"][v], base + lo)  # noqa: E741
    r = np.where(out_r, rt["pos"][v], base + hi)
    sums = []
    for j, (name, at, off) in enumerate((("saved", k.saved_at, base_saved), ("leaf", k.leaf_at, base_leaf))):
        upto_l = np.where(out_l, lt[name][v], off + k.sums[j][lo0 + 1])
        upto_r = np.where(out_r, rt[name][v], off + k.sums[j][hi])
        sums.append(upto_r - upto_l + np.where(out_l, lt[name + "_at"][v], at[lo0]))
    eq = k.count(k.by_lcp, v, lo + 1, hi) + np.where(out_l, lt["eq"][v], 0) + np.where(out_r, rt["eq"][v], 0)
    ends = k.count(k.by_elen, v, lo0, hi) + np.where(out_l, lt["ends"][v], 0) + np.where(out_r, rt["ends"][v], 0)
    l_lcp = np.where(out_l, lt["lcp"][v], k.lcp[lo0])
    r_lcp = np.where(out_r, rt["lcp"][v], k.lcp[np.minimum(hi, n - 1)])

    def parent_min(top, via_left, at_l, at_r):
        """top: the parent's depth; its node is that of row at_l if via_left, else of row at_r."""
        out, t = np.full(len(top), _BIG), np.maximum(top, 0)
        for row, use in ((at_l, via_left), (at_r, ~via_left)):
            use = use & (top >= 0)
            near = use & (row >= 0) & (row < n)
            out[near] = node_min(row[near])
            out[use & (row < 0)] = spans_start[t[use & (row < 0)]]
            out[use & (row >= n)] = spans_end[t[use & (row >= n)]]
        return out

    top = np.maximum(l_lcp, r_lcp)
    inner = {
        "row": i, "v": v, "top": top, "n": r - l, "conv": node_min(i), "saved": sums[0], "leaves": sums[1], "ends": ends, "l": l,
        "kids": np.where(v == k.segment, k.kids[i], eq + 1 - ends), "parent": parent_min(top, l_lcp == top, lo, hi),
    }
    # rows that share their whole segment with no neighbour: nodes of one conversation
    next_lcp = np.r_[k.lcp[1:], around["next_lcp"]]
    top = np.maximum(k.lcp, next_lcp)
    # a tree of one empty row (only the root of the first segment) is a node as well
    i = np.flatnonzero(k.len > top)
    top = top[i]
    single = {
        "row": i, "v": k.len[i], "top": top, "n": np.ones(len(i), np.int64), "conv": k.conv[i], "saved": k.saved_at[i], "leaves": k.leaf_at[i],
        "ends": (k.elen[i] >= 0).astype(np.int64), "l": base + i, "kids": np.where(k.len[i] == k.segment, k.kids[i], 0), "parent": parent_min(top, k.lcp[i] == top, i, i + 1),
    }
    a = {name: np.concatenate([inner[name], single[name]]) for name in inner}
    return _expand(k, a, base, digests)


def _expand(k: Block, a: dict[str, np.ndarray], base: int, digests: dict[int, str]) -> pa.Table:
    """One row for each depth in (top, v] of each node; the digest of those that end at v."""
    seg = k.seg[a["row"]]
    start = np.maximum(a["top"] + 1, np.where(seg == 0, 0, 1))  # the root of a later segment is the node above
    count = np.maximum(a["v"] - start + 1, 0)
    of = np.repeat(np.arange(len(count)), count)
    depth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + start[of]
    bottom, first = depth == a["v"][of], depth == a["top"][of] + 1
    above = k.bytes_above(a["row"][of], np.maximum(depth - 1, 0))
    runs = np.r_[np.flatnonzero(~k.goes_on), k.n]
    sha = np.full(len(depth), _EMPTY, dtype=object)
    for j in np.flatnonzero(bottom & (a["ends"][of] > 0)):
        l, known = int(a["l"][of[j]]), digests.get(int(a["l"][of[j]]))  # noqa: E741
        if known is None:
            at = l - base
            known = hashlib.sha256(",".join(map(str, k.conv[at : runs[np.searchsorted(runs, at, "right")]].tolist())).encode()).hexdigest()
        sha[j] = known
    parent = np.where(first, a["parent"][of], a["conv"][of])
    root = (seg[of] == 0) & (depth == 0)
    return pa.table({
        "conv_id": a["conv"][of], "depth": seg[of] * k.segment + depth, "parent_conv_id": pa.array(parent, mask=root), "n_convs": a["n"][of],
        "n_children": np.where(bottom, a["kids"][of], 1), "n_leaves": a["leaves"][of], "saved_tokens": a["saved"][of] - (a["n"][of] - 1) * above, "ends_sha256": pa.array(sha, pa.string()),
    })


def _runs_over_edges(blocks: list[int], summaries: dict[int, dict], firsts: dict[int, dict], base: dict[int, int]) -> list[tuple[int, int, int]]:
    """(block, row from, place of the run's first row) of the last run of each block; a run that goes on
    from the block before keeps its first row's place."""
    out, run = [], None
    for b in blocks:
        start, elen = (int(x) for x in summaries[b]["run"])
        carried = run is not None and run[1] == firsts[b]["lcp"] == summaries[b]["first_elen"] and firsts[b]["prev_len"] == run[1]
        if carried and start > 0:  # ends in this block: its first rows
            out.append((b, 0, int(summaries[b]["head"]), run[0]))
        if start == 0 and carried:
            run = (run[0], elen) if elen >= 0 else None
        else:
            run = (base[b] + start, elen) if elen >= 0 else None
        if run is not None:
            out.append((b, start, firsts[b]["n"], run[0]))
    return out


def _hash_runs(spark: SparkSession, rows: DataFrame, pieces: list[tuple[int, int, int, int]]) -> dict[int, str]:
    """Digest of each run that touches the end of a block: one joined piece a block, hashed in order.
    One digest a block comes back at most."""
    if not pieces:
        return {}
    edge = spark.createDataFrame(pieces, "block int, lo bigint, hi bigint, run bigint")
    ids = rows.join(F.broadcast(edge), "block").where("idx >= lo AND idx < hi")
    joined = ids.groupBy("run", "block").agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("piece"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, sha = None, None
        for b in batches:
            done = []
            for r, piece in zip(b.column("run").to_pylist(), b.column("piece").to_pylist(), strict=True):
                if r != run:
                    if run is not None:
                        done.append((run, sha.hexdigest()))
                    run, sha = r, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(piece.encode())
            yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], ["run", "sha"])
        if run is not None:
            yield pa.RecordBatch.from_arrays([pa.array([run], pa.int64()), pa.array([sha.hexdigest()], pa.string())], ["run", "sha"])

    hashed = joined.repartition("run").sortWithinPartitions("run", "block").mapInArrow(scan, "run bigint, sha string")
    return {r["run"]: r["sha"] for r in hashed.collect()}


def trie(sequences: DataFrame, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie of sequences (conv_id, total, pos, key, size), as NODE_SCHEMA."""
    spark = sequences.sparkSession
    segs = segments(sequences, segment)
    n_blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-segs.count() // block))
    rows = sorted_blocks(classed(segs, segment), n_blocks)
    firsts = first_lcps(rows)
    if not firsts:
        return spark.createDataFrame([], NODE_SCHEMA)
    blocks = sorted(firsts)
    full = stored(rows.select("block", "idx", "conv_id", "seg", "lcp", "len", "sizes", "more").join(below(rows, firsts, segment), ["conv_id", "seg"], "left"), "trie-rows")

    def summarize(key: tuple, t: pa.Table) -> pa.Table:
        k = Block(t, firsts[key[0].as_py()], segment)
        s = {name: [v.tolist()] for name, v in k.summary().items()}
        breaks = np.r_[np.flatnonzero(~k.goes_on), k.n]
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "first_elen": [int(k.elen[0])], "head": [int(breaks[1])]} | s)

    names = ("z", "z_lcp", "z_saved", "z_leaf", "z_saved_at", "z_leaf_at", "z_min", "z_eq", "z_ends", "a", "a_lcp", "a_saved", "a_leaf", "a_min", "a_eq", "a_ends", "total", "run")
    found = full.groupBy("block").applyInArrow(summarize, "block int, first_elen bigint, head bigint, " + ", ".join(f"{c} array<bigint>" for c in names))
    summaries = {r["block"]: {c: np.array(r[c], np.int64) for c in names} | {"first_elen": r["first_elen"], "head": r["head"], "first_lcp": firsts[r["block"]]["lcp"]} for r in found.collect()}
    around = beyond(blocks, summaries, segment)
    pieces = _runs_over_edges(blocks, summaries, firsts, {b: around[b]["base"][0] for b in blocks})
    digests = _hash_runs(spark, rows.select("block", "idx", "conv_id"), pieces)
    shared = spark.sparkContext.broadcast((firsts, around, digests))

    def nodes(key: tuple, t: pa.Table) -> pa.Table:
        first, near, sha = shared.value
        b = key[0].as_py()
        return block_nodes(Block(t, first[b], segment), near[b], sha)

    return full.groupBy("block").applyInArrow(nodes, NODE_SCHEMA)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(rebuilt(turns(table(spark, sf_dir, "conversations"))))


_CRC = "xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i::INT, 1))::BIGINT)), lambda u, b: list_reduce([xor(u, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))))"

OP11_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, n, h, conv_id - conv_id % 5 AS base FROM (SELECT conv_id, count(*) AS n, {_CRC} % 9 AS h FROM t GROUP BY conv_id)
), m AS (
  SELECT c.*, least(c.h, coalesce(b.n, 0)) AS head FROM c LEFT JOIN c b ON b.conv_id = c.base
), s AS (
  SELECT m.conv_id, t.pos, t.role, t.text FROM m JOIN t ON t.conv_id = m.base AND t.pos <= m.h
  UNION ALL
  SELECT m.conv_id, m.head + t.pos - m.h, t.role, t.text FROM m JOIN t ON t.conv_id = m.conv_id AND t.pos > m.h
), k AS (
  SELECT conv_id, pos AS depth, octet_length(encode(text)) AS size, list(sha256(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY pos) AS path FROM s
  UNION ALL
  SELECT conv_id, 0, 0, [] FROM c
), members AS (
  SELECT conv_id, depth, size, path, max(depth) OVER (PARTITION BY conv_id) = depth AS ends FROM k
), node AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(size) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY path, depth
), linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, (SELECT count(*) FROM node x WHERE x.depth = n.depth + 1 AND x.path[1:n.depth] = n.path) AS n_children
  FROM node n LEFT JOIN node p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
)
SELECT a.conv_id, a.depth, any_value(a.parent_conv_id) AS parent_conv_id, any_value(a.n_convs) AS n_convs, any_value(a.n_children)::BIGINT AS n_children,
       count(*) FILTER (d.n_children = 0) AS n_leaves, sum(d.saved)::BIGINT AS saved_tokens, any_value(a.ends_sha256) AS ends_sha256
FROM linked a JOIN linked d ON d.depth >= a.depth AND d.path[1:a.depth] = a.path
GROUP BY a.path, a.conv_id, a.depth
"""
