"""Prefix trie of conversations by range minima over sorted LCPs.

A conversation is the sequence of its turns, a turn the 128-bit hash of role
and text.  The sequences are dealt by range over (sequence, conv_id) and
sorted, so one that a third of all conversations share spreads over tasks.
With the length of the prefix that each sorted sequence has in common with the
one before it (its LCP), a trie node of depth d is an interval of sorted
sequences whose LCPs, but the first one's, are d at least.  Every prefix that
is new at its sequence is a candidate; a sparse table of the range minima of
the LCPs lets each candidate find its left and right end by itself, in a
binary search (all candidates of a task in step), and a second table the
smallest conv_id between them.  There is no stack and no order among
candidates.

Tasks know each other by summaries, one a task: its smallest LCP and conv_id,
its sums, and the few places where the running minimum of its LCPs falls, from
either end.  A search that reaches the end of a task goes on over a sparse
table of the tasks' minima and ends at one of those places.  Sums over a
subtree are differences of running sums over sorted sequences, as a subtree is
an interval: what the members' texts hold less what its distinct nodes hold.
Children are counted by an aggregate of the nodes' parents.  The ids of
conversations that end in one node lie in order; only runs that several tasks
share are hashed later, joined task by task into one stream.

Bounds: a conversation is one row of 20 bytes a turn, as a document is one row
of text; a task holds the rows of its range, ``TURNS_A_TASK`` turns on
average; the driver holds a summary of each task and the first and last
sequence of its range.

Defined cases: rows without a conv_id belong to no conversation and are left
out; a null role or text is empty; turns of equal number follow in order of
role, then content hash, and a row that repeats is one more turn; an empty
table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from cadenza.llm.common import int64, settled

TURNS_A_TASK = 500_000
KEY = 16   # bytes of a turn's hash
_EMPTY = hashlib.sha256(b"").hexdigest()
_FAR = np.iinfo(np.int64).max

_NODE = ("l long, depth long, conv_id long, parent_l long, parent_conv_id long, n_convs long, n_leaves long, "
         "saved_tokens long, ends string, part int, ids binary")
_SUMMARY = ("part int, n long, total long, fresh long, leaves long, low long, conv long, fall_lcp array<long>, "
            "fall_at array<long>, fall_total array<long>, fall_fresh array<long>, fall_leaves array<long>, "
            "fall_conv array<long>, rise_lcp array<long>, rise_at array<long>, rise_conv array<long>")


# --- sequences ---------------------------------------------------------------

def sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """conv_id, keys (hex hashes of its turns in order) and chars (their
    texts' code points)."""
    role, text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    key = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), role.alias("role"), key.alias("key"),
                 F.char_length(text).alias("chars")).alias("item"))
    own = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("item")).alias("items"))
    return own.select("conv_id", F.col("items.key").alias("keys"), F.col("items.chars").alias("chars"))


def shared_openings(seqs: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Every conversation c begins with the first h turns of conversation
    c - c % group, where h is crc32(c) % most; its own turns after h follow."""
    base = (seqs.where(F.col("conv_id") % group == 0)
            .select(F.col("conv_id").alias("base"), F.slice("keys", 1, most - 1).alias("base_keys"),
                    F.slice("chars", 1, most - 1).alias("base_chars")))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")

    def rebuilt(mine: str, first: str) -> Column:
        head = F.slice(F.coalesce(F.col(first), F.slice(mine, 1, 0)), F.lit(1), F.col("h"))
        return F.concat(head, F.slice(F.col(mine), F.col("h") + 1, F.greatest(F.size(mine), F.lit(1))))
    return (seqs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % group, "h": h})
            .join(base, "base", "left")
            .select("conv_id", rebuilt("keys", "base_keys").alias("keys"), rebuilt("chars", "base_chars").alias("chars")))


# --- range minima ------------------------------------------------------------

class RangeMin:
    """Sparse table: the minimum of every stretch of 2 ** k values."""

    def __init__(self, values: np.ndarray):
        self.rows, step = [values], 1
        while 2 * step <= len(values):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def right(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place such that all values after ``at`` up to it are at
        least ``depth``."""
        at = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row, far = self.rows[k], 1 << k
            ok = at + 1 < len(row)
            ok[ok] = row[at[ok] + 1] >= depth[ok]
            at[ok] += far
        return at

    def left(self, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The last place up to ``at`` with a value below ``depth``, or -1."""
        at = at.copy()
        for k in range(len(self.rows) - 1, -1, -1):
            row, far = self.rows[k], 1 << k
            ok = at - far + 1 >= 0
            ok[ok] = row[at[ok] - far + 1] >= depth[ok]
            at[ok] -= far
        return at

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum from ``lo`` to ``hi``, both included."""
        out = np.empty(len(lo), dtype=self.rows[0].dtype)
        level = np.frexp((hi - lo + 1).astype(float))[1] - 1
        for k in np.unique(level):
            m = level == k
            out[m] = np.minimum(self.rows[k][lo[m]], self.rows[k][hi[m] - (1 << int(k)) + 1])
        return out


def common_prefix(a: bytes, b: bytes) -> int:
    """Turns that two sequences have in common at their beginning."""
    n = min(len(a), len(b)) // KEY
    x, y = [np.frombuffer(s, f"V{KEY}", n).view("<u8").reshape(-1, 2) for s in (a, b)]
    same = (x == y).all(axis=1)
    return n if same.all() else int(same.argmin())


class _Range:
    """The sorted sequences of a task."""

    def __init__(self, batches: Iterator[pa.RecordBatch], lcp_first: int, lcp_next: int):
        t = pa.Table.from_batches(list(batches)).combine_chunks()
        self.conv = int64(t["conv_id"].chunk(0))
        path = t["path"].chunk(0).cast(pa.large_binary())
        ends = np.frombuffer(path.buffers()[1], "<i8")[path.offset:path.offset + len(path) + 1] // KEY
        whole = path.buffers()[2]
        keys = np.frombuffer(whole, "<u8", 2 * int(ends[-1]) if whole else 0).reshape(-1, 2) if whole else np.zeros((0, 2), "<u8")
        self.n, self.start, self.len = len(path), ends[:-1], np.diff(ends)
        self.lcp = self._lcps(keys, lcp_first)
        self.next = np.append(self.lcp[1:], lcp_next)
        # sums of the first k texts of a row, k = 0 ... its length
        chars = int64(t["chars"].chunk(0).flatten())
        run = np.concatenate([[0], np.cumsum(chars)])
        first = self.start - self.start[0]
        self.sums = lambda row, k: run[first[row] + k] - run[first[row]]
        every = np.arange(self.n)
        self.total = self.sums(every, self.len)
        self.fresh = self.total - self.sums(every, np.maximum(self.lcp, 0))
        self.leaf = (self.next < self.len).astype(np.int64)

    def _lcps(self, keys: np.ndarray, lcp_first: int) -> np.ndarray:
        lcp = np.zeros(self.n, dtype=np.int64)
        lcp[0] = lcp_first
        live, k = np.arange(1, self.n), 0
        while len(live):
            live = live[np.minimum(self.len[live], self.len[live - 1]) > k]
            live = live[(keys[self.start[live] + k] == keys[self.start[live - 1] + k]).all(axis=1)]
            k += 1
            lcp[live] = k
        return lcp


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the task's number, rows, first and last sequence."""
    first = last = None
    for b in batches:
        if b.num_rows:
            first = b.column("path")[0].as_py() if first is None else first
            last = b.column("path")[b.num_rows - 1].as_py()
    if first is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([first], pa.binary()), pa.array([last], pa.binary())],
            ["part", "first", "last"])


def _falls(lcp: np.ndarray) -> np.ndarray:
    """Places where the running minimum falls."""
    low = np.minimum.accumulate(lcp)
    return np.flatnonzero(np.concatenate([[True], low[1:] < low[:-1]]))


def _summaries(joints):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        if part not in joints.value:
            return
        lcp_first, lcp_next, _, _ = joints.value[part]
        r = _Range(batches, lcp_first, lcp_next)
        before = lambda x: np.concatenate([[0], np.cumsum(x)])
        total, fresh, leaves = before(r.total), before(r.fresh), before(r.leaf)
        conv_before = np.concatenate([[_FAR], np.minimum.accumulate(r.conv)])
        fall = _falls(r.lcp)
        rise = r.n - 1 - _falls(r.lcp[::-1])
        conv_after = np.minimum.accumulate(r.conv[::-1])[::-1]
        row = [part, r.n, total[-1], fresh[-1], leaves[-1], r.lcp.min(), r.conv.min(), r.lcp[fall], fall, total[fall],
               fresh[fall], leaves[fall], conv_before[fall], r.lcp[rise], rise, conv_after[rise]]
        names = [x.split()[0] for x in _SUMMARY.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], pa.int32() if n == "part" else pa.int64()) if np.ndim(x) == 0 else pa.array([x], pa.list_(pa.int64()))
             for n, x in zip(names, row)], names)
    return run


class _Tasks:
    """The summaries of all tasks in order, and searches over them."""

    def __init__(self, rows: list):
        rows = sorted(rows, key=lambda r: r["part"])
        self.index = {r["part"]: k for k, r in enumerate(rows)}
        self.rows = [{n: np.array(r[n]) for n in r.asDict() if n.startswith(("fall", "rise"))} for r in rows]
        before = lambda n: np.concatenate([[0], np.cumsum([r[n] for r in rows])]).astype(np.int64)
        self.n, self.total, self.fresh, self.leaves = before("n"), before("total"), before("fresh"), before("leaves")
        self.conv = RangeMin(np.array([r["conv"] for r in rows], dtype=np.int64))
        self.low = RangeMin(np.array([r["low"] for r in rows], dtype=np.int64))

    def _between(self, lo: int, hi: int) -> int:
        return int(self.conv.least(np.array([lo]), np.array([hi]))[0]) if lo <= hi else _FAR

    def beyond(self, k: int, depth: int) -> tuple:
        """Right end of a prefix that goes on after task k: its global place,
        the running sums up to it, and the smallest conv_id after task k."""
        q = int(self.low.right(np.array([k]), np.array([depth]))[0]) + 1
        if q == len(self.rows):
            return self.n[q] - 1, self.total[q], self.fresh[q], self.leaves[q], self._between(k + 1, q - 1)
        r = self.rows[q]
        s = int(np.argmax(r["fall_lcp"] < depth))
        return (self.n[q] + r["fall_at"][s] - 1, self.total[q] + r["fall_total"][s], self.fresh[q] + r["fall_fresh"][s],
                self.leaves[q] + r["fall_leaves"][s], min(self._between(k + 1, q - 1), int(r["fall_conv"][s])))

    def ahead(self, k: int, depth: int) -> tuple:
        """Left end of a prefix that begins before task k: its global place
        and the smallest conv_id from there up to task k."""
        q = int(self.low.left(np.array([k - 1]), np.array([depth]))[0])
        r = self.rows[q]
        s = int(np.argmax(r["rise_lcp"] < depth))
        return self.n[q] + r["rise_at"][s], min(self._between(q + 1, k - 1), int(r["rise_conv"][s]))


def _open_ends(find, depths: np.ndarray) -> np.ndarray:
    """``find`` for each depth, asked once for equal depths."""
    each, where = np.unique(depths, return_inverse=True)
    return np.array([find(int(d)) for d in each], dtype=np.int64)[where]


def _nodes(joints, tasks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        if part not in joints.value:
            return
        lcp_first, lcp_next, from_last, into_next = joints.value[part]
        all_tasks, r = tasks.value, _Range(batches, lcp_first, lcp_next)
        k = all_tasks.index[part]
        base = all_tasks.n[k]
        # each row's new prefixes, and the one above them, its parent, to look up
        low = np.maximum(r.lcp, 0)
        asks = r.len - low + 1
        row = np.repeat(np.arange(r.n), asks)
        depth = np.arange(len(row)) - np.repeat(np.cumsum(asks) - asks, asks) + low[row]
        lcps, convs = RangeMin(r.lcp), RangeMin(r.conv)
        left, right = lcps.left(row, depth), lcps.right(row, depth)
        conv = convs.least(np.maximum(left, 0), right)

        sums = [np.cumsum(x) for x in (r.total, r.fresh, r.leaf)]
        first = base + left
        last = base + right
        upto = [b[k] + s[right] for b, s in zip((all_tasks.total, all_tasks.fresh, all_tasks.leaves), sums)]
        far = (right == r.n - 1) & (lcp_next >= depth)
        if far.any():
            found = _open_ends(lambda d: all_tasks.beyond(k, d), depth[far])
            last[far] = found[:, 0]
            for x, c in zip(upto, found.T[1:4]):
                x[far] = c
            conv[far] = np.minimum(conv[far], found[:, 4])
        near = left < 0
        if near.any():
            found = _open_ends(lambda d: all_tasks.ahead(k, d), depth[near])
            first[near] = found[:, 0]
            conv[near] = np.minimum(conv[near], found[:, 1])

        new = np.flatnonzero(depth > r.lcp[row])
        j, d = row[new], depth[new]
        above = np.maximum(new - 1, 0)   # the prefix one turn shorter stands before each
        n_convs = last[new] - first[new] + 1
        head = r.sums(j, np.maximum(d - 1, 0))
        held = upto[0][new] - (all_tasks.total[k] + sums[0][j] - r.total[j]) - n_convs * head
        own = upto[1][new] - (all_tasks.fresh[k] + sums[1][j]) + r.total[j] - head
        leaves = upto[2][new] - (all_tasks.leaves[k] + sums[2][j] - r.leaf[j])

        # runs of equal sequences: the conversations that end in a node
        twin = np.append((r.next == r.len)[:-1] & (r.len[1:] == r.len[:-1]), False)
        stop = np.flatnonzero(~twin)
        end = stop[np.searchsorted(stop, j)]
        whole = (d == r.len[j]) & ~((end == r.n - 1) & into_next)
        ends = np.full(len(new), _EMPTY, dtype=object)
        ends[(d == r.len[j]) & ~whole] = None
        name = lambda lo, hi: ",".join(map(str, r.conv[lo:hi + 1].tolist())).encode()
        for x in np.flatnonzero(whole).tolist():
            ends[x] = hashlib.sha256(name(j[x], end[x])).hexdigest()
        root = d == 0
        yield pa.RecordBatch.from_arrays(
            [pa.array(first[new]), pa.array(d), pa.array(conv[new]), pa.array(first[above], mask=root),
             pa.array(conv[above], mask=root), pa.array(n_convs), pa.array(leaves), pa.array(held - own),
             pa.array(ends, pa.string()), pa.nulls(len(new), pa.int32()), pa.nulls(len(new), pa.binary())],
            [x.split()[0] for x in _NODE.split(", ")])

        pieces = [(0, int(stop[0]))] if from_last else []
        if into_next and not (from_last and stop[0] == r.n - 1):
            pieces.append((int(stop[-2]) + 1 if len(stop) > 1 else 0, r.n - 1))
        if pieces:
            at = np.array([lo for lo, _ in pieces])
            d = r.len[at]
            # a run that begins in an earlier task is known by where it begins
            begin = [int(all_tasks.ahead(k, int(x))[0]) if from_last and lo == 0 else int(base + lo)
                     for (lo, _), x in zip(pieces, d)]
            none = pa.nulls(len(pieces), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(begin, pa.int64()), pa.array(d), none, none, none, none, none, none, pa.nulls(len(pieces), pa.string()),
                 pa.array([part] * len(pieces), pa.int32()), pa.array([name(*p) for p in pieces], pa.binary())],
                [x.split()[0] for x in _NODE.split(", ")])
    return run


def _joined_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each run's pieces, which arrive in order, comma-joined."""
    now, digest = None, None
    for b in batches:
        done = []
        for l, depth, ids in zip(*(b.column(c).to_pylist() for c in ("l", "depth", "ids"))):
            if (l, depth) == now:
                digest.update(b",")
            else:
                done += [(*now, digest.hexdigest())] if now else []
                now, digest = (l, depth), hashlib.sha256()
            digest.update(ids)
        if done:
            yield _hash_rows(done)
    if now:
        yield _hash_rows([(*now, digest.hexdigest())])


def _hash_rows(done: list) -> pa.RecordBatch:
    l, depth, sha = zip(*done)
    return pa.RecordBatch.from_arrays([pa.array(l, pa.int64()), pa.array(depth, pa.int64()), pa.array(sha)],
                                      ["l", "depth", "joined"])


def prefix_trie(seqs: DataFrame, turns_a_task: int = TURNS_A_TASK) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 of every distinct prefix of the sequences
    (conv_id, keys, chars); conv_ids must not repeat."""
    spark = seqs.sparkSession
    rows = settled(seqs.select("conv_id", F.unhex(F.array_join("keys", "")).alias("path"), "chars"))
    turns = rows.agg(F.coalesce(F.sum(F.size("chars")), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // turns_a_task))
    ranged = settled(rows.repartitionByRange(parts, "path", "conv_id").sortWithinPartitions("path", "conv_id"))

    # a row a task: how its first and last sequence go on in its neighbours
    edges = sorted(ranged.select("path").mapInArrow(_edges, "part int, first binary, last binary").collect())
    meets = [-1] + [common_prefix(a["last"], b["first"]) for a, b in zip(edges, edges[1:])] + [-1]
    same = [False] + [a["last"] == b["first"] for a, b in zip(edges, edges[1:])] + [False]
    joints = spark.sparkContext.broadcast(
        {e["part"]: (meets[k], meets[k + 1], same[k], same[k + 1]) for k, e in enumerate(edges)})
    found = ranged.mapInArrow(_summaries(joints), _SUMMARY).collect()
    tasks = spark.sparkContext.broadcast(_Tasks(found) if found else None)

    made = settled(ranged.mapInArrow(_nodes(joints, tasks), _NODE))
    nodes = made.where(F.col("part").isNull())
    children = (nodes.where(F.col("depth") > 0).groupBy(F.col("parent_l").alias("l"), (F.col("depth") - 1).alias("depth"))
                .agg(F.count("*").alias("children")))
    joined = (made.where(F.col("part").isNotNull()).select("l", "depth", "part", "ids")
              .repartition("l").sortWithinPartitions("l", "depth", "part")
              .mapInArrow(_joined_hashes, "l long, depth long, joined string"))
    return (nodes.join(children, ["l", "depth"], "left").join(joined, ["l", "depth"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("children", F.lit(0)).alias("n_children"),
                    "n_leaves", "saved_tokens", F.coalesce("ends", "joined").alias("ends_sha256")))
