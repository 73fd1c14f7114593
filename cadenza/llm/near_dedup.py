"""Near-duplicate documents by HyperMinHash.

A document's set holds its distinct shingles (``size`` consecutive words; a
shorter document is one shingle).  Hashes of the shingles fall into 256
buckets; of each bucket's least hash a register keeps the count of leading
zeros and ten bits after them.  Documents with the same set are one node from
the start.  Five registers in a row (at 80 %; six at 85 %) make a band: nodes
that agree in a band with at least ``FILLED`` filled registers are candidates.
One filled register alone holds about twelve bits, which unrelated sets share
by chance; three hold 36 and more.  A pair is dropped without a look at the texts only if the
sizes exclude the similarity, or if the estimate from the registers (less
expected chance collisions) lies five standard errors below it.  All others
are confirmed on the full sets.

Small sets leave registers empty and have few such bands or none.  A
set that a set of at most ``SMALL`` shingles can be similar to also gets a key
for each shingle of its prefix: the first ones in an order of all shingles, as
many as the set may lack of a similar one, and one more.  Similar sets have a
shingle of their prefixes in common, whatever the order; here the ``HOT``
commonest shingles come last, so a phrase that many short texts share makes no
group of them all.  These keys are dealt and met like band values.  So a pair
is only left to the bands if both sets have more than ``SMALL`` shingles; then
some 27 of the 36 bands at 80 % (31 at 85 %) are filled enough, and two sets
at the threshold share none of them with a probability of about 1e-6 or less.

Pairs of a large group are never all formed.  Bands are dealt by range over
(band value, node), so a value that many nodes share spreads over tasks; in a
task every node meets the first node of its value, the hub, and hubs of one
value in several tasks meet each other.  Values take one of ``HUBS`` orders of
the nodes, so a family that shares many values gets several hubs, and few of
its members are like none of them.  What is left are nodes in different
components of one band value.  First they meet by their sizes and, where the
shingles are at hand, by a mark of ``MARK`` bits, each the parity of a share of the
shingles: marks differ in no more bits than sets in shingles, so no similar pair
is lost, and only nodes that are left take shingles or registers to their group.
Sets whose shingles are at hand are then compared by
them, in blocks of ``BLOCK`` by ``BLOCK`` nodes, and only as many links leave a
block as tie the same nodes together.  Where another pair is plausible by its
registers, the node of the smaller component is tested against *all* nodes of the other component, in blocks of ``BLOCK`` by
``BLOCK`` nodes, so neither a group nor a component bounds a task and no pairs
are written out.  A component that is crowded in a group is met as a whole,
once for all its groups.  That step leaves no plausible pair untested.

Defined cases: null and empty texts, and texts of white space, have an empty
set and are linked with nothing; a null id never becomes a component's name
if the component has another; rows that repeat an id stay rows; other columns
are ignored.  Ids are integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cadenza.llm.common import int64, release, settled, text_bytes, whole_texts
from cadenza.llm.graph import components

SHINGLE = 5
PERCENT = 80

REGISTERS = 256
BANDS = 36
MANTISSA = 10
FILLED = 3                    # registers of a band that must be filled
SMALL = 256                   # shingles of a set that bands are not enough for
HOT = 65_536                  # commonest shingles, last in the order of prefixes
BLOCK = 384                   # nodes of a group compared in one task
HUBS = 8                      # orders of the nodes that groups choose their hub by
COLUMNS = 2048                # shingles of a cell counted at once
MARK = 256                    # bits of a small set's mark
CROWD = 8                     # nodes that make a component crowded in a group, at least
GROUP_BYTES = 1 << 20         # text hashed at once
BROADCAST_ROWS = 1_000_000    # ids (16 bytes each) broadcast at most

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_rng = np.random.default_rng(20)
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]   # A-Z as a-z
_BYTE_SPACE = np.where(_SPACE, np.uint64(0), _BYTE)
_MULTIPLIERS = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: all bits depend on all."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _word_hashes(bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in turn, and the number of words of each text."""
    x = np.frombuffer(b" ".join(bodies) + b" ", dtype=np.uint8)
    word = ~_SPACE[x]
    begin = word.copy()
    begin[1:] &= ~word[:-1]
    starts = np.flatnonzero(begin)
    ends = np.cumsum(np.array([len(b) + 1 for b in bodies], dtype=np.int64))
    below = np.searchsorted(starts, ends)
    n_words = np.diff(below, prepend=0)
    if not len(starts):
        return np.zeros(0, np.uint64), n_words
    place = np.zeros(len(x), dtype=np.int64)   # in its word, of each byte
    place[starts[0]:] = (np.arange(starts[0], len(x))
                         - np.repeat(starts, np.diff(np.append(starts, len(x)))))
    place[~word] = 0
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(place.max()), _BASE, np.uint64)]))
    return _mixed(np.add.reduceat(_BYTE_SPACE[x] * powers[place], starts)), n_words


def shingle_sets(bodies: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    h, n_words = _word_hashes(bodies)
    first = np.cumsum(n_words) - n_words
    out, whole = [], np.zeros(0, np.uint64)
    if len(h) >= size:
        whole = h[:len(h) - size + 1] * _MULTIPLIERS[0]
        for k in range(1, size):
            whole = whole + h[k:len(h) - size + 1 + k] * _MULTIPLIERS[k]
        whole = _mixed(whole)
    for f, n in zip(first.tolist(), n_words.tolist()):
        if n >= size:
            out.append(np.unique(whole[f:f + n - size + 1]))
        elif n:
            short = (h[f:f + n] * _MULTIPLIERS[:n]).sum(dtype=np.uint64) + np.uint64(n)
            out.append(_mixed(np.array([short], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers for each set: 0 if the bucket is empty, else
    (leading zeros + 1) and the bits behind the first one."""
    out = np.zeros((len(sets), REGISTERS), dtype=np.uint16)
    if not sets:
        return out
    u = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bucket = (u >> np.uint64(56)).astype(np.int64)
    new = np.ones(len(u), dtype=bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (row[1:] != row[:-1])   # sorted: the least of a bucket is first
    rest = (u[new] << np.uint64(8)) | np.uint64(0x80)               # 56 bits and a stop
    exact = rest >> np.uint64(11)                                    # 53 bits convert without rounding
    exponent = np.where(exact > 0, np.frexp(exact.astype(np.float64))[1] + 11, 8)
    zeros = (64 - exponent).astype(np.uint64)
    tail = (rest << zeros) << np.uint64(1)
    value = ((zeros + np.uint64(1)) << np.uint64(MANTISSA)) | (tail >> np.uint64(64 - MANTISSA))
    out[row[new], bucket[new]] = value.astype(np.uint16)
    return out


def _levels(n: np.ndarray) -> np.ndarray:
    """A row for each set size: the chances of a register's leading-zero
    counts.  Two rows' product over 2**MANTISSA is the share of registers that
    unrelated sets of those sizes have in common."""
    k = np.arange(1, 58, dtype=np.float64)
    rate = np.asarray(n, dtype=np.float64)[:, None] / REGISTERS
    return np.exp(-rate * 2.0 ** -k) - np.exp(-rate * 2.0 ** -(k - 1))


def _plausible(a: tuple, b: tuple, percent: int) -> np.ndarray:
    """The similarity's estimate where a pair may reach it, else -1.  Both
    sides: registers, set sizes and their levels, a row each."""
    (ra, na, la), (rb, nb, lb) = a, b
    some = (ra > 0) | (rb > 0)
    filled = np.maximum(some.sum(axis=-1), 1)
    same = ((ra == rb) & some).sum(axis=-1)
    chance = (la * lb).sum(axis=-1) / 2.0 ** MANTISSA
    est = np.maximum(same / filled - chance * REGISTERS / filled, 0)
    p = percent / 100
    cut = p - 5 * np.sqrt(p * (1 - p) / filled) - 0.01
    small, large = np.minimum(na, nb), np.maximum(na, nb)
    return np.where((est >= cut) & (100 * small >= percent * large), est, -1.0)


def _sides(t: dict) -> tuple:
    return t["regs"], t["n_shingles"], _levels(t["n_shingles"])


def _rows_of(side: tuple, rows) -> tuple:
    return tuple(x[rows] for x in side)


def _chunks(bodies: list[bytes]) -> Iterator[tuple[int, int]]:
    lo = total = 0
    for k, b in enumerate(bodies):
        total += len(b)
        if total >= GROUP_BYTES:
            yield lo, k + 1
            lo, total = k + 1, 0
    if lo < len(bodies):
        yield lo, len(bodies)


def _set_id(s: np.ndarray) -> int | None:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None


def _sketched(size: int, small: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies = b.column("body").to_pylist()
            for lo, hi in _chunks(bodies):
                sets = shingle_sets(bodies[lo:hi], size)
                regs = registers(sets)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_set_id(s) for s in sets], pa.int64()),
                     pa.array([r.tobytes() for r in regs], pa.binary()),
                     pa.array([s.tobytes() if 0 < len(s) <= small else None for s in sets], pa.binary())],
                    ["doc_id", "n_shingles", "set_id", "regs", "small"])
    return run


def _identified(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies = b.column("body").to_pylist()
            for lo, hi in _chunks(bodies):
                sets = shingle_sets(bodies[lo:hi], size)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([_set_id(s) for s in sets], pa.int64())], ["doc_id", "n_shingles", "set_id"])
    return run


def identities(docs: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, set_id (null for an empty set) of every row."""
    rows = whole_texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(text).alias("body"))
    return rows.mapInArrow(_identified(size), "doc_id long, n_shingles long, set_id long")


def sketches(docs: DataFrame, text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, set_id (null for an empty set), regs, small (the
    shingles, if a set of ``SMALL`` can be similar; else null) of every row."""
    rows = whole_texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(text).alias("body"))
    return rows.mapInArrow(_sketched(size, SMALL * 100 // percent),
                           "doc_id long, n_shingles long, set_id long, regs binary, small binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)


def _estimated(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, b_ = (_sides({"regs": _matrix(b.column(f"regs_{x}")), "n_shingles": int64(b.column(f"n_{x}"))})
                     for x in "ab")
            ok = pa.array(_plausible(a, b_, percent) >= 0)
            yield pa.RecordBatch.from_arrays([b.column("a").filter(ok), b.column("b").filter(ok)], ["a", "b"])
    return run


def _sets_of(docs: DataFrame, text: str, size: int, nodes: DataFrame) -> DataFrame:
    """(set_id, shingles) of the nodes given as (set_id, doc_id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies = b.column("body").to_pylist()
            for lo, hi in _chunks(bodies):
                sets = shingle_sets(bodies[lo:hi], size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_set_id(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], ["set_id", "shingles"])
    wanted = nodes.select(F.coalesce("doc_id", F.lit(0)).alias("id0")).distinct()
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id0"),
                       text_bytes(text).alias("body"))
    return (rows.join(wanted, "id0", "left_semi").select("body")
            .mapInArrow(run, "set_id long, shingles binary")
            .join(nodes.select("set_id"), "set_id", "left_semi").dropDuplicates(["set_id"]))


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                place = np.searchsorted(y, x)
                place[place == len(y)] = 0
                both = int((y[place] == x).sum())
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            ok = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("a").filter(ok), b.column("b").filter(ok)], ["a", "b"])
    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    full = (pairs.select("a", "b")
            .join(sets.select(F.col("set_id").alias("a"), F.col("shingles").alias("set_a")), "a")
            .join(sets.select(F.col("set_id").alias("b"), F.col("shingles").alias("set_b")), "b"))
    return full.mapInArrow(_confirmed(percent), "a long, b long")


def band_width(percent: int) -> int:
    """Registers in a band: two nodes at the threshold share a band with a
    probability of about 0.35."""
    return max(1, min(REGISTERS // BANDS, round(np.log(0.35) / np.log(min(percent, 99) / 100))))


def _whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, bool]]:
    """The rows, cut between runs of equal keys only, and whether they are the
    task's last run."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        held = (t if held is None else pa.concat_tables([held, t])).combine_chunks()
        if held.num_rows:
            last = _run_starts([int64(held[k].chunk(0)) for k in keys])[-1]
            if last:
                yield held.slice(0, last).combine_chunks(), False
                held = held.slice(last)
    if held is not None and held.num_rows:
        yield held.combine_chunks(), True


def _run_starts(keys: list[np.ndarray]) -> np.ndarray:
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


_MEMBER = "group long, band int, set_id long, n_shingles long, hub long, n_hub long, edge boolean"


def _hubs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by group with their task's first node of the group; a node alone in its group is left out, but for the task's first and
    last group, which may go on in another task (``edge``)."""
    first = None
    for t, last in _whole_runs(batches, ["group"]):
        group, node = int64(t["group"].chunk(0)), int64(t["set_id"].chunk(0))
        if first is None:
            first = group[0]
        starts = _run_starts([group])
        size = np.diff(np.append(starts, len(group)))
        edge = (group == first) | last
        keep = (np.repeat(size, size) > 1) | edge
        n = int64(t["n_shingles"].chunk(0))
        cols = [group, int64(t["band"].chunk(0)).astype(np.int32), node, n, np.repeat(node[starts], size),
                np.repeat(n[starts], size), edge]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[keep]) for c in cols],
            ["group", "band", "set_id", "n_shingles", "hub", "n_hub", "edge"])


def _small_sets(b: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in b.column("small").to_pylist()]


def _shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = _small_sets(b)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))], ["shingle"])


def _commonest(small: DataFrame) -> list[int]:
    """The ``HOT`` shingles that most small sets hold, rarest first."""
    n = small.select("small").mapInArrow(_shingles, "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
    rows = n.where("n > 2").orderBy(F.desc("n"), "shingle").limit(HOT).collect()
    return [r["shingle"] for r in reversed(rows)]


def prefix(s: np.ndarray, percent: int, hot: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a sorted set, by rank (0 if not among the sorted
    ``hot``) and hash: one more than a similar set may lack of it."""
    late = np.zeros(len(s), dtype=np.int64)
    if len(hot):
        place = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
        late = np.where(hot[place] == s, rank[place], 0)
    return s[np.argsort(late, kind="stable")[:len(s) + 1 + -percent * len(s) // 100]]


def _prefixed(percent: int, commonest: list[int]):
    hot = np.array(commonest, dtype=np.int64).view(np.uint64)
    rank = np.argsort(hot) + 1
    hot = np.sort(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [prefix(s, percent, hot, rank) for s in _small_sets(b)]
            row = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
            yield pa.RecordBatch.from_arrays(
                [b.column("set_id").take(pa.array(row)), b.column("n_shingles").take(pa.array(row)),
                 pa.array(np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64))],
                ["set_id", "n_shingles", "shingle"])
    return run


def _banded(percent: int):
    """Keys of the bands that are filled enough."""
    width = band_width(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bands = _bands_of(_matrix(b.column("regs")), width)
            row, band = np.nonzero(_filled(bands))
            key = (bands[row, band].astype(np.uint64) * _MULTIPLIERS[:width]).sum(axis=1, dtype=np.uint64)
            key = _mixed(_mixed(key) + band.astype(np.uint64) * _BASE)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.view(np.int64)), pa.array(band.astype(np.int32)), b.column("set_id").take(pa.array(row)),
                 b.column("n_shingles").take(pa.array(row))], ["group", "band", "set_id", "n_shingles"])
    return run


def _bands_of(regs: np.ndarray, width: int) -> np.ndarray:
    return regs[:, :BANDS * width].reshape(-1, BANDS, width)


def _filled(bands: np.ndarray) -> np.ndarray:
    """Whether each band has enough filled registers to be a key."""
    return (bands > 0).sum(axis=2) >= min(FILLED, bands.shape[2])


def _members(nodes: DataFrame, percent: int) -> DataFrame:
    """Nodes that share a band's value or a shingle of their prefixes
    (``group``; the band of a prefix is ``BANDS``), and a hub for each."""
    small = nodes.where(F.col("small").isNotNull()).select("set_id", "n_shingles", "small")
    keys = (small.mapInArrow(_prefixed(percent, _commonest(small)), "set_id long, n_shingles long, shingle long")
            .select(F.xxhash64(F.lit(BANDS), "shingle").alias("group"), F.lit(BANDS).alias("band"), "set_id", "n_shingles"))
    # a set of at most SMALL shingles meets every similar one by its prefix
    banded = (nodes.where(F.col("n_shingles") > SMALL).select("set_id", "n_shingles", "regs")
              .mapInArrow(_banded(percent), "group long, band int, set_id long, n_shingles long"))
    return (banded.unionByName(keys).withColumn("n_shingles", F.col("n_shingles").cast("int"))
            .withColumn("place", F.xxhash64(F.pmod("group", F.lit(HUBS)), "set_id"))
            .repartitionByRange("group", "place", "set_id").sortWithinPartitions("group", "place", "set_id")
            .mapInArrow(_hubs, _MEMBER))


def _hub_pairs(member: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): every node and its hub, and the hubs of a group that
    lies in several tasks (two groups a task at most) with the least of them."""
    ends = member.where("edge").select("group", F.struct("hub", "n_hub").alias("h")).distinct()
    least = ends.groupBy("group").agg(F.min("h").alias("least"))
    end = lambda node, n: F.struct(F.col(node).alias("node"), F.col(n).alias("n"))
    met = (member.select(end("set_id", "n_shingles").alias("x"), end("hub", "n_hub").alias("y"))
           .unionByName(ends.join(least, "group").select(
               end("h.hub", "h.n_hub").alias("x"), end("least.hub", "least.n_hub").alias("y")))
           .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")))
    return (met.select(F.col("x.node").alias("a"), F.col("x.n").alias("n_a"),
                       F.col("y.node").alias("b"), F.col("y.n").alias("n_b"))
            .where(F.col("a") != F.col("b")))


def _only(rows: DataFrame, ids: DataFrame, key: str = "set_id") -> DataFrame:
    """The rows whose key is among the (settled) ids; broadcast up to a size."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, key, "left_semi")


def _plausible_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs that sizes and registers do not exclude."""
    sized = settled(pairs.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).distinct())
    ends = settled(sized.select(F.col("a").alias("set_id")).unionByName(
        sized.select(F.col("b").alias("set_id"))).distinct())
    regs = settled(_only(nodes.select("set_id", "regs"), ends))
    return (sized.join(regs.select(F.col("set_id").alias("a"), F.col("regs").alias("regs_a")), "a")
            .join(regs.select(F.col("set_id").alias("b"), F.col("regs").alias("regs_b")), "b")
            .mapInArrow(_estimated(percent), "a long, b long"))


def _shared_shingles(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of two lists."""
    every = np.concatenate([np.zeros(0, np.uint64), *left, *right])
    row = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in left + right])
    _, column, n = np.unique(every, return_inverse=True, return_counts=True)
    again = n[column] > 1
    row, column = row[again], np.unique(column[again], return_inverse=True)[1]
    both = np.zeros((len(left), len(right)), dtype=np.float32)
    for lo in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        some = (column >= lo) & (column < lo + COLUMNS)
        holds = np.zeros((len(left) + len(right), COLUMNS), dtype=np.float32)
        holds[row[some], column[some] - lo] = 1
        both += holds[:len(left)] @ holds[len(left):].T
    return both


def _spanning(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Of the links a[k] - b[k] as many as tie the same components together."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x
    out = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            out.append(k)
    return out


def _cells(percent: int):
    """Compare the nodes of each cell of a group.

    Two nodes whose shingles are at hand are compared by them: out come links
    (``probe``, ``root``, two nodes), in each cell no more than tie the same
    nodes together.  Others are compared by their registers: out come (probe,
    root), the node of the smaller and the other's component, to be tested.
    Those that share several bands are compared in the first one's group only,
    those that share none in the groups of their prefixes.
    """
    width = band_width(percent)

    def exact(t: dict, left: np.ndarray, right: np.ndarray, links: set) -> None:
        left, right = [x[[t["small"][k] is not None for k in x.tolist()]] for x in (left, right)]
        if not len(left) or not len(right):
            return
        sets = [[np.frombuffer(t["small"][k], np.uint64) for k in x.tolist()] for x in (left, right)]
        both = _shared_shingles(*sets)
        n = t["n_shingles"]
        alike = 100 * both >= percent * (n[left][:, None] + n[right][None] - both)
        alike &= t["root"][left][:, None] != t["root"][right][None]
        x, y = left[np.nonzero(alike)[0]], right[np.nonzero(alike)[1]]
        for k in _spanning(t["root"][x], t["root"][y]):
            links.add((int(t["set_id"][x[k]]), int(t["set_id"][y[k]])))

    def compare(t: dict, found: set, links: set) -> None:
        left = np.flatnonzero(t["blk"] == t["i"][0])
        right = np.flatnonzero(t["blk"] == t["j"][0])
        exact(t, left, right, links)
        bands = _bands_of(t["regs"], width)
        usable = _filled(bands)
        side = _sides(t)
        known = np.array([x is not None for x in t["small"]])
        n = t["n_shingles"]
        large = n > SMALL
        for k, x in enumerate(left.tolist()):
            if not large[x]:
                continue
            ys = right[k + 1:] if t["i"][0] == t["j"][0] else right
            ys = ys[large[ys] & ~(known[ys] & known[x]) & (t["root"][ys] != t["root"][x])
                    & (t["set_id"][ys] != t["hub"][x]) & (t["hub"][ys] != t["set_id"][x])]   # hubs have been met
            if not len(ys):
                continue
            ys = ys[(100 * n[ys] >= percent * n[x]) & (100 * n[x] >= percent * n[ys])]
            ys = ys[_plausible(_rows_of(side, [x]), _rows_of(side, ys), percent) >= 0]
            if not len(ys):
                continue
            shared = (bands[x][None] == bands[ys]).all(axis=2) & usable[x][None]
            band = np.where(shared.any(axis=1), shared.argmax(axis=1), BANDS)
            for y in ys[band == t["band"][x]].tolist():
                a, b = sorted((x, y), key=lambda z: (t["size"][z], t["root"][z]))
                found.add((int(t["set_id"][a]), int(t["root"][b])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _ in _whole_runs(batches, ["group", "i", "j"]):
            cols = {c: int64(t[c].chunk(0)) for c in t.column_names if c not in ("regs", "small")}
            none = bytes(2 * REGISTERS)
            cols["regs"] = np.frombuffer(b"".join(x or none for x in t["regs"].to_pylist()), np.uint16).reshape(-1, REGISTERS)
            cols["small"] = np.array([*t["small"].to_pylist(), None], dtype=object)[:-1]
            starts = _run_starts([cols[c] for c in ("group", "i", "j")])
            found: set = set()
            links: set = set()
            for lo, hi in zip(starts.tolist(), np.append(starts[1:], t.num_rows).tolist()):
                compare({c: v[lo:hi] for c, v in cols.items()}, found, links)
            rows = [(*x, False) for x in sorted(found)] + [(*x, True) for x in sorted(links)]
            probes, roots, link = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(probes, pa.int64()), pa.array(roots, pa.int64()), pa.array(link, pa.bool_())],
                ["probe", "root", "link"])
    return run


def marks(sets: list[np.ndarray]) -> np.ndarray:
    """A row of bits for each set: the parities of the numbers of shingles that
    fall on them.  Two rows differ in at most as many bits as one of the sets
    alone has shingles."""
    u = np.concatenate([np.zeros(0, np.uint64), *sets])
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    bit = (u % np.uint64(MARK)).astype(np.int64)
    n = np.bincount(row * MARK + bit, minlength=len(sets) * MARK)
    return (n.reshape(-1, MARK) % 2).astype(np.uint8)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = np.packbits(marks(_small_sets(b)), axis=1)
        yield pa.RecordBatch.from_arrays(
            [b.column("set_id"), pa.array([r.tobytes() for r in rows], pa.binary())], ["set_id", "mark"])


def _may_link(left: dict, right: dict, percent: int) -> np.ndarray:
    """Whether two nodes of different components may be similar, by their sizes
    and marks, or without both marks if bands and registers can tell."""
    n, m = left["n_shingles"][:, None], right["n_shingles"][None]
    ok = (left["root"][:, None] != right["root"][None]) & (
        100 * np.minimum(n, m) >= percent * np.maximum(n, m))
    x, y = (2 * np.unpackbits(side["mark"], axis=1).astype(np.float32) - 1 for side in (left, right))
    differ = (MARK - x @ y.T) / 2
    near = (100 + percent) * differ <= (100 - percent) * (n + m)
    both = left["known"][:, None] & right["known"][None]
    return ok & np.where(both, near, (n > SMALL) & (m > SMALL))


_NODE = "group long, band int, set_id long, n_shingles long, hub long, root long, size long"


def _hopeful(percent: int):
    """The nodes of each cell of a group that may be linked to another there."""
    names = [c.split()[0] for c in _NODE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _ in _whole_runs(batches, ["group", "i", "j"]):
            cols = {c: int64(t[c].chunk(0)) for c in ("group", "i", "j", "blk", "n_shingles", "root")}
            mark = t["mark"].to_pylist()
            cols["known"] = np.array([x is not None for x in mark])
            cols["mark"] = np.frombuffer(b"".join(x or bytes(MARK // 8) for x in mark), np.uint8).reshape(-1, MARK // 8)
            starts = _run_starts([cols[c] for c in ("group", "i", "j")])
            keep = np.zeros(t.num_rows, dtype=bool)
            for lo, hi in zip(starts.tolist(), np.append(starts[1:], t.num_rows).tolist()):
                left = lo + np.flatnonzero(cols["blk"][lo:hi] == cols["i"][lo])
                right = lo + np.flatnonzero(cols["blk"][lo:hi] == cols["j"][lo])
                ok = _may_link(*({c: v[side] for c, v in cols.items()} for side in (left, right)), percent)
                keep[left] |= ok.any(axis=1)
                keep[right] |= ok.any(axis=0)
            yield from t.select(names).filter(pa.array(keep)).to_batches()
    return run


def _dealt(rows: DataFrame, *columns: str) -> DataFrame:
    """The rows of groups of ``n`` in cells (group, i, j): each block of a group
    with itself and with every other one."""
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    return (rows.withColumn("blk", F.pmod(F.xxhash64("set_id"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("group", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", *columns)
            .repartition("group", "i", "j").sortWithinPartitions("group", "i", "j"))


def _counted(rows: DataFrame) -> DataFrame:
    """The rows of groups of more than one, with the number of them, ``n``."""
    return rows.join(rows.groupBy("group").agg(F.count("*").alias("n")).where("n > 1"), "group")


def _promising(single: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The rows of ``single`` (groups of ``n``) whose node may be linked to
    another of its group; only ids, sizes and marks travel to the groups."""
    small = nodes.where(F.col("small").isNotNull()).select("set_id", "small")
    mark = _only(small.mapInArrow(_marked, "set_id long, mark binary"), settled(single.select("set_id").distinct()))
    cells = _dealt(single.join(mark, "set_id", "left"), "band", "set_id", "n_shingles", "hub", "root", "size", "mark")
    return cells.mapInArrow(_hopeful(percent), _NODE).distinct()


def _crowded(rooted: DataFrame) -> DataFrame:
    """(group, root, size) of the components with many nodes in a group: at
    least as many as the root of the group's nodes, so a group of n nodes has
    no more than that many of them."""
    n = rooted.groupBy("group").agg(F.count("*").alias("n"))
    return (rooted.groupBy("group", "root").agg(F.count("*").alias("k"), F.first("size").alias("size"))
            .join(n, "group").where(F.col("k") >= F.greatest(F.lit(CROWD), F.sqrt("n")))
            .select("group", "root", "size"))


def _tests(member: DataFrame, nodes: DataFrame, tied: DataFrame, node_roots: DataFrame,
           percent: int) -> DataFrame:
    """(probe, root, link): nodes with a plausible partner in another
    component, or two nodes that are linked.

    Nodes of a group meet each other in cells, but for those of crowded
    components: these the others meet as a whole, once for all groups.
    """
    sized = (tied.join(tied.groupBy("root").agg(F.count("*").alias("size")), "root")
             .withColumnRenamed("node", "set_id"))
    rooted = (member.select("group", "band", "set_id", "n_shingles", "hub").join(sized, "set_id", "left")
              .withColumn("root", F.coalesce("root", "set_id")).withColumn("size", F.coalesce("size", F.lit(1))))
    mixed = (rooted.groupBy("group").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi"))
             .where((F.col("n") > 2) & (F.col("lo") != F.col("hi"))).select("group"))
    rooted = settled(rooted.join(mixed, "group"))
    crowded = settled(_crowded(rooted))
    single = rooted.join(crowded.select("group", "root"), ["group", "root"], "left_anti")
    # marks first: most nodes that share a group are like none of it, and need
    # neither their shingles nor their registers there
    single = settled(_counted(settled(_promising(settled(_counted(single)), nodes, percent))))
    release(nodes.sparkSession)
    held = nodes.select("set_id", F.when(F.col("n_shingles") > SMALL, F.col("regs")).alias("regs"), "small")
    regs = settled(_only(held, settled(single.select("set_id").distinct())))
    cells = _dealt(single.join(regs, "set_id"), "band", "set_id", "root", "size", "hub", "n_shingles", "regs", "small")
    near = cells.mapInArrow(_cells(percent), "probe long, root long, link boolean")

    whole = crowded.select("group", F.col("root").alias("other"), F.col("size").alias("other_size"))
    inside = crowded.select("group", "root", F.lit(True).alias("inside"))
    meets = (rooted.join(inside, ["group", "root"], "left")
             .join(whole, (rooted["group"] == whole["group"]) & (F.col("root") != F.col("other"))
                   # of two crowded components the smaller one's nodes are the probes
                   & (F.col("inside").isNull() | (F.struct("size", "root") < F.struct("other_size", "other"))))
             .select(F.col("set_id").alias("probe"), F.col("other").alias("root")).distinct())
    grid = _grid(settled(meets), node_roots)
    regs = settled(_only(nodes.select("set_id", "n_shingles", "regs"), settled(grid.select("set_id").distinct())))
    far = (grid.join(regs, "set_id").repartition(*_CELL).sortWithinPartitions(*_CELL)
           .mapInArrow(_cell_probes(percent), "probe long, root long"))
    return near.unionByName(far.withColumn("link", F.lit(False))).distinct()


_CELL = ["alone", "cell", "i", "j"]


def _grid(tests: DataFrame, node_roots: DataFrame) -> DataFrame:
    """(alone, cell, i, j, probe, set_id, roots): probes in blocks i against
    targets in blocks j.  A component of more than ``BLOCK`` nodes has cells
    alone; smaller ones share cells, so a probe of many of them is there once.
    ``roots`` are a probe's components (no more than its cell has) or the
    target's own."""
    wide = settled(tests.select("root").distinct().join(node_roots, "root").groupBy("root")
                   .agg(F.count("*").alias("n")))
    small = F.col("n") <= BLOCK
    cells = max(1, -(-(wide.where(small).agg(F.sum("n")).first()[0] or 0) // BLOCK))
    placed = wide.select("root", F.when(small, 0).otherwise(1).cast("long").alias("alone"),
                         F.when(small, F.pmod(F.xxhash64("root"), F.lit(cells))).otherwise(F.col("root")).alias("cell"),
                         F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("bt"))
    asked = settled(tests.join(placed, "root").groupBy("alone", "cell", F.col("probe").alias("set_id"))
                    .agg(F.collect_set("root").alias("roots"), F.max("bt").alias("bt")))
    many = asked.groupBy("alone", "cell").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("bp"))

    def block(n):
        return F.pmod(F.xxhash64("set_id"), F.col(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    probes = (asked.join(many, ["alone", "cell"])
              .select("alone", "cell", block("bp").alias("i"), every("bt").alias("j"), F.lit(True).alias("probe"),
                      "set_id", "roots"))
    targets = (node_roots.join(placed, "root").join(many, ["alone", "cell"])
               .select("alone", "cell", every("bp").alias("i"), block("bt").alias("j"), F.lit(False).alias("probe"),
                       "set_id", F.array("root").alias("roots")))
    return settled(probes.unionByName(targets))


def _grid_cells(t: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Each probe's row, and the rows of the targets that it is tested with."""
    starts = _run_starts([int64(t[c].chunk(0)) for c in _CELL])
    probe, roots = t["probe"].chunk(0).to_numpy(False), t["roots"].chunk(0).to_pylist()
    for lo, hi in zip(starts.tolist(), np.append(starts[1:], t.num_rows).tolist()):
        targets = lo + np.flatnonzero(~probe[lo:hi])
        own = np.array([roots[k][0] for k in targets.tolist()], dtype=np.int64)
        for k in (lo + np.flatnonzero(probe[lo:hi])).tolist():
            asked = targets[np.isin(own, np.array(roots[k], dtype=np.int64))]
            if len(asked):
                yield k, asked


def _cell_probes(percent: int):
    """(probe, root) for the components with a node that the probe may be
    similar to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _ in _whole_runs(batches, _CELL):
            node, n = (int64(t[c].chunk(0)) for c in ("set_id", "n_shingles"))
            roots = t["roots"].chunk(0).to_pylist()
            side = _sides({"regs": _matrix(t["regs"].chunk(0)), "n_shingles": n})
            found = set()
            for k, targets in _grid_cells(t):
                ok = targets[_plausible(_rows_of(side, [k]), _rows_of(side, targets), percent) >= 0]
                found.update((int(node[k]), roots[y][0]) for y in ok.tolist())
            probes, of = zip(*sorted(found)) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(probes, pa.int64()), pa.array(of, pa.int64())],
                                             ["probe", "root"])
    return run


def _cell_links(percent: int):
    """A link, if there is any, of each probe to each of its components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, _ in _whole_runs(batches, _CELL):
            node, roots = int64(t["set_id"].chunk(0)), t["roots"].chunk(0).to_pylist()
            sets = [np.frombuffer(b, np.uint64) for b in t["shingles"].chunk(0).to_pylist()]
            found = {}
            for k, targets in _grid_cells(t):
                targets = targets.tolist()
                sizes = np.array([len(sets[y]) for y in targets])
                whole = np.concatenate([sets[y] for y in targets])
                place = np.searchsorted(sets[k], whole)
                place[place == len(sets[k])] = 0
                owner = np.repeat(np.arange(len(targets)), sizes)
                both = np.bincount(owner[sets[k][place] == whole], minlength=len(targets))
                for y in np.flatnonzero(100 * both >= percent * (len(sets[k]) + sizes - both)).tolist():
                    found.setdefault((int(node[k]), roots[targets[y]][0]), int(node[targets[y]]))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                              pa.array(list(found.values()), pa.int64())], ["a", "b"])
    return run


def _block_links(tests: DataFrame, node_roots: DataFrame, sets_for, percent: int) -> DataFrame:
    """Links of the probes to any node of the component they are tested with."""
    grid = _grid(tests, node_roots)
    sets = sets_for(grid.select("set_id").distinct())
    return (grid.join(sets, "set_id").repartition(*_CELL).sortWithinPartitions(*_CELL)
            .mapInArrow(_cell_links(percent), "a long, b long"))


def near_duplicates(docs: DataFrame, text: str = "text", size: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row.

    Documents are linked if 100 * |intersection| >= percent * |union| of
    their shingle sets; ``component_id`` is the least id reachable.
    """
    spark = docs.sparkSession
    # registers and shingles are kept once for each set, not for each row: the
    # rows' own sets are named in a second, light pass over the texts
    nodes = settled(sketches(docs, text, size, percent).where(F.col("set_id").isNotNull()).groupBy("set_id")
                    .agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
                         F.first("regs").alias("regs"), F.first("small").alias("small")))
    release(spark)
    sketch = settled(identities(docs, text, size))
    member = settled(_members(nodes, percent))
    release(spark)
    pairs = settled(_plausible_pairs(_hub_pairs(member), nodes, percent))
    release(spark)

    def sets_for(ids: DataFrame) -> DataFrame:
        wanted = settled(_only(nodes.select("set_id", "doc_id"), settled(ids)))
        return settled(_sets_of(docs, text, size, wanted))

    links = settled(_links(pairs, sets_for(pairs.select(F.col("a").alias("set_id")).unionByName(
        pairs.select(F.col("b").alias("set_id"))).distinct()), percent))
    release(spark)
    tied = settled(components(links))

    node_roots = settled(nodes.select("set_id").join(tied.withColumnRenamed("node", "set_id"), "set_id", "left")
                         .select("set_id", F.coalesce("root", "set_id").alias("root")))
    tests = settled(_tests(member, nodes, tied, node_roots, percent))
    del member
    release(spark)
    if not tests.isEmpty():
        met = tests.where("link").select(F.col("probe").alias("a"), F.col("root").alias("b"))
        links = settled(links.unionByName(met).unionByName(
            _block_links(tests.where("not link").drop("link"), node_roots, sets_for, percent)))
        release(spark)
        tied = settled(components(links))

    named = (tied.join(nodes.select(F.col("set_id").alias("node"), "doc_id"), "node")
             .groupBy("root").agg(F.min("doc_id").alias("component_id")))
    name_of = (nodes.select("set_id", F.col("doc_id").alias("own")).join(
        tied.select(F.col("node").alias("set_id"), "root"), "set_id", "left")
        .join(named, "root", "left").select("set_id", F.coalesce("component_id", "own").alias("component_id")))
    return (sketch.join(name_of, "set_id", "left")
            .withColumn("component_id", F.coalesce("component_id", "doc_id"))
            .select("doc_id", "n_shingles", "component_id",
                    F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def drop_near_duplicates(docs: DataFrame, text: str = "text", size: int = SHINGLE,
                         percent: int = PERCENT) -> DataFrame:
    """One document of each component: the one with the least id; columns stay.

    Rows that repeat an id all stay if one of them does; rows without an id
    stay.
    """
    gone = settled(near_duplicates(docs, text, size, percent).where(F.col("doc_id").isNotNull())
                   .groupBy("doc_id").agg(F.max("kept").alias("kept")).where(~F.col("kept")).select("doc_id"))
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    return docs.join(gone, docs["doc_id"].cast("long") == gone["doc_id"], "left_anti")
