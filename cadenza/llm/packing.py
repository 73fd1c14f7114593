"""Packing of tokenized documents into sequences of fixed capacity.

Documents become token ids (a tokenizer file of the ``tokenizers`` library,
then an end id); only those longer than a sequence are cut, into pieces of
full length and a rest.  How to pack depends on the *length histogram* alone,
which has at most ``capacity`` rows whatever the corpus:

1. the configuration linear program (least number of sequences such that the
   configurations used cover every length's count) is solved by
   multiplicative weights.  A length's weight is its price, the dual variable
   of its row: at first its share of the capacity, and with every step
   multiplied down by how much of its count the step covers.  In a round a
   knapsack dynamic program over the capacity finds the dearest configuration
   around the dearest length that is still open, among a sample of the open
   lengths (all of them where they are few); it is taken as often as the counts
   allow if no configuration can be worth more: if it is full, or the sample
   was everything and it repeats.  A length for which ``TRIES`` samples give
   none is set aside;
2. what is taken is whole, so rounding leaves only the lengths set aside: they
   are packed best-fit, again with multiplicities.  A few pieces of a thousand.

Any prices, divided by the worth of the dearest configuration of all, are a
solution of the dual: ``bound`` is the best value of the first and last prices
and of some fixed ones, below which no fractional solution gets, so the gap to
the plan is known (``packing_plan`` with ``with_bound``).

The plan lists configurations with multiplicities, so it stays small for any
number of documents.  Pieces are range-partitioned by (length, doc_id,
piece); a piece's global place in that order (a count per task is all that
is gathered) finds its slot by binary search.  No group of equal lengths
meets in one task.

Defined cases: a null text is empty (just the end id); a null id stays null;
rows that repeat an id are packed each; other columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from cadenza.llm.common import int64, settled, whole_texts

CAPACITY = 4096
END_ID = 1
CACHE = 300_000   # words in a generation of those whose ids a worker keeps
RATE = 0.02       # of the multiplicative weights
SAMPLE = 40       # lengths that a round prices beside the dearest one
TRIES = 4         # samples for a length before it is set aside

_MARKS = "!#$%&*+,-./:;=?@^_`|~"   # ASCII marks that may follow a word

# Fixed value: the pre-tokenizer of the vocabulary whose words are kept apart.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# The byte-level alphabet: bytes that print stand for themselves, the others
# for the characters from U+0100 on.
_PRINT = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_LETTER_OF = {b: b if b in set(_PRINT) else 256 + k for k, b in
              enumerate(sorted(range(256), key=lambda b: (b in set(_PRINT), b)))}

_tokenizer: dict[str, _Words] = {}


class _Words:
    """Ids of blank-separated words, each tokenized once while it is in use.

    The pre-tokenizer above never spans white space and parts letters from
    marks, so the ids of a text are those of its words in turn, those of
    ``word,`` are those of ``word`` and ``,``, and a run of lower-case letters
    can go to the model at once.  Another vocabulary gets whole texts.  What
    was not used since the last change of generation is forgotten.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.wordwise = (steps[0].get("pattern") == {"Regex": _PATTERN}
                         and [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
                         == ["NFC", "Replace", "Lowercase"])
        self.model = self.tokenizer.model
        self.now: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, core: str) -> bytes:
        """Ids of a run of lower-case letters."""
        if not core.isascii():
            core = core.encode().decode("latin-1").translate(_LETTER_OF)
        return array("I", [t.id for t in self.model.tokenize(core)]).tobytes()

    def _piece(self, piece: str, letters: bool) -> bytes:
        ids = self.now.get(piece) or self.old.get(piece)
        if ids is None:
            ids = self._letters(piece) if letters else self.whole([piece])[0]
        self.now[piece] = ids
        return ids

    def add(self, words: set[str]) -> None:
        """Make the ids of all these words known."""
        if len(self.now) > CACHE:
            self.old, self.now = self.now, {}
        now, old, other = self.now, self.old, []
        for w in words.difference(now):
            ids = old.get(w)
            if ids is None:
                core = w.rstrip(_MARKS)
                if not core.isalpha():
                    other.append(w)
                    continue
                low = core.lower()
                if not core.isascii() and (low != core or not is_normalized("NFC", core)):
                    other.append(w)
                    continue
                ids = self._piece(low, True)
                if len(core) < len(w):
                    ids += self._piece(w[len(core):], False)
            now[w] = ids
        now.update(zip(other, self.whole(other)))


def _encode(path: str, texts: list[str]) -> list[np.ndarray]:
    """Ids of each text."""
    if path not in _tokenizer:
        _tokenizer[path] = _Words(path)
    words = _tokenizer[path]
    if not words.wordwise:
        return [np.frombuffer(ids, dtype="<u4") for ids in words.whole(texts)]
    parts = [t.replace("\n", " ").split(" ") for t in texts]
    words.add(set(chain.from_iterable(parts)))
    ids = words.now.__getitem__
    return [np.frombuffer(b"".join(map(ids, p)), dtype="<u4") for p in parts]


def _pieces(path: str, capacity: int, end_id: int):
    end = np.array([end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, piece, length, crc = [], [], [], []
            for i, ids in enumerate(_encode(path, b.column("body").to_pylist())):
                ids = np.concatenate([ids, end])
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    row.append(i)
                    piece.append(k)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
            k = np.array(piece, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(row, pa.int32())), pa.array(k.astype(np.int32)),
                 pa.array(k * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def token_pieces(docs: DataFrame, tokenizer: str, text: str = "text",
                 capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    rows = whole_texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("body"))
    return rows.mapInArrow(_pieces(tokenizer, capacity, end_id),
                           "doc_id long, piece int, start long, length long, ids_crc32 long")


def _worth(price: np.ndarray, capacity: int) -> float:
    """What the dearest configuration of all is worth."""
    sizes = np.flatnonzero(price > 0)
    best = np.zeros(capacity + 1)
    for c in range(1, capacity + 1):
        fits = sizes[:np.searchsorted(sizes, c, side="right")]
        best[c] = max(best[c - 1], (best[c - fits] + price[fits]).max(initial=0.0))
    return float(best[capacity])


def _least(count: np.ndarray, capacity: int) -> float:
    """Sequences that lengths near simple fractions of the capacity need: the
    prices floor((k + 1) s / capacity) / k, k = 1 ... 8, are dual solutions
    (where the quotient is whole, the length's share instead)."""
    sizes = np.arange(capacity + 1)
    out = 0.0
    for k in range(1, 9):
        parts = (k + 1) * sizes
        price = np.where(parts % capacity == 0, sizes / capacity, parts // capacity / k)
        out = max(out, float((count * price).sum()))
    return out


def _fill(room: int, sizes: np.ndarray, price: np.ndarray, have: np.ndarray) -> dict[int, int]:
    """The dearest filling of a room with at most ``have`` of each size."""
    items = []   # so many of a size at once: 1, 2, 4 ... and the rest
    for s in sizes.tolist():
        n, k = int(min(have[s], room // s)), 1
        while n > 0:
            items.append((s, min(k, n)))
            n -= min(k, n)
            k *= 2
    best = np.zeros(room + 1)
    taken = np.zeros((len(items), room + 1), dtype=bool)
    for i, (s, n) in enumerate(items):
        with_it = best[:room + 1 - s * n] + n * price[s]
        taken[i, s * n:] = with_it > best[s * n:] + 1e-12
        best[s * n:] = np.maximum(best[s * n:], with_it)
    out: dict[int, int] = {}
    for i in range(len(items) - 1, -1, -1):
        if taken[i, room]:
            s, n = items[i]
            out[s] = out.get(s, 0) + n
            room -= s * n
    return out


def _program(count: np.ndarray, capacity: int) -> tuple[list[tuple[dict, int]], np.ndarray, float]:
    """Configurations (length to number) and how often each is taken, the
    counts that are left, and the dual bound."""
    rng = np.random.default_rng(capacity)   # seeded: the plan repeats
    left, aside = count.copy(), np.zeros(capacity + 1, dtype=bool)
    share = np.arange(capacity + 1) / capacity
    price = np.where(count > 0, share, 0.0)
    bound = float((count * price).sum()) / max(_worth(price, capacity), 1e-9)
    solution = []
    while True:
        live = np.flatnonzero(left)
        open_ = live[~aside[live]]
        if not len(open_):
            break
        dearest = int(open_[price[open_].argmax()])
        have = left.copy()
        have[dearest] -= 1
        for _ in range(TRIES):
            beside = live[live <= capacity - dearest]
            everything = len(beside) <= SAMPLE
            if not everything:
                beside = np.sort(rng.choice(beside, SAMPLE, replace=False, p=left[beside] / left[beside].sum()))
            config = _fill(capacity - dearest, beside, price, have)
            config[dearest] = config.get(dearest, 0) + 1
            times = min(int(left[s]) // n for s, n in config.items())
            good = sum(s * n for s, n in config.items()) == capacity or (everything and times > 1)
            if good or everything:
                break
        if not good:
            aside[dearest] = True
            continue
        for s, n in config.items():
            left[s] -= times * n
            price[s] *= np.exp(-RATE * times * n / count[s])
        solution.append((config, times))
    bound = max(bound, float((count * price).sum()) / max(_worth(price, capacity), 1e-9), _least(count, capacity))
    return solution, left, bound


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Pack what is left, longest first, with multiplicities."""
    out = []
    have = left > 0
    top = capacity
    while True:
        while top and not have[top]:
            top -= 1
        if not top:
            return out
        config, room = {}, capacity

        def take(s: int) -> None:
            config[s] = config.get(s, 0) + 1
            have[s] = left[s] > config[s]
        take(top)
        room -= top
        while room:
            if have[room]:
                s = room
            else:
                pair = np.flatnonzero(have[1:room] & have[room - 1:0:-1])
                pair = pair[pair + 1 != room - pair - 1] + 1 if len(pair) else pair
                if len(pair):
                    s = int(pair[-1])
                else:
                    lower = np.flatnonzero(have[:room])
                    if not len(lower):
                        break
                    s = int(lower[-1])
            take(s)
            room -= s
        times = min(int(left[s]) // a for s, a in config.items())
        for s, a in config.items():
            left[s] -= times * a
            have[s] = left[s] > 0
        out.append((tuple(sorted(chain.from_iterable([s] * a for s, a in config.items()), reverse=True)), times))


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY, with_bound: bool = False):
    """[(configuration, times)] that uses every piece of the histogram once;
    with ``with_bound`` also the pieces that the linear program placed and the
    least number of sequences that any solution needs."""
    count = np.zeros(capacity + 1, dtype=np.int64)
    for s, n in histogram.items():
        count[s] = n
    solution, left, bound = _program(count, capacity) if count.any() else ([], count, 0.0)
    placed = int((count - left).sum())
    plan = [(tuple(chain.from_iterable([s] * n for s, n in sorted(config.items(), reverse=True))), times)
            for config, times in solution] + _best_fit(left.copy(), capacity)
    return (plan, placed, bound) if with_bound else plan


def _slots(plan: list[tuple[tuple, int]]) -> dict[str, np.ndarray]:
    """Runs of equal slots in order of length; ``first`` is the place, in the
    order of all pieces by length, of the piece that takes a run's first slot."""
    rows, base = [], 0
    for config, times in plan:
        sizes, need = np.unique(config, return_counts=True)
        at = 0
        for s, a in zip(sizes[::-1].tolist(), need[::-1].tolist()):
            rows.append((s, base, a, at, a * times))
            at += s * a
        base += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return {"first": np.concatenate([[0], np.cumsum(table[:, 4])])[:-1].astype(np.int64),
            "base": table[:, 1], "each": table[:, 2], "at": table[:, 3]}


def _placed(slots, starts: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = slots.value
        place = starts.get(TaskContext.get().partitionId(), 0)
        for b in batches:
            at = place + np.arange(b.num_rows, dtype=np.int64)
            place += b.num_rows
            run_of = np.searchsorted(s["first"], at, side="right") - 1
            nth = at - s["first"][run_of]
            each = s["each"][run_of]
            offset = s["at"][run_of] + nth % each * int64(b.column("length"))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(s["base"][run_of] + nth // each), pa.array(offset)],
                [*b.schema.names, "sequence_id", "offset"])
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset (gapless from 0 in a sequence)."""
    spark = pieces.sparkSession
    order = ["length", "doc_id", "piece", "ids_crc32"]
    ranged = settled(settled(pieces).repartitionByRange(*order).sortWithinPartitions(*order))
    # at most `capacity` rows, and one row per task
    histogram = {r[0]: r[1] for r in ranged.groupBy("length").count().collect()}
    sizes = sorted(tuple(r) for r in ranged.groupBy(F.spark_partition_id()).count().collect())
    starts, total = {}, 0
    for part, n in sizes:
        starts[part] = total
        total += n
    slots = spark.sparkContext.broadcast(_slots(packing_plan(histogram, capacity)))
    return ranged.mapInArrow(_placed(slots, starts), "doc_id long, piece int, start long, length long, "
                             "ids_crc32 long, sequence_id long, offset long")
