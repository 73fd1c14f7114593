"""Toxicity by a subsequence string-kernel support vector machine.

The kernel compares short stretches of letters: a stretch is described by all
its four-letter subsequences with at most one letter left out between
neighbours, each weighted ``DECAY`` for every letter skipped (blanks and
other marks count as one letter, so ``i.d.i o t`` and ``idixot`` stay close
to ``idiot``).  Subsequences are hashed to ``2**HASH_BITS`` numbers, which
keeps the kernel positive.  Nyström landmarks (stretches that tell toxic
sentences from clean ones, and the clean stretches nearest to them) turn it
into few features, on which a linear machine with squared hinge loss is fit.

Labels hold for documents, not sentences, so training alternates: the best
stretch of each toxic document is a positive example, all stretches of clean
documents are negatives, of which the highest are added each round.  A
document's score is the logistic function of its highest stretch, calibrated
on labelled documents that the machine has not seen.

As the kernel is linear in the hashed subsequences, the weighted sum over the
landmarks is itself one vector of weights: a text of any length is scored
whole by a table look-up per letter and gap pattern, without a cap.

Labels come from a bounded sample: at most ``toxic_rows`` toxic and
``clean_rows`` clean labelled documents of at most ``max_chars`` characters,
none of them held out.  Defined cases: null and empty texts are scored as a
text without letters; a document that any label row calls toxic is toxic,
null labels say nothing; without labels of both kinds every score is 0;
null ids are not held out; rows that repeat an id stay rows; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from cadenza.llm.common import held_out, text_bytes, whole_texts
from cadenza.llm.letters import alphabet, codes, groups, letter_table, strings

TOXIC_ROWS = 1000
CLEAN_ROWS = 2500
MAX_CHARS = 10_000
THRESHOLD = 0.7

LETTERS = 60
HASH_BITS = 18
DECAY = 0.8
STRETCH = 6          # subsequences start at so many letters in a row
LANDMARKS = 400
ROUNDS = 6
VOTES = 3             # machines of the last rounds that make the model
DISGUISED = 300      # words shown again with letters or blanks put in
CHUNK = 1 << 18      # letters scored at once

_STEPS = list(product((1, 2), repeat=3))
_GAPS = [(a, a + b, a + b + c) for a, b, c in _STEPS]
_DECAYS = np.array([DECAY ** (a + b + c - 3) for a, b, c in _STEPS], dtype=np.float32)
_REACH = 6
_PAD = 63            # a code of its own between texts


def _hashed(x: np.ndarray, at: np.ndarray | slice, gaps: tuple[int, int, int], n: int) -> np.ndarray:
    """Subsequence numbers for the starts ``at`` (n of them if a slice)."""
    def code(g):
        return (x[g:g + n] if isinstance(at, slice) else x[at + g]).astype(np.uint32)
    a, b, c = gaps
    h = code(0) | code(a) << np.uint32(6) | code(b) << np.uint32(12) | code(c) << np.uint32(18)
    return (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - HASH_BITS)


def _joined(coded: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One array of all texts, each with a 0 around it and padding behind;
    and the texts' starts."""
    tail = np.full(_REACH + STRETCH, _PAD, dtype=np.uint8)
    zero = np.zeros(1, dtype=np.uint8)
    parts, starts, at = [], [], 0
    for c in coded:
        starts.append(at)
        lead = zero if not len(c) or c[0] else zero[:0]
        last = zero if len(c) and c[-1] else zero[:0]
        parts += [lead, c, last, tail]
        at += len(lead) + len(c) + len(last) + len(tail)
    x = np.concatenate(parts) if parts else np.zeros(0, np.uint8)
    return x, np.array(starts, dtype=np.int64)


def _stretch_sums(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The weights' sum over the stretch that begins at each letter; none
    begins in a text's padding, from where it would reach the next text."""
    total = np.zeros(len(x), dtype=np.float32)
    for lo in range(0, len(x) - _REACH, CHUNK):
        m = min(CHUNK + STRETCH - 1, len(x) - _REACH - lo)
        s = np.zeros(m, dtype=np.float32)
        part = x[lo:lo + m + _REACH]
        for gaps, decay in zip(_GAPS, _DECAYS):
            s += decay * weights[_hashed(part, slice(None), gaps, m)]
        n = min(CHUNK, m)
        out = total[lo:lo + n]
        for k in range(STRETCH):
            own = s[k:k + n]
            out[:len(own)] += own
    total[x == _PAD] = -np.inf
    return total


def _features(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Subsequence numbers (rows: stretches at ``at``), as _values weighs them."""
    return np.concatenate([_hashed(x, at + k, g, 0)[:, None] for k in range(STRETCH) for g in _GAPS], axis=1)


_VALUES = np.tile(_DECAYS, STRETCH)


@dataclass
class Model:
    """Letters, weights of hashed subsequences, and the calibration."""

    letters: str
    weights: np.ndarray
    slope: float
    offset: float

    def scores(self, texts: list[str], table: np.ndarray) -> np.ndarray:
        out = np.zeros(len(texts))
        for lo, hi in groups(texts, 500_000):
            x, starts = _joined([codes(t, table) for t in texts[lo:hi]])
            best = np.maximum.reduceat(_stretch_sums(x, self.weights), starts)
            out[lo:hi] = 1 / (1 + np.exp(-np.clip(self.slope * best + self.offset, -30, 30)))
        return out


def _dense(features: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Stretches over the ``known`` subsequences only."""
    place = np.searchsorted(known, features)
    place[place == len(known)] = 0
    hit = known[place] == features
    out = np.zeros((len(features), len(known)), dtype=np.float32)
    rows = np.broadcast_to(np.arange(len(features))[:, None], features.shape)
    np.add.at(out, (rows[hit], place[hit]), np.broadcast_to(_VALUES, features.shape)[hit])
    return out


def _machine(z: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float) -> tuple[np.ndarray, float]:
    """Linear machine, squared hinge loss, Newton's method on the active set."""
    w = np.zeros(z.shape[1] + 1)
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-4
    for _ in range(25):
        gram, right = ridge.copy(), np.zeros(len(w))
        active = np.flatnonzero(y * (z @ w[:-1].astype(z.dtype) + w[-1]) < 1)
        for k in np.array_split(active, 1 + len(active) // 2000):
            a = np.hstack([z[k], np.ones((len(k), 1), dtype=z.dtype)]).astype(float)
            weighed = a.T * (cost * weight[k])
            gram += weighed @ a
            right += weighed @ y[k]
        new = np.linalg.solve(gram, right)
        if np.allclose(new, w, atol=1e-6):
            break
        w = new
    return w[:-1], float(w[-1])


def _kernel_machine(pos: np.ndarray, neg: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, float]:
    """Weights of subsequences and the bias, from feature rows of both kinds."""
    half = LANDMARKS // 2
    marks = np.concatenate([f[rng.permutation(len(f))[:half]] for f in
                            (np.unique(pos, axis=0), np.unique(neg, axis=0))])
    known = np.unique(marks)
    m = _dense(marks, known)
    rows = np.concatenate([pos, neg])
    between = (m @ m.T).astype(float)
    scale = float(np.mean(np.diag(between)))
    value, vector = np.linalg.eigh(between / scale)
    keep = value > 1e-6 * value[-1]
    root = vector[:, keep] / np.sqrt(value[keep])
    to = (m.T @ (root / scale)).astype(np.float32)   # Nyström features of a stretch
    z = np.concatenate([_dense(rows[lo:lo + 500], known) @ to for lo in range(0, len(rows), 500)])
    y = np.concatenate([np.ones(len(pos)), -np.ones(len(neg))])
    share = np.where(y > 0, 0.5 / len(pos), 0.5 / len(neg)) * len(y)
    w, bias = _machine(z, y, share, 10.0)
    weights = np.zeros(1 << HASH_BITS, dtype=np.float32)
    weights[known] = to @ w
    return weights, bias


def _disguised(x: np.ndarray, at: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The words at the stretches with a letter put in, and with blanks
    between all letters; and the texts' starts."""
    made = []
    for p in at.tolist():
        middle = p + STRETCH // 2
        lo = hi = middle if x[middle] else middle + 1
        while lo > 0 and 0 < x[lo - 1] < _PAD and middle - lo < 20:
            lo -= 1
        while 0 < x[hi] < _PAD and hi - middle < 20:
            hi += 1
        word = x[lo:hi]
        if len(word) >= 4:
            made.append(np.insert(word, rng.integers(2, len(word) - 1), rng.integers(1, 27)))
            spaced = np.zeros(2 * len(word), dtype=np.uint8)
            spaced[::2] = word
            made.append(spaced)
    return _joined(made)


def _highest(sums: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Place of each text's highest stretch."""
    ends = np.append(starts[1:], n)
    return np.array([s + int(sums[s:e].argmax()) for s, e in zip(starts.tolist(), ends.tolist())])


def train(texts: list[str], toxic: np.ndarray, seed: int = 7) -> Model | None:
    """Fit on labelled documents; None if a kind is missing."""
    toxic = np.asarray(toxic, dtype=bool)
    if not toxic.any() or toxic.all():
        return None
    letters = alphabet(texts, LETTERS)
    table = letter_table(letters)
    rng = np.random.default_rng(seed)
    learn = np.ones(len(texts), dtype=bool)
    for kind in (toxic, ~toxic):   # a fifth is kept for the calibration
        own = rng.permutation(np.flatnonzero(kind))
        learn[own[:len(own) // 5]] = False
    coded = [codes(t, table) for t in texts]
    x, starts = _joined([c for c, k in zip(coded, learn) if k])
    y = toxic[learn]
    n = len(x)
    ends = np.append(starts[1:], n)

    # first weights: how much likelier a subsequence is in toxic documents
    found = np.zeros((2, 1 << HASH_BITS), dtype=np.float32)
    for s, e, t in zip(starts.tolist(), ends.tolist(), y.tolist()):
        some = np.arange(s, max(s, e - _REACH))
        found[int(t), np.unique(np.concatenate([_hashed(x, some, g, 0) for g in _GAPS]))] += 1
    odds = (np.log((found[1] + 0.5) / (y.sum() + 1)) - np.log((found[0] + 0.5) / ((~y).sum() + 1)))
    weights = np.where(found[1] >= 2, np.maximum(odds, 0) * found[1] / (found[1] + 2), 0).astype(np.float32)

    negatives = [rng.integers(0, n - _REACH - STRETCH, 2000)]
    owner = np.searchsorted(starts, negatives[0], side="right") - 1
    negatives[0] = negatives[0][~y[owner]]
    bias, machines = 0.0, []
    for _ in range(ROUNDS):
        sums = _stretch_sums(x, weights)
        top = _highest(sums, starts, n)
        positive = top[y]
        strong = sums[positive] >= np.quantile(sums[top[~y]], 0.9)
        negatives.append(top[~y])
        high = np.flatnonzero(sums > -0.5 - bias)
        high = high[~y[np.searchsorted(starts, high, side="right") - 1]]
        negatives.append(rng.permutation(high)[:2000])
        del negatives[1:-6]   # random ones, and those of the last three rounds
        neg = np.unique(np.concatenate(negatives))
        pos = positive[strong] if strong.sum() >= 2 else positive
        pos = _features(x, pos)
        hidden, at = _disguised(x, rng.permutation(positive[strong])[:DISGUISED], rng)
        if len(at):
            pos = np.concatenate([pos, _features(hidden, _highest(_stretch_sums(hidden, weights), at, len(hidden)))])
        machines.append(_kernel_machine(pos, _features(x, neg), rng))
        # the machines of the last rounds, each with landmarks of its own, vote;
        # as they are linear in the subsequences, so is their mean
        weights = np.mean([w for w, _ in machines[-VOTES:]], axis=0)
        bias = float(np.mean([b for _, b in machines[-VOTES:]]))

    rest, first = _joined([c for c, k in zip(coded, learn) if not k] or [np.zeros(0, np.uint8)])
    kept = toxic[~learn]
    if kept.any() and not kept.all():
        best, kind = np.maximum.reduceat(_stretch_sums(rest, weights), first), kept
    else:
        best, kind = np.maximum.reduceat(_stretch_sums(x, weights), starts), y
    slope = max(1.0, _logistic(best, kind)[0])
    return Model(letters, weights, slope, np.log(THRESHOLD / (1 - THRESHOLD)) - slope * _cut(best, kind))


def _cut(value: np.ndarray, kind: np.ndarray) -> float:
    """The value that parts the kinds with the fewest errors; the middle of
    the widest such gap."""
    order = np.argsort(value)
    v, k = value[order], kind[order]
    errors = np.concatenate([[0], np.cumsum(k)]) + np.concatenate([[0], np.cumsum(~k)])[-1] \
        - np.concatenate([[0], np.cumsum(~k)])
    lo, hi = np.concatenate([[v[0] - 1], v]), np.concatenate([v, [v[-1] + 1]])
    gap = np.where(errors == errors.min(), hi - lo, -1.0)
    at = int(gap.argmax())
    return float((lo[at] + hi[at]) / 2)


def _logistic(value: np.ndarray, kind: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic calibration, with smoothed targets."""
    n1, n0 = kind.sum(), (~kind).sum()
    target = np.where(kind, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a = np.stack([value, np.ones(len(value))], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        hess = (a * (p * (1 - p))[:, None]).T @ a + 1e-4 * np.eye(2)
        step = np.linalg.solve(hess, a.T @ (target - p) - 1e-4 * w)
        w += np.clip(step, -2, 2)
    return float(max(w[0], 1e-3)), float(w[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, toxic_rows: int = TOXIC_ROWS,
                    clean_rows: int = CLEAN_ROWS, max_chars: int = MAX_CHARS) -> list[tuple[str, bool]]:
    """(text, toxic) of the bounded sample that the model learns from."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic"))
             .withColumn("h", F.xxhash64("doc_id")))
    out = []
    for toxic, rows in ((True, toxic_rows), (False, clean_rows)):
        # twice the rows, as some ids may have no text or one too long
        some = known.where((F.col("toxic") == 1) == toxic).orderBy("h", "doc_id").limit(2 * rows)
        found = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                 .where(F.length("text").between(1, max_chars))
                 .join(F.broadcast(some), "doc_id").orderBy("h", "doc_id", "text").limit(rows))
        out += [(r.text, toxic) for r in found.select("text").collect()]
    return out


def learn(docs: DataFrame, labels: DataFrame, **bounds) -> Model | None:
    """The model that the labelled documents give."""
    sample = labelled_sample(docs, labels, **bounds)
    return train([t for t, _ in sample], np.array([k for _, k in sample])) if sample else None


_tables: dict[str, np.ndarray] = {}


def _scored(shared, texts: list[str]) -> np.ndarray:
    model = shared.value
    if model is None:
        return np.zeros(len(texts))
    if model.letters not in _tables:
        _tables.clear()
        _tables[model.letters] = letter_table(model.letters)
    return model.scores(texts, _tables[model.letters])


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = _scored(shared, strings(b.column("body")))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s),
                 pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])
    rows = whole_texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       text_bytes().alias("body"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold; columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(DoubleType())
    def scored(body):
        import pandas as pd

        return pd.Series(_scored(shared, [b.decode("utf-8", "replace") for b in body]))
    return whole_texts(docs).where(scored(text_bytes()) < threshold)
