"""Language identification by cross-parsing entropy.

A suffix automaton over labelled text of each language parses a text into
the longest phrases that occur in that language's text.  The entropy estimate
of a language is (phrases * log2(size of its text)) / length; the language
with the least wins, ties by name.  A text is parsed in segments of
``SEGMENT`` letters, so that a task walks thousands of segments in step
through the automaton's dense transition table, whatever the texts' lengths.

A phrase also ends with its segment: at most one phrase in 256 letters more
than the whole text has, for every language alike.

The labelled text is a bounded sample: the ``languages`` most frequent values
of ``lang``; of each at most ``rows`` different documents, those of the least
hash of id and text; of a text its first characters, such that a language's
texts together take its share of ``chars``, long ones as much as each other
(at most an eighth of the share).  So every language with any labelled text is
learned, however long its texts are and however many share an id.  Everything else covers all documents.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text if there is nothing to learn from; a null id is not held
out; rows that repeat an id stay rows; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cadenza.llm.common import held_out, text_bytes, whole_texts
from cadenza.llm.letters import alphabet, codes, groups, letter_table, strings

ROWS = 64            # documents to learn from, for each language
CHARS = 160_000      # of all languages together
LANGUAGES = 256      # learned at most
LETTERS = 60
SEGMENT = 256
LANES = 2_000_000    # characters walked at once

_BREAK = 1 << 30


def labelled_texts(docs: DataFrame, rows: int = ROWS, chars: int = CHARS,
                   languages: int = LANGUAGES) -> dict[str, list[str]]:
    """language -> texts of the bounded sample."""
    known = (docs.where(~held_out() & F.col("lang").isNotNull() & (F.length("text") > 0))
             .select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"),
                     F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000_007)).alias("h")))
    counts = (known.groupBy("lang").agg(F.count("*").alias("n"), F.min("h").alias("least"))
              .orderBy(F.desc("n"), "lang").limit(languages).collect())
    if not counts:
        return {}
    # a share of each language's rows that holds a few times `rows`, and at least its first
    limit = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(max(
        r["least"], int(min(1.0, 4.0 * rows / r["n"]) * 1_000_000_007))))])
    share = max(1, chars // len(counts))
    some = (known.where(F.col("h") <= limit[F.col("lang")])
            .select("lang", "h", F.substring("text", 1, max(1, share // 8)).alias("text"))
            .groupBy("lang", "h").agg(F.min("text").alias("text")))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    out: dict[str, list[str]] = {r["lang"]: [] for r in counts}
    for r in some.withColumn("nth", nth).where(F.col("nth") <= rows).orderBy("lang", "nth").collect():
        out[r["lang"]].append(r["text"])
    return {k: _shared_out(v, share) for k, v in sorted(out.items())}


def _shared_out(texts: list[str], chars: int) -> list[str]:
    """The texts' beginnings, ``chars`` together: short ones whole, the others
    cut alike."""
    out = []
    for k, t in enumerate(sorted(texts, key=len)):
        out.append(t[:max(1, (chars - sum(map(len, out))) // (len(texts) - k))])
    return out


def suffix_automaton(text: np.ndarray, width: int) -> np.ndarray:
    """Transition table of the suffix automaton, flat: row s * width.

    An entry is the target's row; where there is no transition it is that
    from the root, marked as a break.  Code ``width - 1`` pads: it stays.
    """
    link, length, step = [-1], [0], [{}]
    last = 0
    for c in text.tolist():
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    root = np.full(width, 0, dtype=np.int32)
    for c, t in step[0].items():
        root[c] = t * width
    table = np.tile(root | _BREAK, (len(step), 1))
    for s, t in enumerate(step):
        for c, to in t.items():
            table[s, c] = to * width
    table[:, width - 1] = np.arange(len(step), dtype=np.int32) * width
    return table.ravel()


def phrases(segments: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Phrases of each segment (a row each)."""
    state = np.zeros(len(segments), dtype=np.int32)
    broken = np.ones(len(segments), dtype=np.int32)
    for column in np.ascontiguousarray(segments.T):
        to = table[state + column]
        broken += to >> 30
        state = to & (_BREAK - 1)
    return broken


_models: dict[str, tuple] = {}


def _model(name: str, shared) -> tuple:
    if name not in _models:
        _models.clear()
        texts = shared.value
        letters = alphabet((t for ts in texts.values() for t in ts), LETTERS)
        table, width = letter_table(letters), len(letters) + 3
        automata, bits = [], []
        for ts in texts.values():
            parts = [codes("\n" + t, table) for t in ts]
            whole = np.concatenate(parts)
            automata.append(suffix_automaton(whole, width))
            bits.append(np.log2(max(2, len(whole))))
        _models[name] = list(texts), table, width, automata, np.array(bits)
    return _models[name]


def _predicted(name: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            languages, table, width, automata, bits = _model(name, shared)
            texts = strings(b.column("body"))
            pred, score = ["und"] * len(texts), np.zeros(len(texts))
            for lo, hi in groups(texts, LANES):
                coded = [codes(t, table) for t in texts[lo:hi]]
                some = [k for k, c in enumerate(coded) if c.any()
                        or any(x > "￿" and x.isalpha() for x in texts[lo + k])]
                if not some or not languages:
                    continue
                n_seg = np.array([max(1, -(-len(coded[k]) // SEGMENT)) for k in some])
                first = np.cumsum(n_seg) - n_seg
                lanes = np.full(int(n_seg.sum()) * SEGMENT, width - 1, dtype=np.uint8)
                for k, f in zip(some, first.tolist()):
                    lanes[f * SEGMENT:f * SEGMENT + len(coded[k])] = coded[k]
                lanes = lanes.reshape(-1, SEGMENT)
                cost = np.stack([np.add.reduceat(phrases(lanes, a), first) * n
                                 for a, n in zip(automata, bits)])
                best = cost.argmin(axis=0)
                sure = 1 / np.exp2((cost.min(axis=0) - cost) / 8).sum(axis=0)
                for k, x, s in zip(some, best.tolist(), sure.tolist()):
                    pred[lo + k], score[lo + k] = languages[x], s
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(pred, pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, texts: dict[str, list[str]]) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, by the labelled texts."""
    shared = docs.sparkSession.sparkContext.broadcast(texts)
    rows = whole_texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       text_bytes().alias("body"))
    return rows.mapInArrow(_predicted(uuid.uuid4().hex, shared),
                           "doc_id long, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame, rows: int = ROWS, chars: int = CHARS) -> DataFrame:
    """Learn from the labelled rows that are not held out; predict every row."""
    return identify(docs, labelled_texts(docs, rows, chars))
