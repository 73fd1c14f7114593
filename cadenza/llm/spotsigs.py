"""Document fingerprints by SpotSigs.

A signature is an anchor (a common word, a sentence's or the text's start)
with the two content words that follow it; a fingerprint is the set of a
text's signatures, as 32-bit hashes.  Navigation and junk have few anchors,
prose has many, so the set describes the prose.  The likeness of two
fingerprints is their Jaccard similarity.

As a string a fingerprint is the set's size, a colon, and base64 of the
sorted hashes: no signature is left out, however long the text.

Defined cases: a null text is empty; a text without content words after an
anchor has one signature of all its words, one without words has none; two
empty sets are alike (1.0), an empty set and another are not (0.0).  In the
order of documents a null id comes last, rows that repeat an id follow each
other by a hash of the text.  Other columns are ignored.  Ids are integers.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cadenza.llm.common import int64, text_bytes, whole_texts
from cadenza.llm.near_dedup import _MULTIPLIERS, _chunks, _mixed, _word_hashes

# Common words that anchor signatures, by language.
COMMON_WORDS = {
    "en": "a an and are as at be by for from has have he her his i in is it its not of on or "
          "she that the their there they this to was we were which will with you",
    "de": "als am an auch auf aus bei das dem den der des die ein eine einen einer er es für hat "
          "ich im in ist mit nicht oder sich sie sind um und von war wie wird zu zum zur",
    "fr": "au aux avec ce ces dans de des du elle en est et il je la le les leur mais ne nous on "
          "ou par pas plus pour que qui sa se ses son sont sur un une vous à",
    "es": "a al como con de del el ella en entre era es esta este ha la las lo los más no o para "
          "pero por que se ser sin su sus también un una y ya",
}

_BREAK = b"\x01"
_WORD = bytes(1 if c in b".!?\n" else c if 0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c >= 0x80
              else 0x20 for c in range(256))


def _marked(body: bytes) -> bytes:
    """Words parted by blanks, with a mark where a sentence begins."""
    return _BREAK + b" " + body.translate(_WORD).replace(_BREAK, b" \x01 ")


def _anchors(words: dict[str, str]) -> np.ndarray:
    some = sorted({w.encode() for line in words.values() for w in line.split()})
    return np.sort(_word_hashes([_BREAK, *some])[0])


def spot_sets(bodies: list[bytes], words: dict[str, str] = COMMON_WORDS) -> list[np.ndarray]:
    """The sorted distinct signatures of each text."""
    h, n_words = _word_hashes([_marked(b) for b in bodies])
    anchors = _anchors(words)
    place = np.searchsorted(anchors, h)
    place[place == len(anchors)] = 0
    common = anchors[place] == h
    owner = np.repeat(np.arange(len(bodies)), n_words)
    content = np.flatnonzero(~common)
    spot = np.flatnonzero(common)
    nxt = np.searchsorted(content, spot)
    spot, nxt = spot[nxt < len(content)], nxt[nxt < len(content)]
    own = owner[spot] == owner[content[nxt]] if len(spot) else np.zeros(0, bool)
    spot, nxt = spot[own], nxt[own]
    one = content[nxt]
    two = content[np.minimum(nxt + 1, max(len(content) - 1, 0))] if len(content) else one
    chain = np.where((nxt + 1 < len(content)) & (owner[two] == owner[one]), h[two], np.uint64(0)) if len(one) \
        else np.zeros(0, np.uint64)
    sig = (_mixed(h[spot] * _MULTIPLIERS[0] + h[one] * _MULTIPLIERS[1] + chain * _MULTIPLIERS[2])
           >> np.uint64(32)).astype(np.uint32)
    cut = np.searchsorted(owner[spot], np.arange(len(bodies) + 1))
    ends = np.cumsum(n_words)
    out = []
    for k in range(len(bodies)):
        if cut[k] < cut[k + 1]:
            out.append(np.unique(sig[cut[k]:cut[k + 1]]))
            continue
        ws = h[ends[k] - n_words[k]:ends[k]]
        ws = ws[ws != _MARK_HASH]
        if len(ws):   # anchors only
            whole = (ws * (np.arange(len(ws), dtype=np.uint64) * np.uint64(2) + _MULTIPLIERS[3])).sum(dtype=np.uint64)
            out.append((_mixed(np.array([whole])) >> np.uint64(32)).astype(np.uint32))
        else:
            out.append(np.zeros(0, np.uint32))
    return out


_MARK_HASH = _word_hashes([_BREAK])[0][0]


def fingerprint(spots: np.ndarray) -> str:
    return f"{len(spots)}:{base64.b64encode(spots.astype('<u4').tobytes()).decode()}"


def spots_of(text: str) -> np.ndarray:
    """The set that a fingerprint holds."""
    return np.frombuffer(base64.b64decode(text.partition(":")[2]), dtype="<u4")


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; 0 at once if their sizes
    exclude ``at_least``."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if not small or small < at_least * large:
        return 0.0
    place = np.searchsorted(b, a)
    place[place == len(b)] = 0
    both = int((b[place] == a).sum())
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_spots, fingerprint of every row (no shuffle)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bodies = b.column("body").to_pylist()
            for lo, hi in _chunks(bodies):
                sets = spot_sets(bodies[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([fingerprint(s) for s in sets], pa.string())], ["doc_id", "n_spots", "fingerprint"])
    rows = whole_texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes(text).alias("body"))
    return rows.mapInArrow(run, "doc_id long, n_spots long, fingerprint string")


_FOLLOW = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
           "edited_fingerprint string, near_edited double, near_next double")


def _edited(text: str, following: str) -> str:
    n = len(text) // 3
    return text[:len(text) - n] + following[:n] if n else text


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket; each meets the row behind it.  A bucket's
    last row (``extra``) is the next bucket's first and only looked at."""
    held: list = []   # (bucket, extra, doc_id, body) not answered yet

    def answer(rows: list, more: bool) -> tuple[pa.RecordBatch, list]:
        texts = [r[3].decode("utf-8", "replace") for r in rows]
        sets = spot_sets([r[3] for r in rows])
        out, new, at = [], [], []
        for k in range(len(rows) - 1):
            if not rows[k][1]:
                new.append(_edited(texts[k], texts[k + 1]).encode("utf-8", "replace"))
                at.append(k)
        for k, body, spots in zip(at, new, spot_sets(new)):
            out.append((rows[k][2], len(texts[k]), hashlib.sha256(body).hexdigest(), fingerprint(sets[k]),
                        fingerprint(spots), likeness(sets[k], spots), likeness(sets[k], sets[k + 1])))
        cols = list(zip(*out)) if out else [()] * 7
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [c.split()[0] for c in _FOLLOW.split(", ")]
        return (pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names),
                rows[-1:] if more else [])

    for b in batches:
        rows = list(zip(*(b.column(c).to_pylist() for c in ("bucket", "extra", "doc_id", "body"))))
        for lo, hi in _chunks([r[3] for r in rows]):
            made, held = answer(held + rows[lo:hi], True)
            yield made


def compared_with_next(docs: DataFrame, text: str = "text", buckets: int | None = None) -> DataFrame:
    """Fingerprints of every row and of its edited text, and their likeness.

    The edited text's last third is the start of the next document's text, in
    descending order of ids (after the last: the first).  Rows are dealt to
    ``buckets`` ranges of ids (by default four for each shuffle partition);
    each bucket also gets the next bucket's first row, so no order over all
    rows meets in one task.
    """
    spark = docs.sparkSession
    if not buckets:
        buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = F.lit(-(1 << 63)).cast("long")
    rows = whole_texts(docs).select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("doc_id").cast("long"), least).alias("ord"),
                       F.xxhash64(text).alias("h"), text_bytes(text).alias("body"))
    # upper ends of the buckets: as many numbers as there are buckets
    marks = rows.agg(F.percentile_approx("ord", [k / buckets for k in range(1, buckets)], 20 * buckets)).first()[0]
    bounds = np.unique(np.array(marks or [], dtype=np.int64))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = np.searchsorted(bounds, int64(b.column("ord")), side="left").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), *b.columns], ["bucket", *b.schema.names])

    placed = rows.mapInArrow(dealt, "bucket int, doc_id long, ord long, h long, body binary")
    # a row for each bucket
    firsts = sorted(((r.bucket, r.top.ord, r.top.h) for r in
                     rows.select("ord", "h").mapInArrow(dealt, "bucket int, ord long, h long")
                     .groupBy("bucket").agg(F.max(F.struct("ord", "h")).alias("top")).collect()), reverse=True)
    if not firsts:
        return rows.where("false").mapInArrow(_followed, _FOLLOW)
    wanted = spark.createDataFrame(
        [(bucket, *firsts[(k + 1) % len(firsts)][1:]) for k, (bucket, _, _) in enumerate(firsts)],
        "bucket int, ord long, h long")
    extra = (rows.join(F.broadcast(wanted), ["ord", "h"]).dropDuplicates(["bucket", "ord", "h"])
             .select("bucket", F.lit(True).alias("extra"), "doc_id", "ord", "h", "body"))
    stream = (placed.select("bucket", F.lit(False).alias("extra"), "doc_id", "ord", "h", "body")
              .unionByName(extra).repartition("bucket")
              .sortWithinPartitions(F.desc("bucket"), "extra", F.desc("ord"), F.desc("h")))
    return stream.select("bucket", "extra", "doc_id", "body").mapInArrow(_followed, _FOLLOW)
