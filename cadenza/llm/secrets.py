"""Secret scan: candidates by pattern, false positives removed by a forest.

A candidate is a run of at least ``MIN_LENGTH`` key characters that holds a
digit, or that follows a name such as ``password`` and ``=`` or ``:``.  A
random forest judges each by its length, the shares of character classes and
of transitions between them, its entropy, how much of it common letter pairs
of the surrounding text (the *dictionary*) cover, the words beside it and the
file's path.  The character string itself is no feature.

The forest is trained on labelled findings, a bounded sample of at most
``TRAIN_ROWS``.  ``weak_labels`` gives such labels where no reviewed findings
exist: findings in the exact form of a key are secrets, numbers, dates, words
and identifiers are harmless, and the forest learns nothing from all others,
as they may be keys of another form.

Defined cases: null and empty texts have no candidates; a null path has no
path words; without labels of both kinds nothing is called a secret (score
0); rows that repeat an id stay rows; other columns are ignored.  A candidate
is reported by place and hash, not by its text.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from cadenza.llm.common import held_out, settled, text_bytes, whole_texts

MIN_LENGTH = 12
TRAIN_ROWS = 6000
TREES = 40
DEPTH = 8

_KEY_NAME = "password|passwd|pwd|secret|token|api_?key|apikey|auth|bearer|credential|private"
_CANDIDATE = re.compile(
    r"(?:(?P<name>\b\w*(?:" + _KEY_NAME + r")\w*)[\"']?\s{0,2}[=:]\s{0,2}[\"']?)?"
    r"(?P<run>[A-Za-z0-9+/_\-]{" + str(MIN_LENGTH) + r",}={0,2})", re.IGNORECASE)
_PATH_WORDS = re.compile(r"test|example|sample|fixture|mock|doc", re.IGNORECASE)
_NAMES = re.compile(_KEY_NAME, re.IGNORECASE)
_KEY = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abp]-[0-9A-Za-z\-]{10,}")
_HEX = re.compile(r"(?=.*[A-Fa-f])([0-9a-f]{16,64}|[0-9A-F]{16,64})")
_NUMBER = re.compile(r"\d+(T\d+)?Z?")
_WORD = re.compile(r"(?!\w*[^aeiouyAEIOUY\W\d_]{6})([a-z]+|[A-Z]+|([A-Z]?[a-z]{2,})+)\d{0,4}")
_MARKS = re.compile(r"[+/_\-=]+")

FEATURES = ["length", "digits", "uppers", "lowers", "marks", "transitions", "vowel_share", "entropy",
            "hex_share", "distinct_share", "pair_cover", "named", "quoted", "alone", "name_near",
            "number_near", "path_hint"]


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.isupper() else 2 if c.islower() else 3


def _features(text: str, m: re.Match, pairs: Counter, all_pairs: int, path: str) -> list[float]:
    run = m["run"]
    n, kinds = len(run), [_kind(c) for c in run]
    counts, low = Counter(run), run.lower()
    before, behind = text[max(0, m.start() - 40):m.start()], text[m.end():m.end() + 20]
    # how common the letter pairs of the candidate are in this text
    cover = sum(1 for a, b in zip(low, low[1:]) if pairs[a + b] * 600 > all_pairs) / max(1, n - 1)
    return [float(n), *(kinds.count(k) / n for k in range(4)),
            sum(a != b for a, b in zip(kinds, kinds[1:])) / max(1, n - 1),
            sum(c in "aeiou" for c in low) / n,
            -sum(k / n * math.log2(k / n) for k in counts.values()),
            sum(c in "0123456789abcdef" for c in low) / n, len(counts) / n, cover,
            float(m["name"] is not None), float(behind[:1] in ("\"", "'") and behind[:1] != ""),
            float((not before or before[-1].isspace()) and (not behind or behind[0].isspace())),
            float(_NAMES.search(before) is not None),
            float(any(c.isdigit() for c in before[-10:] + behind[:10])),
            float(_PATH_WORDS.search(path) is not None)]


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows: list[tuple] = []
        at: list[int] = []
        for i, (body, path) in enumerate(zip(b.column("body").to_pylist(), b.column("path").to_pylist())):
            text = body.decode("utf-8", "replace")
            pairs = None
            for m in _CANDIDATE.finditer(text):
                run = m["run"]
                if m["name"] is None and not any(c.isdigit() for c in run):
                    continue
                if pairs is None:
                    low = text.lower()
                    pairs = Counter(map(str.__add__, low, low[1:]))
                at.append(i)
                rows.append((m.start("run"), len(run), hashlib.sha256(run.encode()).hexdigest(),
                             _features(text, m, pairs, len(text), path), _strict(m)))
        cols = list(zip(*rows)) if rows else [()] * 5
        take = pa.array(at, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(take), b.column("held_out").take(take), pa.array(cols[0], pa.int64()),
             pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
             pa.array(cols[3], pa.list_(pa.float64())), pa.array(cols[4], pa.int32())],
            ["doc_id", "held_out", "start", "length", "finding_sha256", "features", "strict"])


def _strict(m: re.Match) -> int | None:
    """1 if the candidate has the exact form of a key, 0 if it is harmless (a
    number, a date, words, an identifier), else None: not known."""
    run, named = m["run"], m["name"] is not None
    if _KEY.fullmatch(run) or named and _HEX.fullmatch(run):
        return 1
    if _HEX.fullmatch(run):
        return None
    pieces = [p for p in _MARKS.split(run) if p]
    words = [p for p in pieces if not _NUMBER.fullmatch(p)]
    if not all(_WORD.fullmatch(p) for p in words):
        return None
    # a value that bears a key's name may be a password, if it is no variable
    if named and (len(words) < 2 or "_" not in run or m.string[m.start("run") - 1] in "\"'"):
        return None
    return 0


def candidates(files: DataFrame) -> DataFrame:
    """doc_id, held_out, start, length, finding_sha256, features, strict."""
    path = F.col("path") if "path" in files.columns else F.lit(None).cast("string")
    rows = whole_texts(files).select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                        text_bytes().alias("body"), F.coalesce(path, F.lit("")).alias("path"))
    return rows.mapInArrow(_found, "doc_id long, held_out boolean, start long, length long, "
                                   "finding_sha256 string, features array<double>, strict int")


def weak_labels(found: DataFrame) -> DataFrame:
    """features and label of findings that are not held out, by their form;
    those of an unknown form are left out."""
    return found.where(~F.col("held_out") & F.col("strict").isNotNull()).select("finding_sha256", "features", F.col("strict").alias("label"))


def _wide(rows: DataFrame) -> DataFrame:
    return rows.select("*", *[F.col("features")[k].alias(f"cz_{name}") for k, name in enumerate(FEATURES)])


def train(labelled: DataFrame, rows: int = TRAIN_ROWS) -> PipelineModel | None:
    """The forest of at most ``rows`` labelled findings, half of each kind."""
    some = []
    for label in (0, 1):
        own = labelled.where(F.col("label") == label).dropDuplicates(["finding_sha256"])
        some.append(own.orderBy("finding_sha256").limit(rows // 2))
    sample = settled(some[0].unionByName(some[1]))
    kinds = {r["label"] for r in sample.select("label").distinct().collect()}
    if len(kinds) < 2:
        return None
    assembler = VectorAssembler(inputCols=[f"cz_{n}" for n in FEATURES], outputCol="cz_vector")
    forest = RandomForestClassifier(featuresCol="cz_vector", labelCol="cz_label", numTrees=TREES,
                                    maxDepth=DEPTH, seed=5)
    ready = assembler.transform(_wide(sample).withColumn("cz_label", F.col("label").cast("double")))
    return PipelineModel([assembler, forest.fit(ready)])


def judge(found: DataFrame, model: PipelineModel | None) -> DataFrame:
    """doc_id, start, length, finding_sha256, score, is_secret of every candidate."""
    keep = ["doc_id", "held_out", "start", "length", "finding_sha256", "strict"]
    if model is None:
        scored = found.withColumn("score", F.lit(0.0))
    else:
        scored = model.transform(_wide(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.select(*keep, F.round("score", 6).alias("score"),
                         (F.col("score") >= 0.5).alias("is_secret"))


def secret_scan(files: DataFrame) -> DataFrame:
    """Find candidates, train on those with weak labels, judge all."""
    found = settled(candidates(files))
    return judge(found, train(weak_labels(found)))
