"""The licence scan's bounds lose nothing: lines against the plain formula."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from cadenza.llm import licenses


def cosines(text, t):
    """Best (cosine, licence) by the formula, from the words alone."""
    tf = Counter(re.findall("[a-z0-9]+", text.lower()))
    own = {w: n * t.idf.get(w, t.unknown) for w, n in tf.items()}
    norm = math.sqrt(sum(x * x for x in own.values()))
    best = {}
    for k, name, w, share in t.rows:
        best[k, name] = best.get((k, name), 0.0) + own.get(w, 0.0) * share
    return min(((-round(dot / norm, 6), name) for (_, name), dot in best.items()), default=(0, "")) if norm else (0, "")


def lines(t):
    rng = random.Random(4)
    vectors = {}
    for k, _, w, _ in t.rows:
        vectors.setdefault(k, []).append(w)
    out = ["", "the of and", "license " * 50, "MIT License", "the " * 3000 + "MIT License"]
    for _ in range(900):
        words = [w for w in rng.choice(list(vectors.values())) if rng.random() < rng.choice([0.5, 0.8, 1.0])]
        words += rng.choices(list(t.idf), k=rng.randrange(0, 6))
        words += [f"own{rng.randrange(50)}" for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 13, 200]))]
        words += rng.choices(words or ["x"], k=rng.choice([0, 0, 1, 4]))      # words that repeat
        rng.shuffle(words)
        out.append(rng.choice([" ", ", ", "-"]).join(w.upper() if rng.random() < 0.1 else w for w in words))
    return out


def test_headers_equal_the_formula(spark):
    t = licenses.Templates()
    texts = lines(t)
    df = spark.createDataFrame([(k, f"d{k}/x.py", x) for k, x in enumerate(texts)], "doc_id long, path string, text string")
    got = {r.doc_id: (r.cosine, r.license) for r in licenses.license_scan(df).collect()}
    near = 0
    for k, x in enumerate(texts):
        less, name = cosines(x, t)
        near += 0.55 < -less < 0.65
        assert got[k] == ((-less, name) if -less >= t.threshold else (None, None)), x
    assert near > 60   # the fixture tries the threshold


def test_few_lines_without_a_match_are_left(spark):
    """Long lines with the commonest words of the templates become no rows."""
    t = licenses.Templates()
    marker = r"(?i)(?<![a-z0-9])(" + "|".join(sorted(t.needed)) + r")(?![a-z0-9])"
    rng = random.Random(5)
    texts = [" ".join(rng.choices(sorted(t.idf) + [f"own{k}" for k in range(3000)], k=400)) for _ in range(200)]
    df = spark.createDataFrame([([x],) for x in texts], "units array<string>")
    left = df.select(F.size(licenses._heavy(F.col("units"), marker, t)).alias("n")).agg(F.sum("n")).first()[0]
    assert left == 0 and max(-cosines(x, t)[0] for x in texts) < t.threshold
