"""Licence scan: TF-IDF cosine to templates, then inheritance by directory.

Headers are lines of any file; of licence files (by name) the whole text, its
paragraphs (parted by blank lines) and its lines count, and the best is kept.
All become sparse TF-IDF vectors and are compared with every template.  Those that
cannot reach the threshold are left out without loss: for each template there
is a set of terms, common words last, such that the others together have a
norm below ``threshold`` times the template's, so by the Cauchy-Schwarz
inequality a vector without any of those terms stays below it.  A second bound
with the text's own norm (``_heavy``) leaves out texts whose other words weigh
too much, before any word becomes a row.  What remains is scored once for each
distinct text.

A file without a licence of its own takes that of the licence file in the
nearest directory above it: directories, not files, are joined with their
ancestors, and the deepest that has a licence file wins.

Only DataFrame operations are used.  Defined cases: null or empty texts have
no licence of their own; a null path is the empty path, in the top directory;
of equal cosines the first licence by name wins; rows that repeat a file stay
rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, functions as F

from cadenza.llm.common import settled
from cadenza.llm.spotsigs import COMMON_WORDS

THRESHOLD = 0.6

# Licence statements to compare with.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
                   "except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Proprietary", "All rights reserved."),
]

# Common words, and last the commonest: they should not make a line a candidate.
_COMMON = {w: 1 for w in COMMON_WORDS["en"].split()} | {
    w: 2 + k for k, w in enumerate("on with be was are as by from this or is for it that in a to and of the".split())}
LICENSE_FILE = r"(?i)(^|/)(licen[sc]e|copying|notice)[^/]*$"
PARAGRAPH = r"\n\s*\n"


def _terms(text: str) -> Counter:
    return Counter(re.findall(r"[a-z0-9]+", text.lower()))


class Templates:
    """Vectors of the templates, and the terms that a match must contain."""

    def __init__(self, templates=TEMPLATES, threshold: float = THRESHOLD):
        vectors = [_terms(t) for _, t in templates]
        n, df = len(vectors), Counter(w for v in vectors for w in v)
        self.threshold = threshold
        self.idf = {w: math.log((1 + n) / (1 + k)) + 1 for w, k in sorted(df.items())}
        self.unknown = math.log(1 + n) + 1
        self.rows, self.needed = [], set()
        for k, ((name, _), v) in enumerate(zip(templates, vectors)):
            weight = {w: c * self.idf[w] for w, c in v.items()}
            norm = math.sqrt(sum(x * x for x in weight.values()))
            self.rows += [(k, name, w, x / norm) for w, x in sorted(weight.items())]
            rest = norm * norm
            for w, x in sorted(weight.items(), key=lambda t: (_COMMON.get(t[0], 0), -t[1], t[0])):
                if rest < (threshold * norm) ** 2 * 0.999:
                    break
                self.needed.add(w)
                rest -= x * x


def _words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9]+)"), F.lit(1))


def _heavy(texts: Column, marker: str, templates: Templates) -> Column:
    """The texts that may reach the threshold with some template, by two exact
    bounds.

    The squared shares of the terms that a text has in common with a template
    must reach the threshold's square, by the same inequality.  And with K the
    squared weights of those terms in the text and U those of its words that
    no template has (at least their number, as counts are whole), the cosine
    is at most sqrt(K / (K + U)): long texts fall here, whose few common words
    drown in their own.
    """
    by: dict[int, list] = {}
    for k, _, w, share in templates.rows:
        by.setdefault(k, []).append(F.struct(F.lit(w).alias("word"), F.lit(share * share).alias("mass"),
                                             F.lit(templates.idf[w]).alias("idf")))
    known = F.array(*[F.array(*terms) for terms in by.values()])
    vocabulary = F.array(*[F.lit(w) for w in templates.idf])
    square = (templates.threshold - 1e-6) ** 2   # the cosine is rounded to six places

    def total(terms: Column, present: Column, value) -> Column:
        shared = F.filter(terms, lambda t: F.array_contains(present, t["word"]))
        return F.aggregate(shared, F.lit(0.0), lambda acc, t: acc + value(t))

    def weight(s: Column, t: Column) -> Column:
        return F.size(F.filter(s["own"], lambda w: w == t["word"])) * t["idf"]

    split = F.transform(F.filter(texts, lambda x: x.rlike(marker)),
                        lambda x: F.struct(x.alias("text"), _words(x).alias("words")))
    split = F.transform(split, lambda s: F.struct(
        s["text"].alias("text"), s["words"].alias("words"), F.array_intersect(s["words"], vocabulary).alias("present")))
    heavy = F.filter(split, lambda s: F.exists(
        known, lambda terms: total(terms, s["present"], lambda t: t["mass"]) >= square * 0.999))
    counted = F.transform(heavy, lambda s: F.struct(
        s["text"].alias("text"), F.size(s["words"]).alias("n"), s["present"].alias("present"),
        F.filter(s["words"], lambda w: F.array_contains(s["present"], w)).alias("own")))
    reach = F.filter(counted, lambda s: F.exists(known, lambda terms: total(
        terms, s["present"], lambda t: weight(s, t) * weight(s, t)) * (1 - square)
        >= square * (1 - 1e-9) * (s["n"] - F.size(s["own"])) * templates.unknown ** 2))
    return F.transform(reach, lambda s: s["text"])


def match_texts(texts: DataFrame, templates: Templates) -> DataFrame:
    """unit, license, cosine of every distinct text ``unit`` that is close
    enough to a template."""
    spark = texts.sparkSession
    idf = spark.createDataFrame(sorted(templates.idf.items()), "word string, idf double")
    rows = spark.createDataFrame(templates.rows, "template int, license string, word string, share double")
    # counted once for the three reads below; a unit of a few words is a row a word
    weight = settled(texts.select("unit").distinct()
                     .select("unit", F.explode(_words(F.col("unit"))).alias("word"))
                     .groupBy("unit", "word").agg(F.count("*").alias("tf"))
                     .join(F.broadcast(idf), "word", "left")
                     .withColumn("w", F.col("tf") * F.coalesce("idf", F.lit(templates.unknown))))
    norm = weight.groupBy("unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dot = (weight.join(F.broadcast(rows), "word").groupBy("unit", "template", "license")
           .agg(F.sum(F.col("w") * F.col("share")).alias("dot")))
    # rounded, so that ties do not hang on the order of a sum
    scored = (dot.join(norm, "unit").withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6))
              .where(F.col("cosine") >= templates.threshold))
    ranked = scored.groupBy("unit", "license").agg(F.max("cosine").alias("cosine"))
    best = ranked.groupBy("unit").agg(F.max("cosine").alias("cosine"))
    return (ranked.join(best, ["unit", "cosine"]).groupBy("unit", "cosine")
            .agg(F.min("license").alias("license")).select("unit", "license", "cosine"))


def directory_of(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def _ancestors(directory: Column) -> Column:
    """The directory, those above it, and the top (empty)."""
    parts = F.split(directory, "/")
    ups = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))
    return F.array_distinct(F.concat(F.array(F.lit("")), ups))


def license_scan(files: DataFrame, templates: Templates | None = None) -> DataFrame:
    """The files' ``keys`` (all columns but path and text), path, license,
    cosine, origin (header, file or inherited) and from_dir."""
    templates = templates or Templates()
    keys = [c for c in files.columns if c not in ("path", "text")]
    rows = files.select(F.struct(*keys).alias("keys") if keys else F.lit(None).alias("keys"),
                        F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    marker = r"(?i)(?<![a-z0-9])(" + "|".join(sorted(templates.needed)) + r")(?![a-z0-9])"
    named = F.col("path").rlike(LICENSE_FILE)
    lines = F.split("text", "\n")
    parts = F.when(named, F.array_distinct(F.concat(F.array("text"), F.split("text", PARAGRAPH), lines))).otherwise(lines)
    rows = rows.select(
        "keys", "path", F.xxhash64("text").alias("body"), named.alias("is_file"),
        F.when(~F.col("text").rlike(marker), F.array().cast("array<string>"))
        .otherwise(_heavy(parts, marker, templates)).alias("units"))
    # texts are behind us: the candidates and a hash remain
    rows = settled(rows)
    units = rows.select("path", "body", F.explode("units").alias("unit")).distinct()
    found = match_texts(units, templates)
    own = (units.join(found, "unit").groupBy("path", "body")
           .agg(F.min(F.struct((-F.col("cosine")).alias("less"), "license")).alias("own"))
           .select("path", "body", F.struct("own.license", (-F.col("own.less")).alias("cosine")).alias("own")))
    files_own = settled(rows.select("keys", "path", "body", "is_file").join(own, ["path", "body"], "left"))

    licensed = (files_own.where(F.col("is_file") & F.col("own").isNotNull())
                .groupBy(directory_of(F.col("path")).alias("above"))
                .agg(F.min(F.struct((-F.col("own.cosine")).alias("less"), F.col("own.license").alias("license")))
                     .alias("given")))
    wanting = (files_own.where(F.col("own").isNull()).select(directory_of(F.col("path")).alias("dir")).distinct())
    inherited = (wanting.select("dir", F.explode(_ancestors(F.col("dir"))).alias("above"))
                 .join(licensed, "above").groupBy("dir")
                 .agg(F.max_by(F.struct("above", "given"), F.length("above")).alias("from")))
    out = (files_own.withColumn("dir", directory_of(F.col("path"))).join(inherited, "dir", "left"))
    plain = F.col("own").isNotNull()
    return out.select(
        *([F.col(f"keys.`{c}`").alias(c) for c in keys]), "path",
        F.when(plain, F.col("own.license")).otherwise(F.col("from.given.license")).alias("license"),
        F.when(plain, F.col("own.cosine")).otherwise(-F.col("from.given.less")).alias("cosine"),
        F.when(plain, F.when(F.col("is_file"), "file").otherwise("header"))
        .when(F.col("from").isNotNull(), "inherited").alias("origin"),
        F.when(~plain, F.col("from.above")).alias("from_dir"))


def documents_as_files(docs: DataFrame) -> DataFrame:
    """doc_id, path, text: documents lie in a directory for source and
    language; one of at most two lines, the last naming a licence, stands for
    the licence file of a directory below that."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.split(text, "\n")
    short = (F.size(lines) <= 2) & F.element_at(lines, -1).rlike("(?i)licen[sc]")
    base = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("und")),
                       F.pmod("doc_id", F.lit(97)).cast("string"))
    return docs.select("doc_id", F.concat(base, F.lit("/"), F.when(short, F.lit("LICENSE")).otherwise(
        F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(".txt")))).alias("path"),
        text.alias("text"))
