"""Fill-in-the-middle rewriting by one counted regular expression a text.

A text is a run of units (words with the blanks before them, or blanks that
end the text).  ``regexp_count`` tells their number n; two hashes of the
document's id pick two cuts among the n + 1 places between units, a <= b; then
*one* match of a pattern made for the row,

    \\A((?:unit){a}+)((?:unit){b - a}+)(.*+)\\z

takes prefix, middle and suffix apart, and its replacement puts them in the
order of the form: ``psm`` is prefix, suffix, middle; ``spm`` suffix, prefix,
middle, each after its sentinel.  The counted groups are possessive: each unit
is taken once, without a stack and without going back, so the match is linear
and long texts do not exhaust it.

A text stays as it is (``plain``) if it is empty, if it holds a sentinel or if
the hash says so.  As no other text holds a sentinel, and a sentinel neither
ends like it begins nor overlaps itself, the output falls apart at its three
sentinels in one way only: ``restored`` gives the exact text back.

Row by row, in the JVM: no shuffle, no Python workers.  Defined cases: a null
text is empty; a null id hashes as the empty string; rows that repeat an id
or a text are rewritten alike; other columns, whatever their names, stay as
they are unless they have the name of a column made here.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

# What is a unit, and the three sentinels.
UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
FIM_RATE = 50    # of 100 texts, so many are rewritten
SPM_RATE = 80    # of 100 rewritten texts, so many get the form spm

_SENTINEL = "|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE)))


def _hashes(doc_id: str, seed: int) -> Column:
    """The four first 32-bit numbers of the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)])


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = SEED,
                   fim_rate: int = FIM_RATE, spm_rate: int = SPM_RATE, unit: str = UNIT) -> DataFrame:
    """The rows with ``n`` (units), ``form`` (plain, psm or spm) and ``output``."""
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("fim_row"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("fim_text"),
        _hashes(doc_id, seed).alias("fim_h"))
    rows = rows.select("*", F.regexp_count("fim_text", F.lit(unit)).cast("long").alias("fim_n"))
    place = [F.get("fim_h", F.lit(k)) % (F.col("fim_n") + 1) for k in (0, 1)]
    rows = rows.select(
        "*", F.least(*place).alias("fim_a"), F.greatest(*place).alias("fim_b"),
        F.when((F.col("fim_text") == "") | (F.get("fim_h", F.lit(2)) % 100 >= fim_rate)
               | F.col("fim_text").rlike(_SENTINEL), "plain")
        .when(F.get("fim_h", F.lit(3)) % 100 < spm_rate, "spm").otherwise("psm").alias("fim_form"))
    pattern = F.format_string(
        r"(?s)\A((?:" + unit.replace("%", "%%") + r"){%d}+)((?:" + unit.replace("%", "%%") + r"){%d}+)(.*+)\z",
        F.col("fim_a"), F.col("fim_b") - F.col("fim_a"))
    order = (F.when(F.col("fim_form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
             .otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"))
    output = F.when(F.col("fim_form") == "plain", F.col("fim_text")).otherwise(
        F.regexp_replace(F.col("fim_text"), pattern, order))
    made = {"n": F.col("fim_n"), "form": F.col("fim_form"), "output": output}
    return rows.select(*[F.col(f"fim_row.`{c}`").alias(c) for c in docs.columns if c not in made],
                       *[v.alias(k) for k, v in made.items()])


def with_parts(made: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """The rows and ``parts``: prefix, middle and suffix of an output, from it
    and its form alone; null for plain outputs."""
    cut = made.select("*", F.when(F.col(form) != "plain", F.split(F.col(output), _SENTINEL, -1)).alias("fim_cut"))
    first, second, third = [F.get("fim_cut", F.lit(k)) for k in (1, 2, 3)]
    psm = F.col(form) == "psm"
    parts = F.when(F.col(form) != "plain", F.struct(
        F.when(psm, first).otherwise(second).alias("prefix"), third.alias("middle"),
        F.when(psm, second).otherwise(first).alias("suffix")))
    return cut.select("*", parts.alias("parts")).drop("fim_cut")


def restored(output: str = "output", parts: str = "parts") -> Column:
    """The text that an output was made of."""
    own = F.col(parts)
    return F.when(own.isNull(), F.col(output)).otherwise(F.concat(own["prefix"], own["middle"], own["suffix"]))


def digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256,
    restored_sha256 of every row."""
    made = with_parts(fill_in_middle(docs.select("doc_id", "text"), **options))
    return made.select(
        "doc_id", "n", "form", F.char_length("parts.prefix").cast("long").alias("prefix_chars"),
        F.char_length("parts.middle").cast("long").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored().cast("binary"), 256).alias("restored_sha256"))
