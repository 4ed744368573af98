"""Fill-in-middle transformation by a counted-quantifier regex.

A text is a row of units (a run of white space with the word after it, or
white space at the end). ``regexp_count`` gives their number n; two hashed cut
points a <= b choose how many units the prefix and the middle take; and one
pattern per row, with possessive groups ``(unit{a}+)(unit{b-a}+)(rest)``,
cuts the text in a single match and lays the pieces out in the same call.
Possessive quantifiers never give a unit back, so a text of any length is
matched in one pass and without recursion. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import text_or_empty

#: One unit; white space as ASCII space and U+0009 to U+000D.
UNIT = r"[\x20\x09-\x0D]*+[^\x20\x09-\x0D]++|[\x20\x09-\x0D]++"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def _draw(digest: Column, k: int) -> Column:
    """The k-th group of 8 hex digits as an unsigned integer."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text: str = "text", rate: int = 50,
                   spm_rate: int = 80, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: the id, ``text`` (null as empty), ``n``
    units, ``form`` (``plain``, ``psm`` or ``spm``) and ``output``.

    ``rate`` per cent of the texts are cut, ``spm_rate`` per cent of those into
    suffix-prefix-middle order. Every draw comes from the SHA-256 of
    ``<seed>:<id>``, so reruns agree and rows that repeat an id get one verdict
    for each text; a null id draws as the empty string. Empty texts and texts
    that contain a sentinel stay plain, which keeps :func:`restored` exact.
    An empty table gives an empty result; other columns are not read.
    """
    marked = F.lit(False)
    for s in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains("text", F.lit(s))
    rows = docs.select(
        F.col(id_col).alias(id_col), text_or_empty(text).alias("text"),
        F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"),
               256).alias("_digest"))
    rows = rows.withColumn("n", F.regexp_count("text", F.lit(UNIT)).cast("long"))
    first, second = [F.pmod(_draw(F.col("_digest"), k), F.col("n") + 1) for k in (0, 1)]
    form = (F.when((F.col("text") == "") | marked | (_draw(F.col("_digest"), 2) % 100 >= rate), "plain")
            .when(_draw(F.col("_digest"), 3) % 100 < spm_rate, "spm").otherwise("psm"))
    rows = rows.select("*", F.least(first, second).alias("_a"), F.greatest(first, second).alias("_b"),
                       form.alias("form"))
    pattern = F.format_string(rf"(?s)\A((?:{UNIT}){{%d}}+)((?:{UNIT}){{%d}}+)(.*+)\z",
                              F.col("_a"), F.col("_b") - F.col("_a"))
    layout = (F.when(F.col("form") == "psm", f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
              .otherwise(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"))
    output = F.when(F.col("form") == "plain", F.col("text")).otherwise(
        F.regexp_replace(F.col("text"), pattern, layout))
    return rows.select(id_col, "text", "n", "form", output.alias("output"))


def pieces(output: Column, form: Column) -> Column:
    """``struct(prefix, middle, suffix)`` read back from an output and its
    form; null for plain rows."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    psm = form == "psm"
    return F.when(form != "plain", F.struct(
        F.when(psm, parts[1]).otherwise(parts[2]).alias("prefix"), parts[3].alias("middle"),
        F.when(psm, parts[2]).otherwise(parts[1]).alias("suffix")))


def restored(output: Column, form: Column) -> Column:
    """The exact text, rebuilt from an output and its form alone."""
    cut = pieces(output, form)
    return F.when(form == "plain", output).otherwise(F.concat(cut["prefix"], cut["middle"], cut["suffix"]))
