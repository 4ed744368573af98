"""Exact deduplication by progressive refinement.

Rows are grouped by text length and a hash of a short prefix, both taken in
one pass; only the rows whose (length, prefix) repeats are read in full and
hashed with SHA-256. Texts are the same when length and SHA-256 are the same;
a null text counts as the empty text.

The refinement hands on the repeated (length, prefix) pairs: as a mask of 16
bits a pair where they are at most ``MASK_PAIRS`` (8 MB to broadcast), else as
a table that meets the rows by a shuffled join. A bit that is set by another
pair only costs a hash; the exact grouping at the end decides. Everything is
built-in column functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import text_or_empty, written

#: Bytes of the prefix that the refinement hashes.
PREFIX_BYTES = 512
#: Most repeated pairs that are handed on as a mask.
MASK_PAIRS = 1 << 22
BITS_A_PAIR = 16


def _measures(text: str) -> tuple[Column, Column]:
    body = text_or_empty(text)
    return F.octet_length(body), F.xxhash64(F.substring(body.cast("binary"), 1, PREFIX_BYTES))


def _marked(rows: DataFrame, pairs: DataFrame, bits: int) -> DataFrame:
    """``rows`` (with _len, _prefix) and ``_again``: the pair may repeat."""
    slot = F.pmod(F.xxhash64("_len", "_prefix"), F.lit(bits))
    mask = (pairs.select(slot.alias("_slot")).groupBy((F.col("_slot") / 64).cast("long").alias("_word"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(_slot % 64 as int)))").alias("_bits")))
    out = rows.withColumn("_slot", slot).withColumn("_word", (F.col("_slot") / 64).cast("long"))
    out = out.join(F.broadcast(mask), "_word", "left")
    hit = F.expr("shiftright(_bits, cast(_slot % 64 as int)) & 1L") == 1
    return out.withColumn("_again", F.coalesce(hit, F.lit(False))).drop("_slot", "_word", "_bits")


def refine(docs: DataFrame, text: str = "text", mask_pairs: int = MASK_PAIRS) -> DataFrame:
    """``docs`` with ``_len`` (bytes) and ``_sha``: the SHA-256 of the text for
    rows whose length and prefix repeat, else null (no other row has this text)."""
    size, prefix = _measures(text)
    pairs = written(docs.select(size.alias("_len"), prefix.alias("_prefix")).groupBy("_len", "_prefix")
                    .agg(F.count("*").alias("_n")).where("_n > 1").select("_len", "_prefix"), "pairs")
    rows, n = docs.withColumn("_len", size).withColumn("_prefix", prefix), pairs.count()
    if n <= mask_pairs:
        rows = _marked(rows, pairs, 1 << max(10, (n * BITS_A_PAIR).bit_length()))
    else:
        rows = rows.join(pairs.withColumn("_again", F.lit(True)), ["_len", "_prefix"], "left")
    full = F.when(F.col("_again"), F.sha2(text_or_empty(text).cast("binary"), 256))
    return rows.withColumn("_sha", full).drop("_prefix", "_again")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """One narrow row per input row: the id, ``keep_id`` (largest id among the
    rows with the same text; the row's own id where it is alone),
    ``group_size`` and ``kept``. Only rows that the refinement leaves are
    hashed and grouped. ``digest=True`` adds ``text_sha256`` of every row: the
    hash of the refinement where it took one; the other rows are hashed for
    this column alone, as they are written, and are not grouped by it.

    Null ids: a group of nulls only keeps a null id. Rows that repeat id and
    text are one document given twice: both carry the same verdict. An empty
    table gives an empty result.
    """
    rows = refine(docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text")), "_text")
    if digest:
        own = F.when(F.col("_sha").isNull(), F.sha2(text_or_empty("_text").cast("binary"), 256))
        rows = rows.withColumn("_rest", own)
    rows, key = rows.drop("_text"), ["_len", "_sha"]
    # written: the texts are read once more only, and both sides of the join
    # are plain shuffles, which AQE splits where one text has very many copies
    rows = written(rows, "measures")
    groups = (rows.where("_sha is not null").groupBy(*key)
              .agg(F.max("_id").alias("_keep"), F.count("*").alias("_n")).where("_n > 1"))
    out = rows.join(written(groups, "copies"), key, "left")
    alone = F.col("_n").isNull()
    return out.select(
        F.col("_id").alias(id_col),
        F.when(alone, F.col("_id")).otherwise(F.col("_keep")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("_id").eqNullSafe(F.col("_keep"))).alias("kept"),
        *([F.coalesce("_sha", "_rest").alias("text_sha256")] if digest else []))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns of ``docs``: of equal texts the one
    with the largest id, exactly one also where id and text repeat.

    Only rows that may have a copy are shuffled with their text; all others
    stream from the scan to the output. Clashing column names are no matter:
    the row travels as one struct.
    """
    packed = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"),
                         F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = refine(packed, "_text").drop("_text")
    alone = rows.where("_sha is null").select("_row.*")
    best = (rows.where("_sha is not null").groupBy("_len", "_sha")
            .agg(F.max_by("_row", F.struct(F.col("_id").isNotNull(), "_id")).alias("_row")).select("_row.*"))
    return alone.unionByName(best)
