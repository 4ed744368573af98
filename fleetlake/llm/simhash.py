"""SimHash near-duplicates: pigeonhole blocks, then Hamming distance.

A fingerprint has 64 bits; bit i is set when it is set in more than half of
the XXH64 hashes of the text's word shingles. Two fingerprints with at most
``d`` differing bits agree in at least ``blocks - d`` of ``blocks`` blocks, so
every combination of ``blocks - d`` blocks is a join key and each close pair
meets under one of them; the join verifies the distance.

Equal fingerprints are collapsed first. A key that still holds more than
``BLOCK_LIMIT`` fingerprints would make too many pairs; its fingerprints are
linked through shared neighbours instead, which is exact as well: within a key
the pairs differ only in the key's free bits, and two of them differ in at
most two bits exactly when some value is at most one bit from both. Every
fingerprint lists these values (itself, and itself with one free bit
flipped), and all that list a value link to the lowest that does: a count that
is linear in the fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .runtime import ship, written

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Blocks that a fingerprint is split into: with 2 bits, 10 keys of 38 or 39 bits.
BLOCKS = 5
#: Fingerprints of one key that are compared pair by pair.
BLOCK_LIMIT = 64

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Hashes that are unpacked to bits at once.
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The SimHash of a text as an unsigned integer; null or no words: 0.

    A-Z are lower-cased, words are runs of non-white-space, shingles count
    as often as they occur; fewer words than a shingle make one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts, stops, strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, _CHUNK):
        part = hashes[k:k + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "_fp",
                     shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """``docs`` with the fingerprint as a signed long in ``name``. Texts stay
    in their task; an Arrow batch is bounded in bytes by Spark."""
    ship(docs.sparkSession)
    at = docs.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(x.as_py(), shingle_words, seed) for x in b.column(at)),
                              np.uint64, b.num_rows).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps)], names=[*b.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])
    return docs.mapInArrow(add, schema)


def _keys(blocks: int, keep: int) -> list[int]:
    """Masks of the bits of every combination of ``keep`` blocks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    bits = [((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in range(blocks)]
    return [sum(c) for c in combinations(bits, keep)]


def _signed(v: int) -> int:
    return v - (1 << 64) if v >> 63 else v


def close_links(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
                limit: int = BLOCK_LIMIT) -> DataFrame:
    """Links ``(a, b)`` among distinct signed fingerprints (column ``fp``) that
    connect whatever is at most ``max_bits`` apart. ``max_bits`` up to 2."""
    if not 0 <= max_bits <= 2 or blocks <= max_bits:
        raise ValueError("max_bits is 0, 1 or 2 and less than blocks")
    if max_bits == 0:  # distinct fingerprints have no such link
        return prints.where("false").select(F.col("fp").alias("a"), F.col("fp").alias("b"))
    masks = _keys(blocks, blocks - max_bits)
    table = F.array(*[F.lit(_signed(m)) for m in masks])
    keyed = prints.select("fp", F.posexplode(table).alias("kind", "mask"))
    keyed = keyed.select("fp", "kind", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    keyed = written(keyed, "blocks")
    size = keyed.groupBy("kind", "key").agg(F.count("*").alias("n")).where("n > 1")
    small = keyed.join(size.where(F.col("n") <= limit), ["kind", "key"])
    pairs = (small.select("kind", "key", F.col("fp").alias("a"))
             .join(small.select("kind", "key", F.col("fp").alias("b")), ["kind", "key"])
             .where(F.expr(f"a < b AND bit_count(a ^ b) <= {int(max_bits)}")).select("a", "b"))
    # crowded keys: one row per free bit, so linear in the fingerprints
    crowded = keyed.join(size.where(F.col("n") > limit), ["kind", "key"])
    flips = F.concat(F.array(F.lit(0).cast("long")), F.expr(
        "filter(transform(sequence(0, 63), i -> shiftleft(1L, i)), b -> (b & mask) = 0)"))
    near = crowded.select("fp", "kind", F.explode(flips).alias("bit"))
    if max_bits == 2:
        near = near.select("fp", F.lit(0).cast("long").alias("bit"), "kind", F.expr("fp ^ bit").alias("value"))
    else:  # one bit apart: the pair agrees with that bit cleared
        near = near.where("bit <> 0").select("fp", "bit", "kind", F.expr("fp & ~bit").alias("value"))
    by = ["kind", "value", "bit"]
    low = near.groupBy(*by).agg(F.min("fp").alias("a"), F.max("fp").alias("top")).where("a < top").drop("top")
    stars = near.join(low, by).where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.unionAll(stars).distinct()


def simhash_groups(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fp, group)`` for every distinct fingerprint of column ``fp``: the
    lowest fingerprint that is reachable by links."""
    distinct = written(prints.select("fp").distinct(), "prints")
    comp = connected_components(close_links(distinct, max_bits))
    return (distinct.join(comp, distinct.fp == comp.node, "left")
            .select("fp", F.coalesce("component", "fp").alias("group")))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                       shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and
    ``component_id`` (smallest id reachable; null only where every id of the
    component is null). Null and empty texts have fingerprint zero and link
    like any other. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).alias("_text"))
    rows = written(with_fingerprint(rows, "_text", "fp", shingle_words).select("_id", "fp"), "fingerprints")
    groups = written(simhash_groups(rows, max_bits), "groups")
    lowest = (rows.groupBy("fp").agg(F.min("_id").alias("low")).join(groups, "fp")
              .groupBy("group").agg(F.min("low").alias("component_id")))
    named = groups.join(lowest, "group").select("fp", "component_id")
    return (rows.join(named, "fp")
            .select(F.col("_id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    "component_id"))


def simhash_dedup(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                  shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the one with the
    smallest id (nulls last; exactly one row also where ids repeat)."""
    # positional names cannot clash; the row id is fixed by the write, so the
    # last join cannot meet other ids
    names = docs.columns
    plain = docs.toDF(*[f"_c{i}" for i in range(len(names))])
    text_at, id_at = f"_c{names.index(text)}", f"_c{names.index(id_col)}"
    rows = written(with_fingerprint(plain, text_at, "fp", shingle_words)
                   .withColumn("_rid", F.monotonically_increasing_id()), "printed")
    groups = simhash_groups(rows, max_bits)
    best = (rows.select("fp", F.struct(F.col(id_at).isNull().alias("z"), F.col(id_at).alias("i"), "_rid").alias("r"))
            .groupBy("fp").agg(F.min("r").alias("r")).join(groups, "fp")
            .groupBy("group").agg(F.min("r").alias("r")).select(F.col("r._rid").alias("_rid")))
    # the rows that go are few as a rule: their ids travel, not the texts
    gone = written(rows.select("_rid").join(best, "_rid", "left_anti"), "gone")
    return rows.join(gone, "_rid", "left_anti").select(*plain.columns).toDF(*names)
