"""Duplicate detection and removal.

Everything here is a hash aggregation with map-side partial aggregation, so a
key or a row that makes up a third of the data collapses to one record per
task before the shuffle. No operator sorts a whole duplicate group in one
task, and surplus copies are re-emitted in chunks spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Surplus copies of one row are emitted by tasks of at most this many rows.
REPLICATE_CHUNK = 1_000_000


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def row_counts(df: DataFrame, cols: list[str] | None = None, name: str = "n") -> DataFrame:
    """One row per distinct value of ``cols`` (all columns by default) with
    its multiplicity. NULLs group together, as in SQL GROUP BY."""
    cols = list(cols or df.columns)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))


def replicate(counted: DataFrame, lo: int, n_col: str = "n", index: str = "rn",
              chunk: int = REPLICATE_CHUNK) -> DataFrame:
    """Expand each row into copies numbered ``lo..n`` (inclusive).

    A row with a huge count is first split into chunks of ``chunk`` copies,
    the chunks are hash-spread over ``spark.sql.shuffle.partitions`` tasks
    (an explicit partition count, so AQE keeps them apart), and each task
    emits its own range.
    """
    n = F.col(n_col)
    keep = [c for c in counted.columns if c != n_col]
    parts = counted.where(n >= lo).select(
        "*", F.explode(F.sequence(F.lit(0), F.floor((n - lo) / chunk).cast("int"))).alias("_chunk"))
    parts = parts.repartition(_partitions(counted), *keep, "_chunk")
    start = (F.lit(lo) + F.col("_chunk") * chunk).cast("long")
    stop = F.least(n.cast("long"), start + (chunk - 1))
    return parts.select(*keep, F.explode(F.sequence(start, stop)).alias(index))


def distinct_rows(df: DataFrame) -> DataFrame:
    """SELECT DISTINCT * (partial + final hash aggregate)."""
    return df.dropDuplicates()


def split_duplicates(df: DataFrame, keys: list[str] | None = None,
                     order_by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``(kept, surplus)``: keep the first row per key, the rest is evidence.

    Without ``keys`` a duplicate is an identical row: which copy is "first"
    does not matter, so kept = one copy of each distinct row and surplus =
    ``n - 1`` copies of every row seen ``n > 1`` times.

    With ``keys`` the first row is the minimum of ``order_by`` (its first
    column a fixed-width type; ties broken by the remaining columns, so the
    choice is deterministic). The smallest value per key is a hash aggregate
    and meets the rows by a join, which AQE splits where a key is hot. Rows
    that tie for it are ranked in two rounds: among the rows of their key and
    salt, so a key with a third of all rows at one instant is spread over tasks,
    and then the winners of the salts, at most one a task. Surplus copies are
    re-emitted by :func:`replicate`, so a hot row's copies are spread over tasks.
    """
    cols = df.columns
    counted = row_counts(df, cols, "_n")
    if not keys:
        return counted.select(*cols), replicate(counted, 2, n_col="_n").select(*cols)
    order_by = list(order_by or [c for c in cols if c not in keys][:1])
    rest = [c for c in cols if c not in keys and c not in order_by]
    low = counted.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.min(order_by[0]).alias("_low"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    rows = counted.join(low, same).select(*cols, "_n", F.col(order_by[0]).eqNullSafe(F.col("_low")).alias("_tied"))
    order = [*order_by[1:], *rest]
    salt = F.pmod(F.xxhash64(*cols), F.lit(_partitions(df)))
    salted = rows.where("_tied").withColumn("_salt", salt).select(
        "*", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)).alias("_turn"))
    best = salted.where("_turn = 1").select(
        *cols, "_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).alias("_turn"))
    kept = best.where("_turn = 1").select(*cols)
    left = (rows.where("NOT _tied").select(*cols, "_n").unionByName(salted.where("_turn > 1").select(*cols, "_n"))
            .unionByName(best.select(*cols, (F.col("_n") - (F.col("_turn") == 1).cast("int")).alias("_n"))))
    return kept, replicate(left, 1, n_col="_n", index="_rep").select(*cols)
