"""Running sums and ranks over a whole table in a global order.

A window over an unpartitioned order would sort all rows in one task, and a
window per key would sort a hot key in one task. Here the rows are range
partitioned by the order itself (ties are split by a row id fixed when the
narrow input is written), each part is summed, the few totals are added up,
and each row adds its part's offset. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .runtime import shuffle_parts, written

PART, ROW = "_part", "_row"


def placed(df: DataFrame, order: list[str]) -> DataFrame:
    """``df`` with its range part ``_part`` and a unique ``_row``, written.

    Two writes: the first fixes the row ids (and spares computing the input
    twice, since range partitioning samples it), the second the parts.
    """
    spark = df.sparkSession
    base = written(df.withColumn(ROW, F.monotonically_increasing_id()), "rows")
    parts = base.repartitionByRange(shuffle_parts(spark), *order, ROW)
    return written(parts.withColumn(PART, F.spark_partition_id()), "ranges")


def running(rows: DataFrame, order: list[str], sums: dict[str, Column]) -> DataFrame:
    """Adds, for each name, the sum of its expression over this row and all
    rows before it. ``rows`` comes from :func:`placed` with the same order."""
    inside = Window.partitionBy(PART).orderBy(*order, ROW)
    totals = rows.groupBy(PART).agg(*[F.sum(e).alias(n) for n, e in sums.items()])
    # one row per part: bounded by the number of shuffle partitions
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(PART, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_off_{n}") for n in sums])
    out = rows.select("*", *[F.sum(e).over(inside).alias(f"_in_{n}") for n, e in sums.items()])
    return (out.join(F.broadcast(offsets), PART)
            .select(*rows.columns, *[(F.col(f"_in_{n}") + F.col(f"_off_{n}")).alias(n) for n in sums]))


def last_before(rows: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """Adds ``name``: the last non-null ``value`` among this row and all rows
    before it in the order."""
    inside = Window.partitionBy(PART).orderBy(*order, ROW)
    ends = (rows.where(F.col(value).isNotNull()).groupBy(PART)
            .agg(F.max_by(value, F.struct(*order, ROW)).alias("_end")))
    parts = rows.select(PART).distinct().join(ends, PART, "left")
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(PART, F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    out = rows.withColumn("_last", F.last(value, ignorenulls=True).over(inside))
    return (out.join(F.broadcast(carried), PART)
            .withColumn(name, F.coalesce("_last", "_carried")).drop("_last", "_carried"))

