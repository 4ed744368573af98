"""A4 kept up to date by a stream, exactly.

The live view is maintained incrementally: a batch adds its partial counts,
decimal sums, minima and maxima to those of the batches before. Distinct buses
are counted by a table of the (group, bus) pairs seen so far: a batch counts
the pairs it is the first to bring. Both are committed tables, so a reader sees
the view of a whole number of batches, and a repeated batch changes nothing.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numeric import round_half_up
from ..sinks import versioned

KEYS = ["ruta", "hora", "nivel_congestion", "clima_condicion"]
_KEY_SCHEMA = "ruta string, hora long, nivel_congestion string, clima_condicion string"
#: ``tramo`` is the hour, -1 without one: the column folders are bounded by.
PAIR_SCHEMA = f"{_KEY_SCHEMA}, bus_id string, tramo long, batch_id long"
STATE_SCHEMA = (f"{_KEY_SCHEMA}, total_pings long, con_velocidad long, buses_unicos long, suma decimal(38,6), "
                "velocidad_min double, velocidad_max double")


def _same(a: DataFrame, b: DataFrame, columns: list[str]):
    cond = F.lit(True)
    for c in columns:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def maintain_live_view(positions: DataFrame, batch_id: int, base: str) -> None:
    """Fold one batch of positions into the view under ``base``."""
    spark = positions.sparkSession
    view, pairs, stored = (os.path.join(base, k) for k in ("view", "pairs", "_batch"))
    before = versioned.manifest(spark, view)
    if batch_id <= before["batch_id"]:
        return
    # the batch is computed once; its pairs and sums are taken from the same rows
    tramo = F.coalesce(F.col("hora"), F.lit(-1)).cast("long").alias("tramo")
    versioned.commit(positions.select(*KEYS, "bus_id", "velocidad_kmh", tramo), stored, batch_id, replace=True, bound="tramo")
    kept = versioned.manifest(spark, stored)["folders"]
    rows = versioned.read_folders(spark, stored, kept, f"{_KEY_SCHEMA}, bus_id string, velocidad_kmh double, tramo long")
    lo, hi = kept[0]["lo"], kept[0]["hi"]
    if versioned.manifest(spark, pairs)["batch_id"] < batch_id:
        known = versioned.read_snapshot(spark, pairs, PAIR_SCHEMA, lo, hi).where(F.col("tramo").between(lo, hi))
        seen = rows.where("bus_id IS NOT NULL").select(*KEYS, "bus_id", "tramo").distinct()
        new = seen.join(known, _same(seen, known, [*KEYS, "bus_id"]), "left_anti")
        versioned.commit(new.withColumn("batch_id", F.lit(batch_id).cast("long")), pairs, batch_id, bound="tramo")
    # pairs of this batch stand in a folder of their own until they are merged
    fresh = [f for f in versioned.manifest(spark, pairs)["folders"] if f["name"] == f"batch_id={batch_id}"]
    first_seen = (versioned.read_folders(spark, pairs, fresh, PAIR_SCHEMA).groupBy(*KEYS)
                  .agg(F.count(F.lit(1)).alias("buses_unicos")))
    v = F.col("velocidad_kmh")
    part = rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("total_pings"), F.count(v).alias("con_velocidad"),
        F.sum(v.cast("decimal(28,6)")).cast("decimal(38,6)").alias("suma"), F.min(v).alias("velocidad_min"),
        F.max(v).alias("velocidad_max"))
    old = versioned.read_folders(spark, view, before["folders"], STATE_SCHEMA)
    merged = (old.unionByName(part, allowMissingColumns=True).unionByName(first_seen, allowMissingColumns=True)
              .groupBy(*KEYS).agg(
                  *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c)
                    for c in ("total_pings", "con_velocidad", "buses_unicos")],
                  F.sum("suma").cast("decimal(38,6)").alias("suma"), F.min("velocidad_min").alias("velocidad_min"),
                  F.max("velocidad_max").alias("velocidad_max")))
    versioned.commit(merged, view, batch_id, replace=True)
    versioned.compact(spark, pairs, PAIR_SCHEMA, bound="tramo", order=["tramo", "bus_id"])


def read_live_view(spark: SparkSession, base: str) -> DataFrame:
    """The view after the last committed batch, with the columns and
    the rounding of :func:`..operators.aggregate.live_view`."""
    state = versioned.read_snapshot(spark, os.path.join(base, "view"), STATE_SCHEMA)
    mean = F.when(F.col("con_velocidad") > 0, F.col("suma") / F.col("con_velocidad")).cast("double")
    return state.select(*KEYS, "total_pings", "buses_unicos", round_half_up(mean, 2).alias("velocidad_promedio"),
                        round_half_up("velocidad_min", 2).alias("velocidad_min"),
                        round_half_up("velocidad_max", 2).alias("velocidad_max"))


def start_live_view(positions: DataFrame, base: str, trigger: dict | None = None) -> StreamingQuery:
    """A4 as a table that a stream of positions keeps up to date."""
    return (positions.writeStream.foreachBatch(lambda df, n: maintain_live_view(df, n, base))
            .option("checkpointLocation", os.path.join(base, "_checkpoint"))
            .trigger(**(trigger or {"availableNow": True})).start())
