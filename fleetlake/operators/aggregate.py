"""Grouped summaries of pings and live positions.

All aggregates are algebraic (count, sum, avg, min, max, stddev) or one
exact distinct count; Spark partially aggregates them before the shuffle,
so a hot group costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.numeric import round_half_up
from ..functions.numeric import pct as pct_expr


def route_hour(enriched: DataFrame, route: str = "Ruta", hour: str = "Hora", speed: str = C.SPEED,
               bus: str = C.BUS, digits: int = 2, count_rows: bool = True,
               drop_null_keys: bool = False) -> DataFrame:
    """A1: per route and hour: mean and sample std (rounded), min, max,
    distinct buses and rows; in route and hour order.

    ``count_rows=False`` counts non-null bus ids (the pandas variant) and
    ``drop_null_keys=True`` drops NULL group keys (pandas ``groupby``).
    """
    df = enriched
    if drop_null_keys:
        df = df.where(F.col(route).isNotNull() & F.col(hour).isNotNull())
    rows = F.count(F.lit(1)) if count_rows else F.count(bus)
    return df.groupBy(route, hour).agg(
        round_half_up(F.avg(speed), digits).alias("Velocidad_Promedio"),
        round_half_up(F.stddev_samp(speed), digits).alias("Velocidad_Std"),
        F.min(speed).alias("Velocidad_Min"),
        F.max(speed).alias("Velocidad_Max"),
        F.countDistinct(bus).alias("Total_Buses"),
        rows.alias("Total_Registros"),
    ).orderBy(route, hour)


def distinct_and_folds(df: DataFrame, distinct: dict[str, str], folds: dict[str, tuple[Column, str]]) -> DataFrame:
    """One row: the distinct non-null values of each column of ``distinct``
    (alias -> column) and every fold (alias -> aggregate, and ``sum``, ``min``
    or ``max``, which merges its parts).

    Several ``countDistinct`` in one aggregate copy every row once per column
    (Expand). Here rows are grouped by all the columns together first, with the
    folds beside them, and only those groups are split by column.
    """
    columns = list(distinct.values())
    groups = df.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)]).agg(
        *[e.alias(f"_f{j}") for j, (e, _) in enumerate(folds.values())])
    names = [f"_f{j}" for j in range(len(folds))]
    parts = [F.struct(F.lit(i).alias("column"), F.col(f"_k{i}").cast("string").alias("value"),
                      *[F.when(F.lit(i == 0), F.col(f)).alias(f) for f in names]) for i in range(len(columns))]
    merge = [getattr(F, how)(F.col(f)).alias(f) for f, (_, how) in zip(names, folds.values(), strict=True)]
    values = groups.select(F.inline(F.array(*parts))).groupBy("column", "value").agg(*merge)
    return values.agg(
        *[F.count_if((F.col("column") == i) & F.col("value").isNotNull()).cast("long").alias(a) for i, a in enumerate(distinct)],
        *merge).select(*distinct, *[F.col(f).alias(a) for f, a in zip(names, folds, strict=True)])


def post_clean_stats(enriched: DataFrame) -> DataFrame:
    """A2: one row after cleaning: rows, routes, buses, mean speed, rows per
    band and distinct weather conditions."""
    band = F.col("Nivel_Congestion")
    counted = {"total_registros": F.count(F.lit(1)), "n_fluido": F.count_if(band == C.BAND_FLUID),
               "n_moderado": F.count_if(band == C.BAND_MODERATE), "n_congestionado": F.count_if(band == C.BAND_CONGESTED)}
    row = distinct_and_folds(
        enriched, {"rutas_unicas": "Ruta", "buses_unicos": C.BUS, "condiciones_clima": "Clima_Condicion"},
        {a: (e, "sum") for a, e in counted.items()}
        | {"_speeds": (F.sum(C.SPEED), "sum"), "_with_speed": (F.count(C.SPEED), "sum")})
    n = {a: F.coalesce(F.col(a), F.lit(0)).cast("long").alias(a) for a in counted}
    mean = F.when(F.col("_with_speed") > 0, F.col("_speeds") / F.col("_with_speed"))
    return row.select(n["total_registros"], "rutas_unicas", "buses_unicos", round_half_up(mean, 2).alias("vel_promedio"),
                      n["n_fluido"], n["n_moderado"], n["n_congestionado"], "condiciones_clima")


def band_distribution(enriched: DataFrame, band: str = "Nivel_Congestion") -> DataFrame:
    """A3 + P17: rows per band and their share of all rows (1 decimal),
    most frequent first. The total is a one-row aggregate joined to the
    band rows (no single-partition window)."""
    g = enriched.groupBy(F.col(band).alias("nivel_congestion")).agg(F.count(F.lit(1)).alias("registros"))
    total = g.agg(F.sum("registros").alias("_total"))
    return g.crossJoin(F.broadcast(total)).select(
        "nivel_congestion", "registros", pct_expr(F.col("registros"), F.col("_total"), 1).alias("porcentaje")).orderBy(
            F.col("registros").desc(), "nivel_congestion")


def live_view(positions: DataFrame) -> DataFrame:
    """A4: the live aggregate by route, hour, band and weather condition."""
    v = F.col("velocidad_kmh")
    return positions.groupBy("ruta", "hora", "nivel_congestion", "clima_condicion").agg(
        F.count(F.lit(1)).alias("total_pings"),
        F.countDistinct("bus_id").alias("buses_unicos"),
        round_half_up(F.avg(v), 2).alias("velocidad_promedio"),
        round_half_up(F.min(v), 2).alias("velocidad_min"),
        round_half_up(F.max(v), 2).alias("velocidad_max"),
    )


def live_summary(positions: DataFrame) -> DataFrame:
    """A5: pings and mean speed (1 decimal) per route and band, in that order."""
    return positions.groupBy("ruta", "nivel_congestion").agg(
        F.count(F.lit(1)).alias("pings"),
        round_half_up(F.avg("velocidad_kmh"), 1).alias("vel_promedio")).orderBy("ruta", "nivel_congestion")


def totals(positions: DataFrame, bus: str = "bus_id") -> DataFrame:
    """Pings and distinct buses."""
    return positions.agg(F.count(F.lit(1)).alias("pings"),
                         F.countDistinct(bus).alias("buses"))


def band_summary(positions: DataFrame) -> DataFrame:
    """Pings and mean speed (1 decimal) per band, most pings first."""
    return positions.groupBy("nivel_congestion").agg(
        F.count(F.lit(1)).alias("pings"),
        round_half_up(F.avg("velocidad_kmh"), 1).alias("vel")).orderBy(F.col("pings").desc(), "nivel_congestion")


def ingest_counters(outcomes: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Received, accepted, rejected by validation, rejected as duplicate."""
    o = F.col(outcome)
    return outcomes.agg(
        F.count(F.lit(1)).alias("recibidos"),
        F.count_if(o == "aceptado").cast("long").alias("aceptados"),
        F.count_if(o == "rechazado_validacion").cast("long").alias("rechazados_validacion"),
        F.count_if(o == "rechazado_duplicado").cast("long").alias("rechazados_duplicado"))


def aggregate_summary(agg: DataFrame, route: str = "Ruta", hour: str = "Hora") -> DataFrame:
    """Groups, distinct routes and hour range of a route-hour table."""
    return agg.agg(F.count(F.lit(1)).alias("grupos"), F.countDistinct(route).alias("rutas_unicas"),
                   F.min(hour).alias("hora_min"), F.max(hour).alias("hora_max"))
