"""The summary tables behind the congestion report (heatmap, series, weather
impact, box statistics, band shares, KPIs).

Each function returns a small aggregated DataFrame; nothing is collected.
Argmin/argmax use ``min_by``/``max_by`` on ``struct(value, key)`` so ties go
to the smallest key (first-wins over a sorted index).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.numeric import round_half_up
from .quantiles import box_stats

HOURS = list(range(24))


def _clean(df: DataFrame, *keys: str) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return df.where(cond)


def heatmap_cells(detail: DataFrame, route: str = "Ruta", hour: str = "Hora",
                  speed: str = C.SPEED, digits: int = 1) -> DataFrame:
    """Long form of the heatmap: mean speed per route and hour, rounded.
    NULL routes or hours are dropped (pivot_table semantics)."""
    return (_clean(detail, route, hour).groupBy(route, hour)
            .agg(round_half_up(F.avg(speed), digits).alias("velocidad")))


def heatmap(detail: DataFrame, route: str = "Ruta", hour: str = "Hora", speed: str = C.SPEED,
            digits: int = 1) -> DataFrame:
    """Route x hour pivot of mean speed (columns h00..h23; NULL = no
    data). A pivot with listed values is a single aggregation."""
    cells = heatmap_cells(detail, route, hour, speed, digits)
    wide = cells.groupBy(route).pivot(hour, HOURS).agg(F.first("velocidad"))
    return wide.select(route, *[F.col(str(h)).alias(f"h{h:02d}") for h in HOURS])


def worst_cells(detail: DataFrame, route: str = "Ruta", hour: str = "Hora",
                speed: str = C.SPEED) -> DataFrame:
    """A10: worst hour (lowest unweighted mean of the rounded cells of its
    column), its mean, and worst route (lowest mean of its row).

    The cells carry one decimal, so their means are taken in decimal
    arithmetic: equal means are then exactly equal (a float sum depends on
    the order of addition) and the tie goes to the smallest key."""
    cells = heatmap_cells(detail, route, hour, speed).withColumn(
        "velocidad", F.col("velocidad").cast("decimal(38,6)"))
    by_hour = cells.groupBy(hour).agg(F.avg("velocidad").alias("m"))
    by_route = cells.groupBy(route).agg(F.avg("velocidad").alias("m"))
    h = by_hour.agg(F.min_by(F.struct("m", hour), F.struct("m", hour)).alias("x")) \
        .select(F.col(f"x.{hour}").alias("hora_peor"), round_half_up(F.col("x.m"), 4).alias("vel_peor"))
    r = by_route.agg(F.min_by(F.col(route), F.struct("m", route)).alias("ruta_peor"))
    return h.crossJoin(r)


def hour_series(detail: DataFrame, route: str = "Ruta", hour: str = "Hora",
                speed: str = C.SPEED) -> DataFrame:
    """Mean speed by hour for every route (the line chart series)."""
    return (_clean(detail, route, hour).groupBy(route, hour)
            .agg(round_half_up(F.avg(speed), 4).alias("velocidad_promedio"),
                 F.count(F.lit(1)).alias("registros")))


def peak_hours(detail: DataFrame, hour: str = "Hora", speed: str = C.SPEED) -> DataFrame:
    """Global mean by hour -> peak (lowest), free (highest) hour and
    the window to avoid, [max(0, h-1), min(23, h+1)]. Means are decimal
    (exact sums), so the argmin/argmax does not depend on float summation
    order; ties go to the smallest hour."""
    g = _clean(detail, hour).groupBy(hour).agg(F.avg(F.col(speed).cast("decimal(38,6)")).alias("m"))
    out = g.agg(F.min_by(F.col(hour), F.struct("m", hour)).alias("hora_punta"),
                F.max_by(F.col(hour), F.struct("m", -F.col(hour))).alias("hora_libre"))
    return out.select("hora_punta", "hora_libre",
                      F.greatest(F.lit(0), F.col("hora_punta") - 1).cast("long").alias("evitar_desde"),
                      F.least(F.lit(23), F.col("hora_punta") + 1).cast("long").alias("evitar_hasta"))


def _by_condition(detail: DataFrame, cond: str, speed: str) -> list[Column]:
    return [F.avg(F.when(F.col(cond) == c, F.col(speed))).alias(f"c{i}")
            for i, c in enumerate(C.WEATHER_ORDER)]


def condition_means(detail: DataFrame, cond: str = "Clima_Condicion", speed: str = C.SPEED,
                    only_present: bool = False) -> DataFrame:
    """Mean speed per weather condition in the fixed order (Despejado,
    Nublado, Lluvia); a condition without rows has NULL mean, or is left out
    with ``only_present=True`` (the warehouse report). One pass."""
    row = detail.agg(*_by_condition(detail, cond, speed))
    args = [x for i, c in enumerate(C.WEATHER_ORDER) for x in (F.lit(i + 1).cast("long"), F.lit(c), F.col(f"c{i}"))]
    out = row.select(F.stack(F.lit(len(C.WEATHER_ORDER)), *args)).toDF("orden", "condicion", "m")
    out = out.select("orden", "condicion", round_half_up(F.col("m"), 4).alias("velocidad_promedio"))
    return out.where(F.col("velocidad_promedio").isNotNull()) if only_present else out


def rain_impact(detail: DataFrame, cond: str = "Clima_Condicion", speed: str = C.SPEED,
                fill_missing: bool = False) -> DataFrame:
    """Clear-day mean minus rain mean, and that difference as a percent
    of the clear mean; 0 when the clear mean is not positive or missing
    (a missing mean is not > 0), NULL when only the rain mean is missing.

    A missing class gives NULL (``fill_missing=False``); with
    ``fill_missing=True`` rain defaults to the lowest and clear to the
    highest mean of the present conditions (warehouse report).
    """
    row = detail.agg(*_by_condition(detail, cond, speed))
    clear, rain = F.col("c0"), F.col("c2")
    if fill_missing:
        lo = F.least(F.col("c0"), F.col("c1"), F.col("c2"))
        hi = F.greatest(F.col("c0"), F.col("c1"), F.col("c2"))
        clear, rain = F.coalesce(clear, hi), F.coalesce(rain, lo)
    diff = clear - rain
    pct = F.when(clear > 0, diff / clear * 100).otherwise(F.lit(0.0))
    return row.select(round_half_up(clear, 4).alias("vel_despejado"), round_half_up(rain, 4).alias("vel_lluvia"),
                      round_half_up(diff, 4).alias("diferencia"), round_half_up(pct, 4).alias("porcentaje"))


def box_by(detail: DataFrame, key: str = "Clima_Condicion", speed: str = C.SPEED) -> DataFrame:
    """Box statistics of speed per ``key`` (exact quartiles)."""
    b = box_stats(detail, [key], speed)
    return b.select(F.col(key), F.col("n"), *[round_half_up(F.col(c), 4).alias(c) for c in
                                              ("media", "q1", "mediana", "q3", "iqr", "bigote_inf", "bigote_sup")],
                    F.col("atipicos"))


def band_counts_by_route(detail: DataFrame, route: str = "Ruta", band: str = "Nivel_Congestion",
                         bus: str = C.BUS) -> DataFrame:
    """Rows with a bus id per route and band as three fixed columns (a pivot
    that always has every band, filled with 0): one conditional aggregation."""
    b, has_bus = F.col(band), F.col(bus).isNotNull()
    return _clean(detail, route).groupBy(route).agg(
        F.count_if((b == C.BAND_FLUID) & has_bus).cast("long").alias("n_fluido"),
        F.count_if((b == C.BAND_MODERATE) & has_bus).cast("long").alias("n_moderado"),
        F.count_if((b == C.BAND_CONGESTED) & has_bus).cast("long").alias("n_congestionado"))


def band_shares(detail: DataFrame, route: str = "Ruta", band: str = "Nivel_Congestion") -> DataFrame:
    """Per route the percentage of rows in each band (of the three
    bands' total), least congested first."""
    g = band_counts_by_route(detail, route, band)
    tot = F.col("n_fluido") + F.col("n_moderado") + F.col("n_congestionado")

    def share(c: str) -> Column:
        return round_half_up(F.when(tot > 0, F.col(c) * 100.0 / tot), 4)

    return g.select(route, "n_fluido", "n_moderado", "n_congestionado",
                    share("n_fluido").alias("pct_fluido"), share("n_moderado").alias("pct_moderado"),
                    share("n_congestionado").alias("pct_congestionado")).orderBy("pct_congestionado", route)


def kpis(detail: DataFrame, route: str = "Ruta", band: str = "Nivel_Congestion") -> DataFrame:
    """Global mean speed, distinct buses, rows, % congested rows, and
    the route with the highest congested share (ties: smallest route)."""
    glob = detail.agg(
        round_half_up(F.avg(C.SPEED), 4).alias("velocidad_global"),
        F.countDistinct(C.BUS).alias("buses_activos"),
        F.count(F.lit(1)).alias("total_registros"),
        round_half_up(F.count_if(F.col(band) == C.BAND_CONGESTED) * 100.0 / F.count(F.lit(1)), 4)
        .alias("pct_congestionado"))
    shares = band_shares(detail, route, band)
    pick = F.struct(-F.col("pct_congestionado"), F.col(route))
    name = shares.agg(F.min_by(F.col(route), pick).alias("ruta_critica"),
                      F.max("pct_congestionado").alias("pct_ruta_critica"))
    return glob.crossJoin(name)


def view_totals(view: DataFrame, by: list[str], value: str) -> DataFrame:
    """A count of the live view added up over some of its keys."""
    return view.groupBy(*by).agg(F.sum(value).alias(value))


def view_mean(view: DataFrame, by: list[str], value: str = "velocidad_promedio", weight: str | None = None) -> DataFrame:
    """The mean of the live view's means over some of its keys, each row
    alike or, with ``weight``, as often as it has pings (4 decimals). Rows
    without a value carry no weight."""
    v = F.col(value)
    mean = F.avg(v) if weight is None else F.sum(v * F.col(weight)) / F.sum(F.when(v.isNotNull(), F.col(weight)))
    return view.groupBy(*by).agg(round_half_up(mean, 4).alias(value))


def route_table(fact: DataFrame, route: str = "ruta_id", speed: str = C.SPEED) -> DataFrame:
    """Per route: trips, mean and min speed."""
    return fact.groupBy(route).agg(F.count(F.lit(1)).alias("viajes"),
                                   round_half_up(F.avg(speed), 4).alias("velocidad_promedio"),
                                   F.min(speed).alias("velocidad_min"))


def band_by_route(fact: DataFrame, route: str = "ruta_id", band: str = "nivel_congestion") -> DataFrame:
    """Trips per route and band (stacked bars)."""
    return fact.groupBy(route, band).agg(F.count(F.lit(1)).alias("viajes"))


def band_counts(fact: DataFrame, band: str = "nivel_congestion") -> DataFrame:
    """Trips per band."""
    return fact.groupBy(band).agg(F.count(F.lit(1)).alias("viajes"))
