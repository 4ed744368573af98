"""Transit star schema built from raw pings (no dedup, no validation), and
the manual-path ``transformed`` table.

Surrogate ids: the original draws random UUIDs. A random id is recomputed
if a task is retried, and the fact table would then point at ids the
dimension does not hold, so the default here is a deterministic hash of the
natural key (``id_mode="hash"``); ``id_mode="uuid"`` reproduces the random
ids and must be materialised (written) before the fact is built from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.bands import band_sql
from ..functions.time import calendar_parts, weekday_name
from .dedup import replicate, row_counts
from .joins import join_dimension


def _surrogate(cols: list[str], id_mode: str) -> Column:
    if id_mode == "uuid":
        return F.expr("uuid()")
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols]), 256)


def dim_route(raw: DataFrame) -> DataFrame:
    """Distinct upper(route) as id and name."""
    return raw.select(F.upper(C.ROUTE).alias("ruta_id"), F.upper(C.ROUTE).alias("nombre_ruta")).distinct()


def dim_bus(raw: DataFrame) -> DataFrame:
    """Distinct bus ids."""
    return raw.select(F.col(C.BUS).alias("bus_id"), F.col(C.BUS).alias("codigo_bus")).distinct()


def dim_date(raw: DataFrame) -> DataFrame:
    """D3: distinct (date, year, month, day, hour, weekday): grain date-hour."""
    t = F.col(C.TS)
    return raw.select(F.to_date(t).alias("fecha_id"), *calendar_parts(t),
                      F.hour(t).cast("long").alias("hora"), weekday_name(t).alias("dia_semana")).distinct()


def dim_weather(weather: DataFrame, id_mode: str = "hash") -> DataFrame:
    """Weather rows with a surrogate id (the DISTINCT of the original has
    no effect because each row gets a fresh id)."""
    return weather.select(_surrogate(["fecha", "condicion", "temperatura_promedio"], id_mode).alias("clima_id"),
                          "fecha", "condicion", "temperatura_promedio")


def fact_trips(raw: DataFrame, dim_clima: DataFrame, id_mode: str = "hash") -> DataFrame:
    """D5 + J2: raw pings LEFT JOIN dim_weather on the ping date, with the
    congestion band. Every ping row has an id of its own, exact copies too. A
    duplicated weather date fans out, as in SQL."""
    t = F.col(C.TS)
    key = list(C.PING_COLUMNS)
    if id_mode == "hash":
        # equal pings are told apart by the number of their copy
        raw = replicate(row_counts(raw, key), 1, index="_copia")
        key = [*key, "_copia"]
    f = raw.select(
        _surrogate(key, id_mode).alias("viaje_id"),
        F.upper(C.ROUTE).alias("ruta_id"), F.col(C.BUS).alias("bus_id"),
        F.to_date(t).alias("fecha_id"), C.SPEED, C.LAT, C.LON, C.TS,
        band_sql(C.SPEED).alias("nivel_congestion"))
    d = dim_clima.select(F.col("fecha").alias("fecha_id"), "clima_id")
    j = join_dimension(f, d, "fecha_id", "left", bounded=True)
    return j.select("viaje_id", "ruta_id", "bus_id", "fecha_id", "clima_id", C.SPEED, C.LAT, C.LON, C.TS,
                    "nivel_congestion")


def transformed(raw: DataFrame) -> DataFrame:
    """The manual path's table: upper route, date parts and band on raw
    pings (no dedup, no validation, so NULL speeds reach the ELSE band)."""
    t = F.col(C.TS)
    return raw.select(C.BUS, F.upper(C.ROUTE).alias("ruta_normalizada"), C.SPEED, C.LAT, C.LON, C.TS,
                      F.to_date(t).alias("fecha"), F.hour(t).cast("long").alias("hora"),
                      weekday_name(t).alias("dia_semana"), band_sql(C.SPEED).alias("nivel_congestion"))
