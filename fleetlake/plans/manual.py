"""The manual warehouse path: transform raw pings (no dedup, no validation),
join weather imputed with the rounded mean, aggregate by route and hour.

It differs from :mod:`fleetlake.plans.warehouse` only in its choices: NULL
and out-of-range speeds reach the aggregate, routes are just upper-cased and
the temperature fill is rounded to one decimal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import ImputePolicy
from ..functions.numeric import round_half_up
from ..operators.enrich import impute_temperature
from ..operators.joins import join_dimension
from ..operators.starschema import transformed

MANUAL_IMPUTE = ImputePolicy(digits=1)


def enriched(raw: DataFrame, weather: DataFrame) -> DataFrame:
    """The manual ``datos_enriquecidos``: transformed pings LEFT JOIN the
    cleaned weather on the date."""
    w = impute_temperature(weather, MANUAL_IMPUTE).select(
        "fecha", F.col("condicion").alias("clima_condicion"),
        F.col("temperatura_promedio").alias("clima_temperatura"))
    return join_dimension(transformed(raw), w, "fecha", "left", bounded=True)


def route_hour(detail: DataFrame) -> DataFrame:
    """The manual ``datos_agregados`` (lower-case column names)."""
    s = F.col(C.SPEED)
    return detail.groupBy(F.col("ruta_normalizada").alias("ruta"), "hora").agg(
        round_half_up(F.avg(s), 2).alias("velocidad_promedio"),
        round_half_up(F.stddev_samp(s), 2).alias("velocidad_std"),
        F.min(s).alias("velocidad_min"), F.max(s).alias("velocidad_max"),
        F.countDistinct(C.BUS).alias("total_buses"), F.count(F.lit(1)).alias("total_registros")).orderBy("ruta", "hora")
