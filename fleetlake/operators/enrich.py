"""Weather imputation and enrichment joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ImputePolicy
from ..functions.numeric import round_half_up
from .joins import join_dimension


def mean_temperature(weather: DataFrame, policy: ImputePolicy = ImputePolicy()) -> DataFrame:
    """One-row frame ``fill`` = mean of the non-null temperatures, rounded
    when the policy says so (J4's scalar subquery)."""
    m = F.avg("temperatura_promedio")
    if policy.digits is not None:
        m = round_half_up(m, policy.digits)
    return weather.agg(m.alias("_fill"))


def impute_temperature(weather: DataFrame, policy: ImputePolicy = ImputePolicy()) -> DataFrame:
    """NULL temperatures replaced by the mean of the others.

    The mean is a scalar subquery: one value for all rows, and a query that
    does not use the temperature does not compute it.
    """
    fill = mean_temperature(weather, policy).scalar()
    return weather.select("fecha", "condicion",
                          F.coalesce(F.col("temperatura_promedio"), fill).alias("temperatura_promedio"))


def enrich_weather(pings: DataFrame, weather: DataFrame, date_col: str = "Fecha",
                   condition: str = "Clima_Condicion", temperature: str = "Clima_Temperatura") -> DataFrame:
    """J1 + P13: pings LEFT JOIN weather on the date; the join key is dropped
    and the weather columns renamed. Days without weather keep NULLs; a
    duplicated weather date would fan out, as in SQL. Weather is one row per
    calendar day (a few hundred a year), which bounds the broadcast."""
    w = weather.select(F.col("fecha").alias(date_col), F.col("condicion").alias(condition),
                       F.col("temperatura_promedio").alias(temperature))
    return join_dimension(pings, w, date_col, "left", bounded=True)
