"""The warehouse batch plan: dedup -> validate -> normalise -> enrich ->
classify -> aggregate, as one lazily composed DataFrame plan.

Physical shape (see ``explain``): one hash aggregate for the exact dedup
(its filter is pushed below it, into the scan where possible), a broadcast
join against the size-checked weather dimension, then a partially
aggregated route-hour aggregate. Two exchanges over pings in total.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import config as C
from ..config import DEFAULT_BANDS, DEFAULT_BOUNDS, DEFAULT_ROUTES, Bands, Bounds, ImputePolicy, RouteMap
from ..functions.bands import congestion_band
from ..functions.text import canonical_route
from ..functions.time import with_date_parts
from ..operators.aggregate import route_hour
from ..operators.dedup import distinct_rows
from ..operators.enrich import enrich_weather, impute_temperature
from ..operators.quality import filter_valid


def normalise(df: DataFrame, routes: RouteMap = DEFAULT_ROUTES) -> DataFrame:
    """P2 + P7: canonical route and date, hour, weekday columns."""
    out = df.select(C.BUS, canonical_route(C.ROUTE, routes).alias(C.ROUTE), C.SPEED, C.LAT, C.LON, C.TS)
    return with_date_parts(out)


def clean_enriched(pings: DataFrame, weather: DataFrame, bounds: Bounds = DEFAULT_BOUNDS,
                   routes: RouteMap = DEFAULT_ROUTES, bands: Bands = DEFAULT_BANDS,
                   impute: ImputePolicy = ImputePolicy()) -> DataFrame:
    """The enriched table: raw pings deduplicated, validated (NULL rejected),
    normalised, joined to imputed weather and classified into bands."""
    valid = filter_valid(distinct_rows(pings.select(*C.PING_COLUMNS)), bounds)
    enriched = enrich_weather(normalise(valid, routes), impute_temperature(weather, impute))
    return enriched.withColumn("Nivel_Congestion", congestion_band(C.SPEED, bands))


def route_hour_report(pings: DataFrame, weather: DataFrame, **kw) -> DataFrame:
    """A1 over the warehouse plan."""
    return route_hour(clean_enriched(pings, weather, **kw))


def valid_pings(pings: DataFrame, bounds: Bounds = DEFAULT_BOUNDS) -> DataFrame:
    """V7 + U3: distinct raw pings inside the bounds."""
    return filter_valid(distinct_rows(pings.select(*C.PING_COLUMNS)), bounds)


__all__ = ["normalise", "clean_enriched", "route_hour_report", "valid_pings"]
