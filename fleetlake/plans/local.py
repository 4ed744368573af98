"""The local batch plan (the pandas variant of the batch logic):
dedup -> normalise -> validate (NULL counts as valid) -> impute rounded
mean -> enrich -> half-open band table -> aggregate (non-null bus count,
NULL keys dropped).

Differences from the warehouse plan are parameters of the same operators
(SURVEY 2.13); this module only fixes the local choices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import config as C
from ..config import DEFAULT_BOUNDS, LOCAL_BANDS, Bounds, ImputePolicy, RouteMap
from ..functions.bands import congestion_band
from ..operators.aggregate import route_hour
from ..operators.dedup import split_duplicates
from ..operators.enrich import enrich_weather, impute_temperature
from ..operators.quality import split_bbox, split_range
from .warehouse import normalise

LOCAL_ROUTES = RouteMap(mode="map")
LOCAL_IMPUTE = ImputePolicy(digits=1)


def stages(pings: DataFrame, weather: DataFrame, bounds: Bounds = DEFAULT_BOUNDS) -> dict[str, DataFrame]:
    """All intermediate frames of the local plan, lazily: the evidence
    tables (duplicates, bad speeds, bad coordinates) and the enriched
    detail. Nothing runs until a frame is written or collected."""
    kept, dups = split_duplicates(pings.select(*C.PING_COLUMNS))
    norm = normalise(kept, LOCAL_ROUTES)
    ok_speed, bad_speed = split_range(norm, C.SPEED, bounds.speed_min, bounds.speed_max, nulls="keep")
    ok, bad_coords = split_bbox(ok_speed, C.LAT, C.LON, bounds, nulls="keep")
    detail = enrich_weather(ok, impute_temperature(weather, LOCAL_IMPUTE))
    detail = detail.withColumn("Nivel_Congestion", congestion_band(C.SPEED, LOCAL_BANDS))
    return {"duplicados": dups, "velocidades_invalidas": bad_speed, "coordenadas_invalidas": bad_coords,
            "enriquecido": detail}


def route_hour_local(pings: DataFrame, weather: DataFrame, bounds: Bounds = DEFAULT_BOUNDS) -> DataFrame:
    """A1 of the local plan: non-null bus count, NULL group keys dropped."""
    detail = stages(pings, weather, bounds)["enriquecido"]
    return route_hour(detail, count_rows=False, drop_null_keys=True)
