"""Semantic constants and policy objects.

Everything a user may want to change is a frozen dataclass passed to the
operators; module-level defaults hold the values the original platform uses.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values. These must equal the original platform's constants for the
# results to match; they are stated here once, in their natural order.
# --------------------------------------------------------------------------
SPEED_MIN = 0.0
SPEED_MAX = 120.0

LAT_MIN = -33.65
LAT_MAX = -33.30
LON_MIN = -70.85
LON_MAX = -70.50

ROUTE_MAP = {
    "210": "210",
    "210e": "210E",
    "210E": "210E",
    "502": "502",
    "502c": "502C",
    "502C": "502C",
    "104": "104",
}

# The live path looks routes up on upper(trim(raw)).
LIVE_ROUTE_MAP = {"210": "210", "210E": "210E", "502": "502", "502C": "502C", "104": "104"}

# Band name -> half-open speed interval [lo, hi), in declaration order.
BAND_TABLE = (
    ("Fluido", 30.0, 120.0),
    ("Moderado", 15.0, 30.0),
    ("Congestionado", 0.0, 15.0),
)
BAND_UNKNOWN = "Desconocido"
BAND_FLUID = "Fluido"
BAND_MODERATE = "Moderado"
BAND_CONGESTED = "Congestionado"
BAND_ORDER = ("Fluido", "Moderado", "Congestionado")

WEATHER_ORDER = ("Despejado", "Nublado", "Lluvia")
WEATHER_CLEAR = "Despejado"
WEATHER_RAIN = "Lluvia"

RULE_DUPLICATES = "duplicados_exactos"
RULE_SPEED = "velocidad_rango"
RULE_COORDS = "coordenadas_santiago"

TAG_DUPLICATE = "DUPLICADO"
TAG_BAD_SPEED = "VELOCIDAD_INVALIDA"

REASON_REQUIRED = "bus_id y ruta son obligatorios"
REASON_NUMERIC = "velocidad_kmh, latitud y longitud deben ser numéricos"
REASON_SPEED = "velocidad fuera de rango ({})"
REASON_LAT = "latitud fuera de Santiago ({})"
REASON_LON = "longitud fuera de Santiago ({})"
STAGE_NORMALISE = "normalizacion"
STAGE_VALIDATE = "validacion"
REASON_DUPLICATE = "duplicado (mismo bus, mismo minuto)"

EVENT_REJECTED = "posicion_rechazada"
EVENT_DUPLICATE = "posicion_duplicada"

TEXT_DUPLICATES = "Registros duplicados detectados"
TEXT_RANGE = "Valor fuera de rango [{}, {}] en '{}'"
TEXT_COORDS = "Coordenadas fuera de Santiago"

# Ping column names of the batch data model.
BUS = "ID_Bus"
ROUTE = "Ruta"
SPEED = "Velocidad_kmh"
LAT = "Latitud"
LON = "Longitud"
TS = "Timestamp"
PING_COLUMNS = (BUS, ROUTE, SPEED, LAT, LON, TS)


@dataclass(frozen=True)
class Bounds:
    """Inclusive validity bounds for speed and position."""

    speed_min: float = SPEED_MIN
    speed_max: float = SPEED_MAX
    lat_min: float = LAT_MIN
    lat_max: float = LAT_MAX
    lon_min: float = LON_MIN
    lon_max: float = LON_MAX


@dataclass(frozen=True)
class Bands:
    """Congestion classification.

    ``mode="sql"`` is the warehouse CASE (>=30, >=15, else congested, NULL
    falls to the ELSE branch); ``mode="table"`` is the half-open table lookup
    with ``unknown`` for anything outside every interval (NULL, NaN, 120).
    """

    table: tuple = BAND_TABLE
    unknown: str = BAND_UNKNOWN
    mode: str = "sql"


@dataclass(frozen=True)
class RouteMap:
    """Canonical route names. ``mode="map"``: dictionary lookup on the raw
    text, else upper(raw); ``mode="case"``: the warehouse CASE on upper(raw),
    which for the shipped map equals upper(raw)."""

    mapping: dict = field(default_factory=lambda: dict(ROUTE_MAP))
    mode: str = "case"


@dataclass(frozen=True)
class ImputePolicy:
    """How null temperatures are filled: mean of the non-null values,
    optionally rounded (``digits=None`` keeps the unrounded mean)."""

    digits: int | None = None


DEFAULT_BOUNDS = Bounds()
DEFAULT_BANDS = Bands()
LOCAL_BANDS = Bands(mode="table")
DEFAULT_ROUTES = RouteMap()
