"""Per-event transformations of the live path, shared by batch and stream.

Every function is a column-wise DataFrame transformation, so the same code
runs on a static frame (the batch twin, used by the tests and the oracle)
and on a ``readStream`` frame. The only stateful step, the per-minute
dedup, has a batch form here and a watermarked streaming form in
:mod:`fleetlake.streaming.ingest`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT_BOUNDS
from ..functions.bands import band_sql
from ..functions.numeric import round_half_even, try_double
from ..functions.text import clean_id
from ..functions.time import weekday_name
from ..operators.dedup import split_duplicates
from ..operators.joins import join_dimension

ACCEPTED = "aceptado"
REJECTED_INVALID = "rechazado_validacion"
REJECTED_DUPLICATE = "rechazado_duplicado"
VALID = "valido"

LIVE_ROUTES = C.LIVE_ROUTE_MAP

POSITION_COLUMNS = ("viaje_id", "bus_id", "ruta", "ruta_raw", "velocidad_kmh", "latitud", "longitud",
                    "hora", "dia_semana", "nivel_congestion", "clima_condicion", "clima_temperatura",
                    "ingest_timestamp")


def _text(c: str, df: DataFrame) -> Column:
    return F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")


def _num(c: str, df: DataFrame) -> Column:
    return try_double(c) if c in df.columns else F.lit(None).cast("double")


def python_text(x: Column) -> Column:
    """A number's text as the original service prints it (Python ``repr`` of
    a float): ``nan``/``inf``/``-inf``, positional notation for decimal
    exponents -4..15 (Spark switches to ``1.0E7`` at 1e7 and below 1e-3) and
    ``1.5e-05`` / ``1e+16`` style beyond. Spark's text already carries the
    shortest digits; only their layout is changed. The parts are lambda
    variables, so each is computed once and the expression stays small."""
    def let(value: Column, body) -> Column:
        return F.element_at(F.transform(F.array(value), body), 1)

    def scientific(t: Column) -> Column:
        sign = F.when(t.startswith("-"), "-").otherwise("")
        parts = F.split(F.regexp_replace(t, "^-", ""), "[.E]")  # lead, fraction, exponent
        whole = F.struct(sign.alias("sign"), parts[0].alias("lead"),
                         F.regexp_replace(parts[1], "0+$", "").alias("frac"), parts[2].cast("int").alias("exp"))

        def lay(p: Column) -> Column:
            digits, exp = F.concat(p["lead"], p["frac"]), p["exp"]
            width = exp + 1
            positional = F.concat(
                p["sign"], F.rpad(F.substring(digits, F.lit(1), width), width, "0"), F.lit("."),
                F.when(F.length(digits) > width, F.substring(digits, width + 1, F.length(digits))).otherwise("0"))
            mantissa = F.when(p["frac"] == "", p["lead"]).otherwise(F.concat(p["lead"], F.lit("."), p["frac"]))
            return (F.when((exp >= 0) & (exp < 16), positional)
                    .when(exp == -4, F.concat(p["sign"], F.lit("0.000"), digits))
                    .otherwise(F.concat(p["sign"], mantissa, F.lit("e"), F.when(exp < 0, "-").otherwise("+"),
                                        F.lpad(F.abs(exp).cast("string"), 2, "0"))))

        return let(whole, lay)

    def layout(v: Column) -> Column:
        return (F.when(F.isnan(v), "nan").when(v == float("inf"), "inf").when(v == float("-inf"), "-inf")
                .otherwise(let(v.cast("string"), lambda t: F.when(t.contains("E"), scientific(t)).otherwise(t))))

    return let(x, layout)


def check_events(events: DataFrame, ts: str = "ts") -> DataFrame:
    """P3/P1/P4/P5 + V15/V16: typed, normalised events and ``_check``, the
    number of the first check that fails (NULL when the event is valid): 1 ids
    present, 2 numbers parse, 3 speed, 4 latitude, 5 longitude in range. The
    speed is rounded to 1 decimal (half-even) before the range check. A NULL
    or missing id is rejected. NaN fails every range check.

    Rows are split on this small column; the reason's text is laid out for
    rejected rows only (:func:`with_reason`), so no filter carries it.
    """
    b = DEFAULT_BOUNDS
    bus = clean_id(_text("bus_id", events))
    raw_route = F.trim(_text("ruta", events))
    lookup = F.create_map(*[F.lit(x) for kv in LIVE_ROUTES.items() for x in kv])
    route = F.coalesce(F.element_at(lookup, F.upper(raw_route)), F.upper(raw_route))
    speed = round_half_even(_num("velocidad_kmh", events), 1)
    lat, lon = _num("latitud", events), _num("longitud", events)
    typed = events.select(
        bus.alias("bus_id"), route.alias("ruta"), raw_route.alias("ruta_raw"),
        speed.alias("velocidad_kmh"), lat.alias("latitud"), lon.alias("longitud"),
        F.col(ts).alias("ts"))
    s, la, lo = F.col("velocidad_kmh"), F.col("latitud"), F.col("longitud")

    def outside(x: Column, lo_: float, hi_: float) -> Column:
        return ~F.coalesce(x.between(lo_, hi_), F.lit(False))

    return typed.withColumn("_check", (
        F.when((F.coalesce(F.col("bus_id"), F.lit("")) == "") | (F.coalesce(F.col("ruta_raw"), F.lit("")) == ""), 1)
        .when(s.isNull() | la.isNull() | lo.isNull(), 2)
        .when(outside(s, b.speed_min, b.speed_max), 3)
        .when(outside(la, b.lat_min, b.lat_max), 4)
        .when(outside(lo, b.lon_min, b.lon_max), 5)))


def with_reason(checked: DataFrame) -> DataFrame:
    """The reason's text in place of ``_check`` (NULL when valid). The
    offending value is one column and is laid out once."""
    value = (F.when(F.col("_check") == 3, F.col("velocidad_kmh")).when(F.col("_check") == 4, F.col("latitud"))
             .when(F.col("_check") == 5, F.col("longitud")))
    reason = F.when(F.col("_check") == 1, C.REASON_REQUIRED).when(F.col("_check") == 2, C.REASON_NUMERIC)
    for k, template in ((3, C.REASON_SPEED), (4, C.REASON_LAT), (5, C.REASON_LON)):
        prefix, suffix = template.split("{}")
        reason = reason.when(F.col("_check") == k, F.concat(F.lit(prefix), F.col("_text"), F.lit(suffix)))
    columns = [c for c in checked.columns if c != "_check"]
    return (checked.withColumn("_text", python_text(value)).select(*columns, reason.alias("reason")))


def normalise_events(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Typed, normalised events with the first failing reason."""
    return with_reason(check_events(events, ts))


def with_minute(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumn("minuto", F.date_trunc("minute", F.col(ts)))


def dedup_batch(valid: DataFrame, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """R2 batch twin: the earliest valid event per bus and minute is
    accepted, the rest are duplicates. Only valid events claim a key."""
    keyed = with_minute(valid, ts)
    return split_duplicates(keyed, ["bus_id", "minuto"], [ts])


def enrich_positions(accepted: DataFrame, weather: DataFrame | None = None, ts: str = "ts",
                     trip_id: str = "hash", default_weather: tuple[str, float] | None = None) -> DataFrame:
    """Add hour, weekday, band, weather and a trip id; shape the live table.

    ``weather`` (fecha, condicion, temperatura_promedio) is joined on the
    event date (stream-static join); ``trip_id="hash"`` derives a replayable
    id from (bus, time), ``"uuid"`` draws a random one as the original does.
    ``default_weather=(condition, temperature)`` fills positions without a
    weather row with constants (P18, the original's fixed demo weather).
    """
    t = F.col(ts)
    out = accepted.select("*", F.hour(t).cast("long").alias("hora"), weekday_name(t).alias("dia_semana"),
                          band_sql("velocidad_kmh").alias("nivel_congestion"),
                          F.to_date(t).alias("_fecha"))
    if weather is not None:
        w = weather.select(F.col("fecha").alias("_fecha"), F.col("condicion").alias("clima_condicion"),
                           F.col("temperatura_promedio").alias("clima_temperatura"))
        # one row per calendar day; never cached, so a stream that reads its
        # weather per batch sees days that were added meanwhile
        out = join_dimension(out, w, "_fecha", "left", bounded=True)
    else:
        out = out.withColumn("clima_condicion", F.lit(None).cast("string")) \
                 .withColumn("clima_temperatura", F.lit(None).cast("double"))
    if default_weather is not None:
        cond, temp = default_weather
        out = out.withColumn("clima_condicion", F.coalesce(F.col("clima_condicion"), F.lit(cond))) \
                 .withColumn("clima_temperatura", F.coalesce(F.col("clima_temperatura"), F.lit(float(temp))))
    vid = (F.sha2(F.concat_ws("|", F.col("bus_id"), t.cast("string")), 256) if trip_id == "hash"
           else F.expr("uuid()"))
    return out.select(vid.alias("viaje_id"), "bus_id", "ruta", "ruta_raw", "velocidad_kmh", "latitud",
                      "longitud", "hora", "dia_semana", "nivel_congestion", "clima_condicion",
                      "clima_temperatura", t.alias("ingest_timestamp"))


def process_batch(events: DataFrame, weather: DataFrame | None = None, ts: str = "ts",
                  trip_id: str = "hash") -> tuple[DataFrame, DataFrame]:
    """R1 batch twin: ``(positions, outcomes)``.

    ``outcomes`` has one row per event with ``outcome`` and ``reason``;
    ``positions`` holds the accepted, enriched events.
    """
    checked = check_events(events, ts)
    invalid = with_reason(checked.where(F.col("_check").isNotNull()))
    valid = checked.where(F.col("_check").isNull()).drop("_check")
    kept, dups = dedup_batch(valid, ts)
    keep_cols = ["bus_id", "ruta", "ruta_raw", "velocidad_kmh", "latitud", "longitud", "ts"]
    outcomes = (invalid.select(*keep_cols, F.lit(REJECTED_INVALID).alias("outcome"), "reason")
                .unionByName(dups.select(*keep_cols, F.lit(REJECTED_DUPLICATE).alias("outcome"),
                                         F.lit(C.REASON_DUPLICATE).alias("reason")))
                .unionByName(kept.select(*keep_cols, F.lit(ACCEPTED).alias("outcome"),
                                         F.lit("ok").alias("reason"))))
    positions = enrich_positions(kept.drop("minuto"), weather, ts, trip_id)
    return positions, outcomes


def events_from_pings(pings: DataFrame) -> DataFrame:
    """Ping events (bus_id, ruta, velocidad_kmh, latitud, longitud, ts) as
    the live path receives them, from the batch ping schema."""
    return pings.select(F.col(C.BUS).alias("bus_id"), F.col(C.ROUTE).alias("ruta"),
                        F.col(C.SPEED).alias("velocidad_kmh"), F.col(C.LAT).alias("latitud"),
                        F.col(C.LON).alias("longitud"), F.col(C.TS).alias("ts"))


def recent_positions(positions: DataFrame, n: int = 50, ts: str = "ingest_timestamp") -> DataFrame:
    """T5: the ``n`` most recent accepted positions, oldest first (top-k;
    ties broken by bus id so the choice is deterministic)."""
    top = positions.orderBy(F.col(ts).desc(), F.col("bus_id").desc()).limit(n)
    return top.orderBy(ts, "bus_id")


__all__ = ["normalise_events", "dedup_batch", "enrich_positions", "process_batch", "events_from_pings",
           "recent_positions"]
