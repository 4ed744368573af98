"""Validation splits, quality profiles and data-quality views.

A ``split_*`` function returns ``(valid, invalid)``: two lazy filters over
the same input with complementary predicates, so ``valid + invalid = input``
holds by construction. Counts per rule come from :func:`rule_counts`, which
evaluates every rule in one aggregation pass instead of one job per rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..config import DEFAULT_BOUNDS, Bounds
from ..functions.text import composite_key
from ..functions.time import TS_FORMAT, parse_ts
from .aggregate import distinct_and_folds
from .dedup import replicate, row_counts


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ------------------------------------------------------------------ predicates

def out_of_range(c: Column | str, lo: float, hi: float, nulls: str = "keep") -> Column:
    """Invalid-row predicate for a numeric range (never NULL itself).

    ``keep`` (pandas mask): NULL and NaN are not invalid. ``drop``
    (warehouse BETWEEN): NULL and NaN are invalid.
    """
    x = _c(c)
    if nulls == "keep":
        return F.coalesce(~F.isnan(x) & ((x < lo) | (x > hi)), F.lit(False))
    return ~F.coalesce(x.between(lo, hi), F.lit(False))


def out_of_box(lat: Column | str, lon: Column | str, b: Bounds = DEFAULT_BOUNDS,
               nulls: str = "keep") -> Column:
    return (out_of_range(lat, b.lat_min, b.lat_max, nulls)
            | out_of_range(lon, b.lon_min, b.lon_max, nulls))


def bad_speed(c: Column | str = C.SPEED, b: Bounds = DEFAULT_BOUNDS, nulls: str = "keep") -> Column:
    return out_of_range(c, b.speed_min, b.speed_max, nulls)


def any_null(cols: list[str], df: DataFrame | None = None) -> Column:
    """True when any column is NULL (or NaN for floating columns)."""
    floats = set()
    if df is not None:
        floats = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    parts = [F.col(c).isNull() | (F.isnan(c) if c in floats else F.lit(False)) for c in cols]
    return reduce(lambda a, b: a | b, parts)


# ---------------------------------------------------------------------- splits

def split_by(df: DataFrame, invalid: Column) -> tuple[DataFrame, DataFrame]:
    return df.where(~invalid), df.where(invalid)


def split_range(df: DataFrame, col: str, lo: float, hi: float,
                nulls: str = "keep") -> tuple[DataFrame, DataFrame]:
    """V1: invalid iff x < lo or x > hi; NULL counts as valid by default."""
    return split_by(df, out_of_range(col, lo, hi, nulls))


def split_nulls(df: DataFrame, cols: list[str]) -> tuple[DataFrame, DataFrame]:
    """V2: invalid iff any of ``cols`` is NULL (or NaN)."""
    return split_by(df, any_null(cols, df))


def split_bbox(df: DataFrame, lat: str = C.LAT, lon: str = C.LON, bounds: Bounds = DEFAULT_BOUNDS,
               nulls: str = "keep") -> tuple[DataFrame, DataFrame]:
    """V4: invalid iff outside the box; NULL counts as valid by default."""
    return split_by(df, out_of_box(lat, lon, bounds, nulls))


def split_date_format(df: DataFrame, col: str, fmt: str = TS_FORMAT) -> tuple[DataFrame, DataFrame]:
    """V5: invalid iff the text does not parse with ``fmt`` (or is NULL)."""
    return split_by(df, parse_ts(F.col(col).cast("string"), fmt).isNull())


def filter_valid(df: DataFrame, bounds: Bounds = DEFAULT_BOUNDS) -> DataFrame:
    """V7: inclusive speed range and box, as the warehouse WHERE (NULL fails)."""
    b = bounds
    return df.where(F.col(C.SPEED).between(b.speed_min, b.speed_max)
                    & F.col(C.LAT).between(b.lat_min, b.lat_max)
                    & F.col(C.LON).between(b.lon_min, b.lon_max))


# --------------------------------------------------------------- rule counting

def rule_counts(df: DataFrame, rules: list[tuple[str, str, Column]],
                weight: Column | None = None) -> DataFrame:
    """V6: ``(orden, regla, razon, registros_invalidos)`` for every rule, from
    one aggregation pass; ``weight`` lets a pre-counted frame stand for its
    multiplicities."""
    w = weight if weight is not None else F.lit(1)
    aggs = [F.coalesce(F.sum(F.when(cond, w)), F.lit(0)).cast("long").alias(f"r{i}")
            for i, (_, _, cond) in enumerate(rules)]
    row = df.agg(*aggs)
    args = [x for i, (name, reason, _) in enumerate(rules)
            for x in (F.lit(i + 1).cast("long"), F.lit(name), F.lit(reason), F.col(f"r{i}"))]
    return row.select(F.stack(F.lit(len(rules)), *args)).toDF("orden", "regla", "razon", "registros_invalidos")


def local_validation_report(pings: DataFrame, bounds: Bounds = DEFAULT_BOUNDS) -> DataFrame:
    """V6 for the local batch order: exact duplicates, then speed range, then
    box, each counted on what the previous rule left (NULL is valid)."""
    counted = row_counts(pings, list(C.PING_COLUMNS))
    speed = bad_speed(C.SPEED, bounds, "keep")
    box = out_of_box(C.LAT, C.LON, bounds, "keep")
    rules = [
        (C.RULE_DUPLICATES, C.TEXT_DUPLICATES, F.col("n") > 1),
        (C.RULE_SPEED, C.TEXT_RANGE.format(int(bounds.speed_min), int(bounds.speed_max), C.SPEED), speed),
        (C.RULE_COORDS, C.TEXT_COORDS, ~speed & box),
    ]
    weight = F.when(F.col("n") > 1, F.col("n") - 1).otherwise(F.lit(0))
    dup = rule_counts(counted, rules[:1], weight)
    rest = rule_counts(counted, rules[1:]).withColumn("orden", F.col("orden") + 1)
    return dup.unionByName(rest)


def report_summary(report: DataFrame) -> DataFrame:
    """One row: rules applied and total invalid, from a rule-count frame."""
    return report.agg(F.count(F.lit(1)).alias("total_reglas_aplicadas"),
                      F.coalesce(F.sum("registros_invalidos"), F.lit(0)).cast("long")
                      .alias("total_registros_invalidos"))


def sample_invalid(named: list[tuple[str, str, DataFrame]], per_rule: int = 5, overall: int = 20,
                   order_by: list[str] | None = None) -> DataFrame:
    """The first ``per_rule`` invalid rows of each ``(rule, reason, rows)``
    with the reason's text (at most ``overall``). "First" is the sort order of ``order_by`` (all columns by
    default): every branch is a top-k, which keeps ``k`` rows per task."""
    parts = []
    for i, (rule, reason, df) in enumerate(named):
        keys = order_by or df.columns
        parts.append(df.orderBy(*keys).limit(per_rule)
                     .select(F.lit(i + 1).cast("long").alias("orden"), F.lit(rule).alias("regla"),
                             F.lit(reason).alias("razon"), "*"))
    out = reduce(DataFrame.unionByName, parts)
    keys = order_by or named[0][2].columns
    return out.orderBy("orden", *keys).limit(overall)


# -------------------------------------------------------------------- evidence

def invalid_evidence(raw: DataFrame, bounds: Bounds = DEFAULT_BOUNDS) -> DataFrame:
    """V8: surplus exact duplicates (``rn`` 2..n) UNION ALL bad speeds
    (``rn`` = 1). A bad-speed duplicate appears in both branches; bad
    coordinates are not evidence here."""
    cols = list(C.PING_COLUMNS)
    dups = replicate(row_counts(raw, cols), 2).select(*cols, "rn",
                                                      F.lit(C.TAG_DUPLICATE).alias("tipo_error"))
    speeds = raw.where((F.col(C.SPEED) < bounds.speed_min) | (F.col(C.SPEED) > bounds.speed_max)) \
        .select(*cols, F.lit(1).cast("long").alias("rn"), F.lit(C.TAG_BAD_SPEED).alias("tipo_error"))
    return dups.unionByName(speeds)


# -------------------------------------------------------------------- profiles

def raw_profile(raw: DataFrame, bounds: Bounds = DEFAULT_BOUNDS) -> DataFrame:
    """V9: one row over raw pings, from a single row-count aggregation.

    ``total_duplicados`` follows the warehouse rule: rows minus distinct
    rows, where a row with a NULL part never counts as distinct.
    """
    cols = list(C.PING_COLUMNS)
    g = row_counts(raw, cols)
    n = F.col("n")
    b = bounds
    speed = (F.col(C.SPEED) < b.speed_min) | (F.col(C.SPEED) > b.speed_max)
    coords = ((F.col(C.LAT) < b.lat_min) | (F.col(C.LAT) > b.lat_max)
              | (F.col(C.LON) < b.lon_min) | (F.col(C.LON) > b.lon_max))
    no_null = ~reduce(lambda a, c: a | c, [F.col(c).isNull() for c in cols])
    total = F.coalesce(F.sum(n), F.lit(0))
    return g.agg(
        total.cast("long").alias("total_registros"),
        F.coalesce(F.sum(F.when(speed, n)), F.lit(0)).cast("long").alias("velocidades_invalidas"),
        F.count_if(n > 1).cast("long").alias("registros_con_duplicados"),
        (total - F.count_if(no_null)).cast("long").alias("total_duplicados"),
        F.coalesce(F.sum(F.when(coords, n)), F.lit(0)).cast("long").alias("coordenadas_fuera_rango"),
    )


def gps_null_profile(raw: DataFrame) -> DataFrame:
    """Rows, NULL speeds, NULL coordinates, NULL timestamps, surplus
    duplicates (same NULL rule as V9)."""
    cols = list(C.PING_COLUMNS)
    g = row_counts(raw, cols)
    n = F.col("n")
    no_null = ~reduce(lambda a, c: a | c, [F.col(c).isNull() for c in cols])
    total = F.coalesce(F.sum(n), F.lit(0))
    return g.agg(
        total.cast("long").alias("total_registros"),
        F.coalesce(F.sum(F.when(F.col(C.SPEED).isNull(), n)), F.lit(0)).cast("long").alias("nulos_velocidad"),
        F.coalesce(F.sum(F.when(F.col(C.LAT).isNull() | F.col(C.LON).isNull(), n)), F.lit(0))
        .cast("long").alias("nulos_coordenadas"),
        F.coalesce(F.sum(F.when(F.col(C.TS).isNull(), n)), F.lit(0)).cast("long").alias("nulos_timestamp"),
        (total - F.count_if(no_null)).cast("long").alias("duplicados"),
    )


def weather_null_profile(weather: DataFrame) -> DataFrame:
    """Rows and NULLs per weather column."""
    return weather.agg(
        F.count(F.lit(1)).alias("total_registros"),
        F.count_if(F.col("temperatura_promedio").isNull()).cast("long").alias("nulos_temperatura"),
        F.count_if(F.col("condicion").isNull()).cast("long").alias("nulos_condicion"),
        F.count_if(F.col("fecha").isNull()).cast("long").alias("nulos_fecha"),
    )


def key_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct text keys and distinct rows of some columns, from one
    grouping of the rows and one of the groups (no Expand)."""
    keys = row_counts(df, cols).groupBy(composite_key(*cols).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    return keys.agg(F.count("_key").alias("claves_concat"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("claves_struct"))


def dataset_profile(raw: DataFrame) -> DataFrame:
    """The profile script's facts in one row (rows, columns, NULLs per
    column, speed min/max, negatives, distinct routes and buses, time range,
    exact duplicates). Computed from one row-count aggregation."""
    cols = list(C.PING_COLUMNS)
    g = row_counts(raw, cols)
    n = F.col("n")
    counted = {"filas": F.sum(n)} | {f"nulos_{c}": F.sum(F.when(F.col(c).isNull(), n)) for c in cols} | {
        "velocidades_negativas": F.sum(F.when(F.col(C.SPEED) < 0, n)), "_rows": F.count(F.lit(1))}
    row = distinct_and_folds(
        g, {"rutas_unicas": C.ROUTE, "buses_unicos": C.BUS},
        {a: (e, "sum") for a, e in counted.items()}
        | {"velocidad_min": (F.min(C.SPEED), "min"), "velocidad_max": (F.max(C.SPEED), "max"),
           "fecha_min": (F.min(C.TS), "min"), "fecha_max": (F.max(C.TS), "max")})
    v = {a: F.coalesce(F.col(a), F.lit(0)).cast("long") for a in counted}
    return row.select(
        v["filas"].alias("filas"), F.lit(len(raw.columns)).cast("long").alias("columnas"),
        *[v[f"nulos_{c}"].alias(f"nulos_{c}") for c in cols], "velocidad_min", "velocidad_max",
        v["velocidades_negativas"].alias("velocidades_negativas"), "rutas_unicas", "buses_unicos",
        "fecha_min", "fecha_max", (v["filas"] - v["_rows"]).alias("duplicados_exactos"))


def value_list(df: DataFrame, column: str) -> DataFrame:
    """The values of a column with their rows, in order."""
    return df.groupBy(F.col(column).alias("valor")).agg(F.count(F.lit(1)).alias("filas")).orderBy("valor")


def column_types(df: DataFrame) -> DataFrame:
    """V12's dtypes: position, name, type and number of non-null values of
    every column, in one pass."""
    fields = df.schema.fields
    row = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
    args = [x for i, f in enumerate(fields) for x in (F.lit(i + 1).cast("long"), F.lit(f.name),
                                                      F.lit(f.dataType.simpleString()), F.col(f"c{i}"))]
    return row.select(F.stack(F.lit(len(fields)), *args)).toDF("posicion", "columna", "tipo", "no_nulos")


def weather_profile(weather: DataFrame) -> DataFrame:
    """Rows, first row (earliest date), NULL temperatures, distinct
    conditions, first and last date."""
    first = F.min_by(F.struct("fecha", "condicion", "temperatura_promedio"), F.col("fecha"))
    return weather.agg(
        F.count(F.lit(1)).alias("registros"),
        first.alias("primer"),
        F.count_if(F.col("temperatura_promedio").isNull()).cast("long").alias("temperaturas_nulas"),
        F.countDistinct("condicion").alias("condiciones"),
        F.min("fecha").alias("fecha_min"),
        F.max("fecha").alias("fecha_max"),
    ).select("registros", F.col("primer.fecha").alias("primer_fecha"),
             F.col("primer.condicion").alias("primer_condicion"),
             F.col("primer.temperatura_promedio").alias("primer_temperatura"),
             "temperaturas_nulas", "condiciones", "fecha_min", "fecha_max")


def expect_rows(df: DataFrame, expected: int, name: str) -> DataFrame:
    """One row comparing the row count with the expected number."""
    return df.agg(F.count(F.lit(1)).alias("actual")).select(
        F.lit(name).alias("comprobacion"), F.lit(expected).cast("long").alias("esperado"),
        F.col("actual"),
        F.when(F.col("actual") == expected, F.lit("OK")).otherwise(F.lit("ERROR")).alias("estado"))


# ---------------------------------------------------------- data-quality views

def dq_duplicates(positions: DataFrame, bus: str = "bus_id", route: str = "ruta",
                  ts: str = "ingest_timestamp") -> DataFrame:
    """Same bus, route and minute more than once."""
    return (positions.groupBy(F.col(bus).alias("bus_id"), F.col(route).alias("ruta"),
                              F.date_trunc("minute", ts).alias("minuto"))
            .agg(F.count(F.lit(1)).alias("apariciones"))
            .where(F.col("apariciones") > 1))


def dq_anomalous_speed(positions: DataFrame, col: str = "velocidad_kmh",
                       bounds: Bounds = DEFAULT_BOUNDS) -> DataFrame:
    """Speeds outside the range that slipped into the table."""
    return positions.where((F.col(col) < bounds.speed_min) | (F.col(col) > bounds.speed_max))


def dq_outside_box(positions: DataFrame, lat: str = "latitud", lon: str = "longitud",
                   bounds: Bounds = DEFAULT_BOUNDS) -> DataFrame:
    """Positions outside the box (NOT BETWEEN ... OR NOT BETWEEN ...)."""
    b = bounds
    return positions.where(~F.col(lat).between(b.lat_min, b.lat_max)
                           | ~F.col(lon).between(b.lon_min, b.lon_max))


def load_snapshot(raw: DataFrame, loaded: DataFrame, proceso: str = "batch_gps",
                  tipo: str = "BATCH", evento: str = "calidad", estado: str = "EXITOSO",
                  mensaje: str = "leidos vs cargados + nulos", with_time: bool = True) -> DataFrame:
    """Read-vs-loaded row counts plus NULL speeds and latitudes, as one
    process-log row (append it with ``sinks.append_rows``)."""
    r = raw.agg(F.count(F.lit(1)).alias("registros_leidos"),
                (F.count_if(F.col(C.SPEED).isNull()) + F.count_if(F.col(C.LAT).isNull()))
                .cast("long").alias("nulos"))
    l_ = loaded.agg(F.count(F.lit(1)).alias("registros_cargados"))
    out = r.crossJoin(l_).select(
        F.lit(proceso).alias("proceso"), F.lit(tipo).alias("tipo"), F.lit(evento).alias("evento"),
        F.lit(estado).alias("estado"), "registros_leidos", "registros_cargados", "nulos",
        F.lit(mensaje).alias("mensaje"))
    if with_time:
        out = out.withColumn("timestamp", F.current_timestamp())
    return out
