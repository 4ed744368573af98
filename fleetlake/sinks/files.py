"""Sinks: CSV/JSON exports, replaced tables and views, create-if-absent
tables with NOT NULL checks, appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, only_if_rows: bool = False) -> bool:
    """K1: overwrite a CSV folder with a header. ``only_if_rows``: skip the
    write when the frame is empty (evidence files), checked with a one-row
    probe rather than a full count."""
    if only_if_rows and not df.take(1):
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def write_json_records(agg: DataFrame, detail: DataFrame, path: str) -> bool:
    """K2: JSON export of the aggregate, only if it has no more rows than
    the detail. Both counts come from one job each; the output is one JSON
    object per line (the array form is not reproduced)."""
    if agg.count() > detail.count():
        return False
    agg.write.mode("overwrite").json(path)
    return True


def replace_table(df: DataFrame, name: str, path: str | None = None, partition_by: list[str] | None = None,
                  bucket_by: tuple[int, list[str]] | None = None) -> None:
    """K3: CREATE OR REPLACE TABLE ... AS (idempotent overwrite).
    ``bucket_by=(n, cols)`` stores the table bucketed so later joins and
    aggregations on ``cols`` need no shuffle."""
    w = df.write.mode("overwrite").format("parquet")
    if path:
        w = w.option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        n, cols = bucket_by
        w = w.bucketBy(n, *cols).sortBy(*cols)
    w.saveAsTable(name)


def replace_view(df: DataFrame, name: str) -> None:
    """K4: CREATE OR REPLACE (temporary) VIEW."""
    df.createOrReplaceTempView(name)


def create_quality_views(spark: SparkSession, table: str, prefix: str = "") -> list[str]:
    """K4: the live aggregate and the three quality views over a stored
    positions table, as catalog views (CREATE OR REPLACE VIEW). They hold a
    query, not rows, so they follow what is appended. Returns their names."""
    from ..config import DEFAULT_BOUNDS as b
    body = {
        # mean, least and greatest speed on the decimal text, as round_half_up
        "analytics_congestion_stream": f"""
            SELECT ruta, hora, nivel_congestion, clima_condicion, COUNT(*) AS total_pings,
              COUNT(DISTINCT bus_id) AS buses_unicos,
              CAST(ROUND(CAST(AVG(velocidad_kmh) AS DECIMAL(38,6)), 2) AS DOUBLE) AS velocidad_promedio,
              CAST(ROUND(CAST(MIN(velocidad_kmh) AS DECIMAL(38,6)), 2) AS DOUBLE) AS velocidad_min,
              CAST(ROUND(CAST(MAX(velocidad_kmh) AS DECIMAL(38,6)), 2) AS DOUBLE) AS velocidad_max
            FROM {table} GROUP BY ruta, hora, nivel_congestion, clima_condicion""",
        "v_dq_duplicados": f"""
            SELECT bus_id, ruta, date_trunc('MINUTE', ingest_timestamp) AS minuto, COUNT(*) AS apariciones
            FROM {table} GROUP BY bus_id, ruta, date_trunc('MINUTE', ingest_timestamp) HAVING COUNT(*) > 1""",
        "v_dq_velocidad_anomala":
            f"SELECT * FROM {table} WHERE NOT velocidad_kmh BETWEEN {b.speed_min}D AND {b.speed_max}D",
        "v_dq_fuera_santiago":
            f"SELECT * FROM {table} WHERE NOT (latitud BETWEEN {b.lat_min}D AND {b.lat_max}D "
            f"AND longitud BETWEEN {b.lon_min}D AND {b.lon_max}D)",
    }
    for name, query in body.items():
        spark.sql(f"CREATE OR REPLACE VIEW {prefix}{name} AS {query}")
    return [prefix + name for name in body]


def create_table_if_absent(spark: SparkSession, name: str, schema: str, location: str | None = None) -> None:
    """K5: CREATE TABLE IF NOT EXISTS (parquet). NOT NULL columns are
    enforced on write by :func:`check_not_null`."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet{loc}")


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fail the write if any required column is NULL (``raise_error`` is
    evaluated per row inside the write job, no extra pass)."""
    bad = None
    for c in cols:
        cond = F.col(c).isNull()
        bad = cond if bad is None else bad | cond
    if bad is None:
        return df
    guard = F.coalesce(F.when(bad, F.raise_error(F.lit(f"NOT NULL violated in {cols}"))).cast("boolean"),
                       F.lit(True))
    return df.where(guard)


def append_rows(df: DataFrame, name: str | None = None, path: str | None = None) -> None:
    """K6: INSERT INTO ... SELECT (append)."""
    if name:
        df.write.mode("append").insertInto(name)
    else:
        df.write.mode("append").parquet(path)
