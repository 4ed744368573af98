"""End-to-end batch runs: every stage writes its table, the next stage reads
the written table (lineage is cut at each boundary, so a lost executor
recomputes at most one stage), every stage is logged, and the run is
recorded in the run registry.

Outputs go under ``base`` (a shared folder: HDFS/S3/GCS on a cluster).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..operators import audit
from ..operators.aggregate import post_clean_stats, route_hour
from ..operators.quality import invalid_evidence, load_snapshot, raw_profile
from ..sinks.files import write_csv, write_json_records
from . import local, warehouse


#: Name under which the runs are logged and registered.
PROCESS = "limpieza"


def _p(base: str, *parts: str) -> str:
    return os.path.join(base, *parts)


def run_warehouse_batch(spark: SparkSession, pings: DataFrame, weather: DataFrame, base: str) -> dict:
    """Raw profile -> invalid evidence -> enriched table -> post-clean
    stats -> route-hour table -> read-vs-loaded snapshot. Returns the small
    one-row results (profile, stats, snapshot) as dicts."""
    log = _p(base, "proceso_log")
    raw_path = _p(base, "gps_raw")
    with audit.stage(spark, "carga_raw", path=log):
        pings.write.mode("overwrite").parquet(raw_path)
    raw = spark.read.parquet(raw_path)
    with audit.stage(spark, "analisis_raw", path=log):
        profile = raw_profile(raw).first().asDict()
    with audit.stage(spark, "registros_invalidos", path=log):
        invalid_evidence(raw).write.mode("overwrite").parquet(_p(base, "registros_invalidos"))
    with audit.stage(spark, "datos_enriquecidos", path=log):
        warehouse.clean_enriched(raw, weather).write.mode("overwrite").parquet(_p(base, "datos_enriquecidos"))
    enriched = spark.read.parquet(_p(base, "datos_enriquecidos"))
    with audit.stage(spark, "estadisticas", path=log):
        stats = post_clean_stats(enriched).first().asDict()
    with audit.stage(spark, "datos_agregados", path=log):
        route_hour(enriched).write.mode("overwrite").parquet(_p(base, "datos_agregados"))
    snap = load_snapshot(raw, enriched)
    snap.write.mode("append").parquet(log + "_calidad")
    audit.record_run(spark, PROCESS, "EXITOSO",
                     f"Enriquecido: {stats['total_registros']}", stats["total_registros"],
                     path=_p(base, "ejecuciones"))
    return {"perfil": profile, "estadisticas": stats,
            "snapshot": snap.drop("timestamp").first().asDict()}


def run_local_batch(spark: SparkSession, pings: DataFrame, weather: DataFrame, base: str) -> dict:
    """Evidence CSVs in staging (only when non-empty), enriched detail
    and route-hour aggregate as CSV in curated, the aggregate also as JSON
    records when it is not larger than the detail."""
    log = _p(base, "proceso_log")
    st = local.stages(pings, weather)
    written = {}
    with audit.stage(spark, PROCESS, path=log):
        written["duplicados"] = write_csv(st["duplicados"], _p(base, "staging", "duplicados_eliminados"),
                                          only_if_rows=True)
        written["velocidades"] = write_csv(st["velocidades_invalidas"],
                                           _p(base, "staging", "velocidades_invalidas"), only_if_rows=True)
        detail_path = _p(base, "curated", "datos_enriquecidos")
        st["enriquecido"].write.mode("overwrite").parquet(detail_path + "_parquet")
        detail = spark.read.parquet(detail_path + "_parquet")
        write_csv(detail, detail_path)
        agg = route_hour(detail, count_rows=False, drop_null_keys=True)
        agg.write.mode("overwrite").parquet(_p(base, "curated", "agregado_parquet"))
        agg = spark.read.parquet(_p(base, "curated", "agregado_parquet"))
        write_csv(agg, _p(base, "curated", "datos_agregados_ruta_hora"))
        written["json"] = write_json_records(agg, detail, _p(base, "curated", "datos_agregados_json"))
    audit.record_run(spark, PROCESS, "EXITOSO", "", detail.count(), path=_p(base, "ejecuciones"))
    return written


__all__ = ["run_warehouse_batch", "run_local_batch"]
