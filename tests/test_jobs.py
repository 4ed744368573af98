import os

import __spark_entry__ as E  # noqa: F401  (puts the repo on the path)
from fleetlake.plans import jobs
from fleetlake.sources import testdata as td

SF = "/root/testdata/sf0.001"


def test_warehouse_batch_run(spark, tmpdir_path):
    out = jobs.run_warehouse_batch(spark, td.pings(spark, SF), td.weather(spark, SF), tmpdir_path)
    assert out["perfil"]["total_registros"] == out["snapshot"]["registros_leidos"]
    assert out["estadisticas"]["total_registros"] == out["snapshot"]["registros_cargados"]
    agg = spark.read.parquet(os.path.join(tmpdir_path, "datos_agregados"))
    assert agg.groupBy().sum("Total_Registros").first()[0] == out["estadisticas"]["total_registros"]
    states = [r.estado for r in spark.read.parquet(os.path.join(tmpdir_path, "proceso_log")).collect()]
    assert states.count("INICIO") == states.count("FIN") == 6
    assert spark.read.parquet(os.path.join(tmpdir_path, "ejecuciones")).count() == 1


def test_local_batch_run(spark, tmpdir_path):
    written = jobs.run_local_batch(spark, td.pings(spark, SF), td.weather(spark, SF), tmpdir_path)
    assert written["duplicados"] and written["velocidades"] and written["json"]
    csv = spark.read.option("header", True).csv(os.path.join(tmpdir_path, "curated", "datos_agregados_ruta_hora"))
    assert csv.count() > 0 and "Velocidad_Promedio" in csv.columns
