"""One test per row of the SURVEY 2.13 disagreement table not covered elsewhere."""

import datetime as dt


from conftest import PING_DDL, ping
from fleetlake.operators.aggregate import route_hour
from fleetlake.plans import local, warehouse

W_DDL = "fecha date, condicion string, temperatura_promedio double"


def _weather(spark):
    return spark.createDataFrame([(dt.date(2024, 1, 5), "Lluvia", None), (dt.date(2024, 1, 6), "Nublado", 10.0),
                                  (dt.date(2024, 1, 7), "Despejado", 10.15)], W_DDL)


def test_case_variant_duplicates_survive_dedup(spark):
    rows = [ping(route="502c"), ping(route="502C"), ping(route="502C")]
    df = spark.createDataFrame(rows, PING_DDL)
    wh = warehouse.clean_enriched(df, _weather(spark))
    assert [r.Ruta for r in wh.collect()] == ["502C", "502C"]     # dedup before normalise: 2 rows remain
    lo = local.stages(df, _weather(spark))["enriquecido"]
    assert lo.count() == 2


def test_null_speed_and_route_policies(spark):
    rows = [ping(speed=None), ping(route=None, speed=40.0), ping(speed=120.0)]
    df = spark.createDataFrame(rows, PING_DDL)
    wh = warehouse.clean_enriched(df, _weather(spark)).collect()
    # warehouse: NULL speed rejected by BETWEEN, NULL route kept (stays NULL), 120 is Fluido
    assert sorted((r.Ruta is None, r.Nivel_Congestion) for r in wh) == [(False, "Fluido"), (True, "Fluido")]
    lo = local.stages(df, _weather(spark))["enriquecido"].collect()
    # local: NULL speed kept and classified Desconocido, 120 is outside the half-open table
    assert sorted(r.Nivel_Congestion for r in lo) == ["Desconocido", "Desconocido", "Fluido"]


def test_null_group_key_and_row_count_rules(spark):
    rows = [("210", 1, "B1", 10.0), (None, 1, "B2", 20.0), ("210", 1, None, 30.0)]
    df = spark.createDataFrame(rows, "Ruta string, Hora long, ID_Bus string, Velocidad_kmh double")
    sql = {r.Ruta: r.Total_Registros for r in route_hour(df).collect()}
    assert sql == {"210": 2, None: 1}                       # GROUP BY keeps the NULL group, COUNT(*)
    pd_like = {r.Ruta: r.Total_Registros for r in route_hour(df, count_rows=False, drop_null_keys=True).collect()}
    assert pd_like == {"210": 1}                            # groupby drops NULL keys, counts non-null ids


def test_temperature_fill_rounding_by_plan(spark):
    df = spark.createDataFrame([ping(ts="2024-01-05 10:00:00")], PING_DDL)
    wh = warehouse.clean_enriched(df, _weather(spark)).first().Clima_Temperatura
    lo = local.stages(df, _weather(spark))["enriquecido"].first().Clima_Temperatura
    assert abs(wh - 10.075) < 1e-12 and lo == 10.1
