from pyspark.sql import functions as F

from conftest import PING_DDL, ping
from fleetlake import config as C
from fleetlake.operators import quality
from fleetlake.operators.dedup import split_duplicates


def test_split_range_null_policies(spark):
    vals = [-0.04, -0.05, -0.1, 0.0, 120.0, 120.04, 120.1, 999.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    ok, bad = quality.split_range(df, "x", 0, 120)          # pandas mask: NULL/NaN valid
    assert ok.count() + bad.count() == df.count()
    assert sorted(r.x for r in bad.collect()) == [-0.1, -0.05, -0.04, 120.04, 120.1, 999.0]
    ok2, bad2 = quality.split_range(df, "x", 0, 120, nulls="drop")  # warehouse: NULL/NaN invalid
    assert ok2.count() == 2 and bad2.count() == 8


def test_split_bbox_edges(spark):
    b = C.DEFAULT_BOUNDS
    rows = [(b.lat_min, b.lon_min), (b.lat_max, b.lon_max), (b.lat_min - 0.01, -70.6), (-33.4, b.lon_max + 0.01),
            (None, -70.6)]
    df = spark.createDataFrame(rows, "Latitud double, Longitud double")
    ok, bad = quality.split_bbox(df)
    assert ok.count() == 3 and bad.count() == 2
    v = quality.filter_valid(df.withColumn(C.SPEED, F.lit(10.0)))
    assert v.count() == 2   # NULL latitude rejected by BETWEEN


def test_exact_duplicates_keep_first_and_evidence(spark):
    rows = [ping()] * 3 + [ping(route="210E")] + [ping(ts="2024-01-05 10:00:30")]
    df = spark.createDataFrame(rows, PING_DDL)
    kept, surplus = split_duplicates(df)
    assert kept.count() == 3 and surplus.count() == 2
    ev = quality.invalid_evidence(df)
    assert sorted(r.rn for r in ev.collect()) == [2, 3]


def test_keyed_duplicates_keep_earliest(spark):
    rows = [ping(ts="2024-01-05 10:00:40"), ping(ts="2024-01-05 10:00:10"), ping(ts="2024-01-05 10:00:10"),
            ping(bus="BUS_2", ts="2024-01-05 10:00:50")]
    df = spark.createDataFrame(rows, PING_DDL).withColumn("m", F.date_trunc("minute", "Timestamp"))
    kept, surplus = split_duplicates(df, ["ID_Bus", "m"], ["Timestamp"])
    k = {r.ID_Bus: r.Timestamp.second for r in kept.collect()}
    assert k == {"BUS_1": 10, "BUS_2": 50}
    assert surplus.count() == 2


def test_raw_profile_null_rule(spark):
    rows = [ping(), ping(), ping(speed=-5.0), ping(lat=-40.0), ping(speed=None), ping(speed=None)]
    df = spark.createDataFrame(rows, PING_DDL)
    r = quality.raw_profile(df).first()
    assert r.total_registros == 6
    assert r.velocidades_invalidas == 1
    assert r.registros_con_duplicados == 2      # the identical pair and the NULL pair
    # a row with a NULL part never counts as distinct: 6 - 3 distinct complete rows
    assert r.total_duplicados == 3
    assert r.coordenadas_fuera_rango == 1


def test_profiles_on_empty_input(spark):
    df = spark.createDataFrame([], PING_DDL)
    r = quality.raw_profile(df).first()
    assert r.total_registros == 0 and r.total_duplicados == 0
    rep = quality.local_validation_report(df).collect()
    assert [x.registros_invalidos for x in rep] == [0, 0, 0]


def test_local_report_is_sequential(spark):
    rows = [ping(), ping(), ping(speed=-1.0, lat=-40.0), ping(lat=-40.0)]
    rep = {r.regla: r.registros_invalidos
           for r in quality.local_validation_report(spark.createDataFrame(rows, PING_DDL)).collect()}
    assert rep == {C.RULE_DUPLICATES: 1, C.RULE_SPEED: 1, C.RULE_COORDS: 1}


def test_date_format_split(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00",), ("2024-13-05 10:00:00",), ("2024/01/05 10:00:00",),
                                (None,)], "t string")
    ok, bad = quality.split_date_format(df, "t")
    assert ok.count() == 1 and bad.count() == 3


def test_dq_views(spark):
    pos = spark.createDataFrame(
        [("B1", "210", 10.0, -33.4, -70.6, "2024-01-05 10:00:01"), ("B1", "210", 12.0, -33.4, -70.6,
                                                                   "2024-01-05 10:00:59"),
         ("B2", "210", 130.0, -34.0, -70.6, "2024-01-05 10:00:01")],
        "bus_id string, ruta string, velocidad_kmh double, latitud double, longitud double, ingest_timestamp string"
    ).withColumn("ingest_timestamp", F.to_timestamp("ingest_timestamp"))
    assert quality.dq_duplicates(pos).first().apariciones == 2
    assert quality.dq_anomalous_speed(pos).count() == 1
    assert quality.dq_outside_box(pos).count() == 1


def test_expect_rows(spark):
    df = spark.range(3)
    assert quality.expect_rows(df, 3, "x").first().estado == "OK"
    assert quality.expect_rows(df, 4, "x").first().estado == "ERROR"
