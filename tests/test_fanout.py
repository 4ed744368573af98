import glob
import json
import os

import pytest

from fleetlake.streaming import ingest


def test_fanout_sinks_and_concurrent_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        for i in range(12):
            e = {"bus_id": f"BUS_{i % 3}", "ruta": "502c", "velocidad_kmh": str(5 * i), "latitud": "-33.45",
                 "longitud": "-70.66", "ts": f"2024-01-05 10:{i:02d}:00"}
            f.write(json.dumps(e) + "\n")
        f.write(json.dumps({"bus_id": "BUS_9", "ruta": "210", "velocidad_kmh": "999", "latitud": "-33.45",
                            "longitud": "-70.66", "ts": "2024-01-05 10:00:00"}) + "\n")
    base = os.path.join(tmpdir_path, "out")
    pos, rej = ingest.positions_stream(ingest.read_ping_events(spark, src))

    def batch():
        return spark.range(10).count()

    n = ingest.run_concurrently(spark, lambda: ingest.start_fanout(pos, rej, base), batch, timeout_s=300)
    assert n == 10
    lake = spark.read.json(os.path.join(base, "lake"))
    table = spark.read.parquet(os.path.join(base, "table"))
    assert lake.count() == 12 and table.count() == 12
    assert glob.glob(os.path.join(base, "lake", "batch_id=*", "day=20240105"))
    rejected = spark.read.parquet(os.path.join(base, "rejected")).collect()
    assert [r.description for r in rejected] == ["validacion: velocidad fuera de rango (999.0)"]


def test_a_failed_sink_retries_and_others_go_on(spark, tmpdir_path):
    src, base = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps({"bus_id": "BUS_1", "ruta": "210", "velocidad_kmh": "20", "latitud": "-33.45",
                            "longitud": "-70.66", "ts": "2024-01-05 10:00:00"}) + "\n")
    os.makedirs(base)
    block = os.path.join(base, "table")
    open(block, "w").close()               # a file where the table's folder belongs

    def start():
        return ingest.start_fanout(*ingest.positions_stream(ingest.read_ping_events(spark, src)), base)

    with pytest.raises(Exception):
        ingest.run_available(start())
    assert spark.read.json(os.path.join(base, "lake")).count() == 1
    log = spark.read.parquet(os.path.join(base, "activity_log")).collect()
    assert [(r.event_type, r.status) for r in log] == [("sink_error", "WARN")] and log[0].description.startswith("table: ")
    os.remove(block)
    ingest.run_available(start())          # the batch was not lost
    assert spark.read.parquet(os.path.join(base, "table")).count() == 1
    assert spark.read.json(os.path.join(base, "lake")).count() == 1


def test_observed_counters_and_start_stop_log(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        for i in range(6):   # two buses, three pings each in the same minute
            f.write(json.dumps({"bus_id": f"BUS_{i % 2}", "ruta": "210", "velocidad_kmh": "20",
                                "latitud": "-33.45", "longitud": "-70.66",
                                "ts": f"2024-01-05 10:00:{i:02d}"}) + "\n")
    pos, _ = ingest.positions_stream(ingest.read_ping_events(spark, src))
    log = os.path.join(tmpdir_path, "log")
    out = os.path.join(tmpdir_path, "out")
    q = ingest.start_logged(spark, lambda: pos.writeStream.format("parquet").option("path", out)
                            .option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
                            .trigger(availableNow=True).start(), log)
    q.awaitTermination(120)
    c = [x for x in ingest.batch_counters(q) if x["validos"]]
    assert c and c[0]["validos"] == 6 and c[0]["aceptados"] == 2 and c[0]["duplicados"] == 4
    ingest.stop_logged(spark, q, log)
    types = sorted(r.event_type for r in spark.read.parquet(log).collect())
    assert types == ["stream_start", "stream_stop"]


def test_default_weather_fallback(spark):
    from fleetlake.streaming import live
    ev = spark.createDataFrame([("BUS_1", "210", 20.0, -33.45, -70.66)],
                               "bus_id string, ruta string, velocidad_kmh double, latitud double, longitud double") \
        .selectExpr("*", "timestamp'2024-01-05 10:00:00' AS ts")
    pos = live.enrich_positions(live.normalise_events(ev).drop("reason"), None,
                                default_weather=("Despejado", 14.0)).first()
    assert pos.clima_condicion == "Despejado" and pos.clima_temperatura == 14.0


def test_streaming_live_view_matches_batch(spark):
    import __spark_entry__ as E
    sf = "/root/testdata/sf0.001"
    s = {(r.ruta, r.hora, r.nivel_congestion, r.clima_condicion): r
         for r in E.queries()["a4_live_view_stream"](spark, sf).collect()}
    b = {(r.ruta, r.hora, r.nivel_congestion, r.clima_condicion): r
         for r in E.queries()["a4_live_view"](spark, sf).collect()}
    assert s.keys() == b.keys()
    for k in b:
        assert s[k].total_pings == b[k].total_pings
        assert s[k].velocidad_promedio == b[k].velocidad_promedio
        assert abs(s[k].buses_unicos - b[k].buses_unicos) <= max(1, 0.05 * b[k].buses_unicos)


def test_table_sink_enforces_required_columns(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps({"bus_id": "BUS_1", "ruta": "210", "velocidad_kmh": "20", "latitud": "-33.45",
                            "longitud": "-70.66", "ts": "2024-01-05 10:00:00"}) + "\n")
    pos, _ = ingest.positions_stream(ingest.read_ping_events(spark, src))
    q = ingest.start_table_sink(pos, os.path.join(tmpdir_path, "table"), name="tbl_ok")
    ingest.run_available(q, 120)
    assert spark.read.parquet(os.path.join(tmpdir_path, "table")).count() == 1
