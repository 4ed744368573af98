import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from fleetlake.streaming import ingest, live

EV = "bus_id string, ruta string, velocidad_kmh string, latitud string, longitud string, ts timestamp"
T0 = dt.datetime(2024, 1, 5, 10, 0, 5)


def _events(spark, rows):
    return spark.createDataFrame(rows, EV)


def test_documented_requests(spark):
    rows = [("BUS_1040", "502c", "12", "-33.45", "-70.66", T0),
            ("BUS_999", "104", "999", "-33.45", "-70.66", T0),
            ("BUS_1001", "210", "40", "-33.45", "-70.66", T0),
            ("BUS_1001", "210", "40", "-33.45", "-70.66", T0 + dt.timedelta(seconds=20))]
    pos, out = live.process_batch(_events(spark, rows))
    o = sorted((r.bus_id, r.outcome, r.reason) for r in out.collect())
    assert ("BUS_1040", "aceptado", "ok") in o
    assert ("BUS_999", "rechazado_validacion", "velocidad fuera de rango (999.0)") in o
    assert ("BUS_1001", "rechazado_duplicado", "duplicado (mismo bus, mismo minuto)") in o
    p = {r.bus_id: r for r in pos.collect()}
    assert p["BUS_1040"].ruta == "502C" and p["BUS_1040"].ruta_raw == "502c"
    assert p["BUS_1040"].nivel_congestion == "Congestionado"
    assert p["BUS_1001"].ingest_timestamp == T0


def test_event_edge_cases(spark):
    rows = [(None, "210", "12", "-33.45", "-70.66", T0), ("BUS_1", " ", "12", "-33.45", "-70.66", T0),
            ("BUS_2", "210", "x", "-33.45", "-70.66", T0), ("BUS_3", "210", "12", None, "-70.66", T0),
            ("BUS_4", "210", "NaN", "-33.45", "-70.66", T0), (" bus_5 ", " 210e ", "-0.04", "-33.45", "-70.66", T0),
            ("BUS_6", "210", "12", "-34.0", "-70.66", T0)]
    n = {r.bus_id: r.reason for r in live.normalise_events(_events(spark, rows)).collect()}
    assert n[None] == "bus_id y ruta son obligatorios"
    assert n["BUS_1"] == "bus_id y ruta son obligatorios"
    assert n["BUS_2"] == "velocidad_kmh, latitud y longitud deben ser numéricos"
    assert n["BUS_3"] == "velocidad_kmh, latitud y longitud deben ser numéricos"
    assert n["BUS_4"] == "velocidad fuera de rango (nan)"
    assert n["BUS_5"] is None           # -0.04 rounds to -0.0 and passes
    assert n["BUS_6"] == "latitud fuera de Santiago (-34.0)"


def test_stream_equals_batch_twin_and_restarts(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)

    def put(name, evs):
        with open(os.path.join(src, name), "w") as f:
            for e in evs:
                f.write(json.dumps(e) + "\n")

    base = [{"bus_id": f"BUS_{i % 5}", "ruta": "210", "velocidad_kmh": str(10 + i), "latitud": "-33.45",
             "longitud": "-70.66", "ts": f"2024-01-05 10:{i // 3:02d}:{(i * 7) % 60:02d}"} for i in range(30)]
    put("a.json", base[:20])
    out = os.path.join(tmpdir_path, "out")
    ck = os.path.join(tmpdir_path, "ck")

    def run():
        evs = ingest.read_ping_events(spark, src)
        pos, _ = ingest.positions_stream(evs)
        q = (pos.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        ingest.run_available(q, 300)

    run()
    first = spark.read.parquet(out).count()
    # second batch: new events plus a late duplicate of an accepted key
    put("b.json", base[20:] + [dict(base[0], velocidad_kmh="99")])
    run()                               # restart from the checkpoint
    streamed = spark.read.parquet(out)
    batch_events = spark.read.schema(ingest.PING_EVENT_SCHEMA).json(src) \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    twin, _ = live.process_batch(batch_events)
    assert first > 0
    assert streamed.count() == twin.count()
    key = ["bus_id", F.date_trunc("minute", "ingest_timestamp")]
    assert streamed.groupBy(*key).count().where("count > 1").count() == 0


def test_outcome_stream_keeps_duplicates_across_batches(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)

    def put(name, evs):
        with open(os.path.join(src, name), "w") as f:
            for e in evs:
                f.write(json.dumps(e) + "\n")

    def ev(bus, sec, speed="20"):
        return {"bus_id": bus, "ruta": "210", "velocidad_kmh": speed, "latitud": "-33.45", "longitud": "-70.66",
                "ts": f"2024-01-05 10:00:{sec:02d}"}

    put("a.json", [ev("B1", 30), ev("B1", 10), ev("B2", 5), ev("B3", 1, speed="999")])
    out = os.path.join(tmpdir_path, "out")

    def run():
        ingest.run_available(ingest.start_outcomes(ingest.read_ping_events(spark, src), out))

    run()
    put("b.json", [ev("B2", 50)])       # same bus and minute, later batch -> duplicate row
    run()
    rows = spark.read.parquet(f"{out}/outcomes").collect()
    got = sorted((r.bus_id, r.ts.second, r.outcome) for r in rows if r.outcome != "rechazado_validacion")
    assert got == [("B1", 10, "aceptado"), ("B1", 30, "rechazado_duplicado"),
                   ("B2", 5, "aceptado"), ("B2", 50, "rechazado_duplicado")]
    assert [r.reason for r in rows if r.outcome == "rechazado_validacion"] == ["velocidad fuera de rango (999.0)"]


def test_late_events_have_an_outcome_and_weather_is_read_per_batch(spark, tmpdir_path):
    src, out = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "out")
    os.makedirs(src)
    wet = os.path.join(tmpdir_path, "weather")

    def put(name, evs):
        with open(os.path.join(src, name), "w") as f:
            for bus, t, speed in evs:
                f.write(json.dumps({"bus_id": bus, "ruta": "210", "velocidad_kmh": speed, "latitud": "-33.45",
                                    "longitud": "-70.66", "ts": f"2024-01-05 {t}"}) + "\n")

    def rain(day):
        spark.createDataFrame([(dt.date(2024, 1, day), "Lluvia", 9.0)],
                              "fecha date, condicion string, temperatura_promedio double") \
            .write.mode("append").parquet(wet)

    def run():
        ingest.run_available(ingest.start_outcomes(ingest.read_ping_events(spark, src), out,
                                                   weather=lambda s: s.read.parquet(wet)))

    rain(4)
    put("a.json", [("B1", "10:30:00", "20"), ("B1", "10:30:09", "21"), ("B2", "10:00:00", "x"), ("", "10:00:00", "5")])
    run()
    assert [r.clima_condicion for r in spark.read.parquet(f"{out}/positions").collect()] == [None]
    rain(5)                               # a day added while the stream is in use
    put("b.json", [("B1", "10:05:00", "20"),       # 25 minutes late, its minute unclaimed: accepted
                   ("B1", "10:30:40", "20"),       # claimed in the first batch: duplicate
                   ("B3", "10:06:00", "999")])     # late and invalid
    run()
    rows = spark.read.parquet(f"{out}/outcomes").collect()
    assert len(rows) == 7                 # one outcome per event
    got = sorted((r.bus_id, r.ts.strftime("%H:%M:%S"), r.outcome) for r in rows)
    assert ("B1", "10:05:00", "aceptado") in got and ("B1", "10:30:40", "rechazado_duplicado") in got
    late = spark.read.parquet(f"{out}/positions").where("batch_id = 1").collect()
    assert [(r.bus_id, r.clima_condicion) for r in late] == [("B1", "Lluvia")]
    log = sorted((r.event_type, r.description) for r in spark.read.parquet(f"{out}/activity_log").collect())
    assert [d for k, d in log if k == "posicion_duplicada"] == ["B1 en 2024-01-05T10:30"] * 2
    texts = [d for k, d in log if k == "posicion_rechazada"]
    assert "normalizacion: bus_id y ruta son obligatorios" in texts
    assert "normalizacion: velocidad_kmh, latitud y longitud deben ser numéricos" in texts
    assert "validacion: velocidad fuera de rango (999.0)" in texts
    # a repeated batch gives the same rows
    batch = spark.read.schema(ingest.PING_EVENT_SCHEMA).json(os.path.join(src, "b.json"))
    before = sorted(map(str, spark.read.parquet(f"{out}/outcomes/batch_id=1").collect()))
    ingest.judge_batch(batch, 1, out, weather=lambda s: s.read.parquet(wet))
    assert sorted(map(str, spark.read.parquet(f"{out}/outcomes/batch_id=1").collect())) == before


def test_a_reached_limit_raises(spark):
    class Slow:
        stopped = False

        def awaitTermination(self, t=None):
            return False

        def stop(self):
            self.stopped = True

    q = Slow()
    with pytest.raises(TimeoutError):
        ingest.run_available(q, 0.1)
    assert q.stopped


def test_late_events_of_the_watermarked_stream_are_counted(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)

    def put(name, times):
        with open(os.path.join(src, name), "w") as f:
            for t in times:
                f.write(json.dumps({"bus_id": "B1", "ruta": "210", "velocidad_kmh": "20", "latitud": "-33.45",
                                    "longitud": "-70.66", "ts": f"2024-01-05 {t}"}) + "\n")

    def run():
        pos, _ = ingest.positions_stream(ingest.read_ping_events(spark, src))
        q = (pos.writeStream.format("noop").option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
             .trigger(availableNow=True).start())
        ingest.run_available(q)
        return ingest.batch_counters(q)

    put("a.json", ["10:30:00", "10:30:20"])
    run()
    put("b.json", ["10:05:00", "10:40:00"])
    c = [x for x in run() if x["validos"]]
    assert [(x["validos"], x["aceptados"], x["tardios"], x["duplicados"]) for x in c] == [(2, 1, 1, 0)]


def test_dedup_state_is_evicted_by_the_watermark(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)

    def put(name, evs):
        with open(os.path.join(src, name), "w") as f:
            for e in evs:
                f.write(json.dumps(e) + "\n")

    def ev(bus, hh, mm):
        return {"bus_id": bus, "ruta": "210", "velocidad_kmh": "20", "latitud": "-33.45", "longitud": "-70.66",
                "ts": f"2024-01-05 {hh:02d}:{mm:02d}:00"}

    ck = os.path.join(tmpdir_path, "ck")

    def run():
        pos, _ = ingest.positions_stream(ingest.read_ping_events(spark, src), observe=False)
        q = (pos.writeStream.format("noop").option("checkpointLocation", ck)
             .trigger(availableNow=True).start())
        ingest.run_available(q, 300)
        return [p for p in q.recentProgress if p.stateOperators]

    put("a.json", [ev(f"B{i}", 10, i) for i in range(20)])      # 20 keys in minutes 10:00-10:19
    first = run()
    # after the data batch the watermark is 10:17; the closing no-data batch
    # evicts every key whose minute is more than the delay behind it
    assert first[-1].stateOperators[0].numRowsTotal <= 5
    put("b.json", [ev("B0", 12, 0)])                              # watermark moves to 11:58
    second = run()
    # every earlier key is now below the watermark: the state holds only the new key
    assert second[-1].stateOperators[0].numRowsTotal <= 1


def test_reason_values_print_like_python_repr(spark):
    vals = [999.0, -5.0, 120.1, 12345678.9, 1e7, 99999999.0, -1e8, 1.5e15, 1e16, 2.5e20, 0.0001, 0.00015,
            -0.0002, 1.5e-05, 1e-07, 123.45, 0.001, float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = {repr(r.x): r.t for r in df.select("x", live.python_text(F.col("x")).alias("t")).collect()}
    assert got == {repr(v): repr(v) for v in vals}
