import datetime as dt
import json
import os
import time

import pytest

from fleetlake.operators import aggregate
from fleetlake.sinks import versioned
from fleetlake.streaming import ingest, live, views

T0 = dt.datetime(2024, 1, 5, 10, 0)


def position(k, bus, route="210", hour=10, band="Moderado", weather="Despejado", speed=20.0):
    return (f"v{k}", bus, route, route, speed, -33.45, -70.66, hour, "Friday", band, weather, 14.0,
            T0 + dt.timedelta(minutes=k))


def batches():
    return [[position(0, "B1"), position(1, "B1", speed=20.05), position(2, "B2", weather=None)],
            [position(3, "B1"), position(4, "B3"), position(5, "B2", weather=None), position(6, None)],
            [],
            [position(7, "B3", hour=23), position(8, "B1", hour=None, speed=None), position(9, "B1", hour=None)],
            [position(10, "B9", hour=23, speed=119.9), position(11, "B1", hour=None)]]


def table(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_live_view_is_exact_after_every_batch_and_repeat(spark, tmpdir_path, monkeypatch):
    base, seen = os.path.join(tmpdir_path, "live"), []
    for n, rows in enumerate(batches()):
        seen += rows
        df = spark.createDataFrame(rows, ingest.POSITION_SCHEMA)
        if n in (1, 3):                       # the stream dies between the pairs and the view, and repeats
            commit = versioned.commit

            def dies(d, path, *a, **k):
                if path.endswith("view"):
                    raise RuntimeError("killed")
                return commit(d, path, *a, **k)

            monkeypatch.setattr(versioned, "commit", dies)
            with pytest.raises(RuntimeError, match="killed"):
                views.maintain_live_view(df, n, base)
            monkeypatch.setattr(versioned, "commit", commit)
        views.maintain_live_view(df, n, base)
        views.maintain_live_view(df, n, base)  # a repeated batch
        whole = aggregate.live_view(spark.createDataFrame(seen, ingest.POSITION_SCHEMA))
        assert table(views.read_live_view(spark, base).select(*whole.columns)) == table(whole)


def test_counters_of_150_micro_batches(spark, tmpdir_path):
    """More batches than Spark's progress keeps; a restart in between."""
    src, kept, ck = (os.path.join(tmpdir_path, d) for d in ("in", "kept", "ck"))
    os.makedirs(src)

    def put(lo, hi):
        for n in range(lo, hi):
            with open(os.path.join(src, f"{n:04d}.json"), "w") as f:
                for bus, speed in ((n, 20), (n, 21), (999, 999)):  # valid, duplicate, out of range
                    f.write(json.dumps({"bus_id": f"B{bus}", "ruta": "210", "velocidad_kmh": str(speed),
                                        "latitud": "-33.45", "longitud": "-70.66",
                                        "ts": "2024-01-05 10:00:00"}) + "\n")

    recorder = ingest.CounterRecorder(spark, kept, "whole_life")
    spark.streams.addListener(recorder)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        for lo, hi in ((0, 110), (110, 150)):
            put(lo, hi)
            pos, _ = ingest.positions_stream(ingest.read_ping_events(spark, src, max_files_per_trigger=1))
            q = (pos.writeStream.format("noop").queryName("whole_life").option("checkpointLocation", ck)
                 .trigger(availableNow=True).start())
            ingest.run_available(q)
            if hi == 110:
                assert len(ingest.batch_counters(q)) <= 100
            for _ in range(100):              # the listener runs beside the query
                got = ingest.recorded_counters(spark, kept) if os.path.isdir(kept) else None
                if got is not None and got.where("validos > 0").count() >= hi:
                    break
                time.sleep(0.2)
    finally:
        spark.streams.removeListener(recorder)
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    total = got.selectExpr("sum(validos) v", "sum(aceptados) a", "sum(tardios) t", "sum(duplicados) d").first()
    twin, outcomes = live.process_batch(spark.read.schema(ingest.PING_EVENT_SCHEMA).json(src)
                                        .selectExpr("* except (ts)", "cast(ts as timestamp) ts"))
    c = aggregate.ingest_counters(outcomes).first()
    assert (total.v, total.a, total.t, total.d) == (c.recibidos - c.rechazados_validacion, c.aceptados, 0, c.rechazados_duplicado)
    assert total.v == 300 and twin.count() == 150


def test_outcome_stream_counters_claims_and_log_over_batches(spark, tmpdir_path):
    base = os.path.join(tmpdir_path, "out")
    ddl = "bus_id string, ruta string, velocidad_kmh string, latitud string, longitud string, ts timestamp"
    every, files = [], []
    for n in range(12):
        t = T0 + dt.timedelta(minutes=n // 2, seconds=n)
        rows = [("B1", "210", "20", "-33.45", "-70.66", t), (f"C{n}", "210", "20", "-33.45", "-70.66", t),
                ("B2", "210", "999", "-33.45", "-70.66", t), ("B3", "210", "20", "-33.45", "-70.66", None if n == 5 else t)]
        if n == 9:
            rows.append(("B4", "210", "20", "-33.45", "-70.66", dt.datetime(2099, 1, 1)))  # a wild date
        every += rows
        df = spark.createDataFrame(rows, ddl)
        ingest.judge_batch(df, n, base)
        if n in (5, 9):
            ingest.judge_batch(df, n, base)                 # a repeated batch counts once
        files.append(len(versioned.manifest(spark, os.path.join(base, "claims"))["folders"]))
    assert files[-1] == 12 - 7 and max(files) <= 8
    got = ingest.stream_counters(spark, base).first()
    outcomes = spark.read.parquet(f"{base}/outcomes")
    assert tuple(got) == tuple(aggregate.ingest_counters(outcomes).first())
    assert (got.recibidos, got.rechazados_validacion, got.rechazados_duplicado) == (49, 12, 11)
    claims = versioned.read_snapshot(spark, os.path.join(base, "claims"), ingest.CLAIM_SCHEMA)
    assert claims.count() == got.aceptados == claims.select("bus_id", "minuto").distinct().count()
    log = spark.read.parquet(f"{base}/activity_log")
    assert log.count() == 23 == log.select("event_id").distinct().count() and log.where("event_id is null").count() == 0
