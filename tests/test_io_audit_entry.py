import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from fleetlake.operators import audit
from fleetlake.sinks import files as sinks
from fleetlake.sources import files as sources

SF = "/root/testdata/sf0.001"


def test_csv_json_sources_and_sinks(spark, tmpdir_path):
    csv = os.path.join(tmpdir_path, "pings.csv")
    with open(csv, "w") as f:
        f.write("ID_Bus,Ruta,Velocidad_kmh,Latitud,Longitud,Timestamp\n")
        f.write("BUS_1,210,20,-33.45,-70.66,2024-05-01 10:00:00\n")
        f.write("BUS_2,502c,-3,-33.40,-70.60,2024-05-01 11:30:00\n")
    df = sources.load_pings(spark, csv)
    assert df.count() == 2 and dict(df.dtypes)["Velocidad_kmh"] == "double"
    assert sources.scan_csv(spark, csv).count() == 2
    arr = os.path.join(tmpdir_path, "clima.json")
    with open(arr, "w") as f:
        json.dump([{"fecha": "2024-05-01", "condicion": "Lluvia", "temperatura_promedio": 11.5},
                   {"fecha": "2024-05-02", "condicion": "Despejado", "temperatura_promedio": None}], f, indent=2)
    w = sources.load_weather_json(spark, arr)
    assert w.count() == 2 and w.where(F.col("temperatura_promedio").isNull()).count() == 1
    nd = os.path.join(tmpdir_path, "clima_nd")
    sources.json_array_to_ndjson(spark, arr, nd)
    assert sources.scan_ndjson(spark, nd, sources.WEATHER_SCHEMA).count() == 2
    man = sources.ingest_raw(spark, [csv, arr]).collect()
    assert len(man) == 2 and all(len(r.md5) == 32 and r.bytes > 0 for r in man)
    with pytest.raises(Exception):
        sources.ingest_raw(spark, [os.path.join(tmpdir_path, "missing.csv")]).collect()
    out = os.path.join(tmpdir_path, "evid")
    assert sinks.write_csv(df.where("Velocidad_kmh < -100"), out, only_if_rows=True) is False
    assert sinks.write_csv(df, out, only_if_rows=True) is True
    assert sinks.write_json_records(df.limit(1), df, os.path.join(tmpdir_path, "agg_json")) is True
    assert sinks.write_json_records(df, df.limit(1), os.path.join(tmpdir_path, "agg_json2")) is False


def test_first_available_and_tables(spark, tmpdir_path):
    good = os.path.join(tmpdir_path, "good")
    spark.range(3).write.parquet(good)
    df = sources.first_available(spark, [("table", "no_such_table"), ("parquet", "/nonexistent/x"),
                                         ("parquet", good)])
    assert df.count() == 3
    with pytest.raises(FileNotFoundError):
        sources.first_available(spark, [("parquet", "/nonexistent/y")])
    sinks.replace_table(spark.range(5).withColumn("k", F.col("id") % 2), "t_repl",
                        path=os.path.join(tmpdir_path, "t_repl"))
    sinks.replace_table(spark.range(2).withColumn("k", F.col("id") % 2), "t_repl",
                        path=os.path.join(tmpdir_path, "t_repl"))
    assert sources.scan_table(spark, "t_repl").count() == 2   # replaced, not appended
    sinks.create_table_if_absent(spark, "t_log", "a string, b long", os.path.join(tmpdir_path, "t_log"))
    sinks.create_table_if_absent(spark, "t_log", "a string, b long", os.path.join(tmpdir_path, "t_log"))
    sinks.append_rows(spark.createDataFrame([("x", 1)], "a string, b long"), name="t_log")
    assert spark.table("t_log").count() == 1
    bad = spark.createDataFrame([("x", None)], "a string, b long")
    with pytest.raises(Exception):
        sinks.check_not_null(bad, ["b"]).write.mode("append").parquet(os.path.join(tmpdir_path, "nn"))


def test_stage_log_run_registry_quarantine(spark, tmpdir_path):
    log = os.path.join(tmpdir_path, "plog")
    with audit.stage(spark, "ingesta", path=log):
        pass
    with pytest.raises(ZeroDivisionError):
        with audit.stage(spark, "limpieza", path=log):
            1 / 0
    with audit.stage(spark, "extra", path=log, continue_on_error=True):
        raise ValueError("boom")
    states = [r.estado for r in spark.read.parquet(log).orderBy("timestamp").collect()]
    assert states.count("INICIO") == 3 and states.count("FIN") == 1 and states.count("ERROR") == 2
    runs = os.path.join(tmpdir_path, "runs")
    audit.record_run(spark, "paso3", "FALLIDO", path=runs)
    audit.record_run(spark, "paso3", "EXITOSO", records=10, path=runs)
    latest = audit.latest_runs(spark.read.parquet(runs)).first()
    assert latest.resultado == "EXITOSO" and latest.registros == 10
    ok, last = audit.can_run(spark.read.parquet(runs), "paso3")
    assert ok and last is not None
    assert audit.can_run(spark.read.parquet(runs), "otro") == (True, None)
    empty = spark.createDataFrame([], "x string, error string")
    assert audit.quarantine_summary(empty).first().tasa_error == "N/A"
    df = spark.createDataFrame([("1",), ("x",), ("3",)], "v string")
    good, bad = audit.quarantine(df, F.when(F.col("v").try_cast("int").isNull(), F.lit("no numerico")))
    assert good.count() == 2 and bad.first().error == "no numerico"
    s = audit.quarantine_summary(df.withColumn("error", F.when(F.col("v") == "x", F.lit("e")))).first()
    assert (s.total_procesados, s.total_exitosos, s.total_fallidos, s.tasa_error) == (3, 2, 1, "33.3%")


def test_user_function_error_capture(spark):
    import pandas as pd

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        if (pdf["id"] == 3).any():
            raise ValueError("tres")
        return pd.DataFrame({"id": pdf["id"], "doble": pdf["id"] * 2})

    out = audit.user_function(spark.range(6).repartition(1), fn, "id long, doble long").collect()
    errs = [r for r in out if r.error]
    assert len(out) == 6 and len(errs) == 1 and "tres" in errs[0].error


def test_user_function_halves_a_failing_batch(spark):
    calls = spark.sparkContext.accumulator(0)

    def fn(pdf):
        calls.add(1)
        if (pdf["id"] % 1000 == 7).any():
            raise ValueError("siete")
        return pdf.assign(doble=pdf["id"] * 2)

    out = audit.user_function(spark.range(0, 4000, 1, 1), fn, "id long, doble long").collect()
    good = {r.id: r.doble for r in out if r.error is None}
    assert len(out) == 4000 and good == {i: 2 * i for i in range(4000) if i % 1000 != 7}
    assert [r.error for r in out if r.error] == ["ValueError: siete"] * 4
    assert calls.value < 150
    assert audit.user_function(spark.range(0), fn, "id long, doble long").collect() == []


def test_user_function_needs_few_calls_on_many_tasks(spark):
    calls, tasks = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def fn(pdf):
        calls.add(1)
        if (pdf["id"] * 7919 % 17 == 0).any():
            raise ValueError("diecisiete")
        if (pdf["id"] % 2 == 0).all():  # nulls among integers
            return pdf.assign(doble=None)
        return pdf.assign(doble=pdf["id"] * 2 + (1 << 60))

    n = 20_000
    out = audit.user_function(spark.range(0, n, 1, 1), fn, "id long, doble long")
    assert out.rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    rows = out.collect()
    good = {r.id: r.doble for r in rows if r.error is None}
    assert set(good) == {i for i in range(n) if i * 7919 % 17} and len(rows) == n
    assert all(v is None or v == 2 * i + (1 << 60) for i, v in good.items()) and None not in [good[i] for i in range(1, n, 2) if i in good]
    assert {r.error for r in rows if r.id is None} == {"ValueError: diecisiete"}
    assert calls.value < 0.42 * n  # 0.5 and more by halves


def test_user_function_keeps_the_errors_of_single_rows(spark):
    def fn(pdf):
        if len(pdf) > 1 and (pdf["id"] == 5).any():
            raise ValueError("never alone")  # no row by itself fails
        if (pdf["id"] >= 90).any():
            raise KeyError(int(pdf["id"].max()))
        return pdf.assign(extra=1)[["extra", "id"]].assign(doble=pdf["id"])

    rows = audit.user_function(spark.range(0, 100, 1, 1), fn, "id long, doble long", tasks=1).collect()
    assert sorted(r.id for r in rows if r.error is None) == list(range(90))
    assert sorted(r.error for r in rows if r.error) == [f"KeyError: {k}" for k in range(90, 100)]
    gone = audit.user_function(spark.range(3), lambda pdf: pdf[["id"]], "id long, doble long").collect()
    assert len(gone) == 3 and all("doble" in r.error for r in gone)


@pytest.mark.parametrize("name", ["s1_csv_scan", "s6_weather_ndjson", "k3_replaced_table", "k9_fanout_table",
                                  "l1_stage_log", "f2_user_function"])
def test_written_and_read_back(spark, name):
    test_oracle_small(spark, name)


def test_entry_and_oracle_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    qs, orc = E.queries(), E.oracle_sql()
    assert set(orc) <= set(qs) and len(qs) >= 90


@pytest.mark.parametrize("name", ["a1_route_hour", "v9_raw_profile", "v8_invalid_evidence",
                                  "a15_box_by_condition", "d8_wide_mart", "r1_outcomes"])
def test_oracle_small(spark, name):
    import __spark_entry__ as E
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert cols == sorted(dcols)

    def norm(v):
        return round(v, 6) if isinstance(v, float) else v
    srows = sorted((tuple(norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert srows == drows


def test_bucketed_order_tables_join_without_exchange(spark, tmpdir_path):
    import contextlib
    import io

    from fleetlake.sources import testdata as td
    li, o = td.bucketed_order_tables(spark, SF, 4, prefix="t", location=tmpdir_path)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            j.explain()
        plan = buf.getvalue()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == td.read_table(spark, SF, "lineitem").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
