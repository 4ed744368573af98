"""Regression guards on physical-plan properties that matter at scale."""

import contextlib
import io
import re

SF = "/root/testdata/sf0.001"


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_a1_does_not_read_the_weather_it_does_not_show(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["a1_route_hour"](spark, SF))
    # a left join to at most one row a day, none of whose columns is used, goes
    assert "Join" not in plan and plan.count("ReadSchema") == 1


def test_filter_below_dedup_and_broadcast_weather(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["j1_enriched"](spark, SF))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # node ids are numbered bottom-up: the range/box filter runs before the
    # first (dedup) exchange, i.e. it was pushed below the distinct
    nodes = [(int(i), n) for i, n in re.findall(r"^\((\d+)\) (\w+)", plan, flags=re.M)]
    first_filter = min(i for i, n in nodes if n == "Filter")
    first_exchange = min(i for i, n in nodes if n == "Exchange")
    assert first_filter < first_exchange
    cond = re.search(r"^\(%d\) Filter.*?Condition : (.*?)$" % first_filter, plan, flags=re.M | re.S).group(1)
    assert ">= -33.65" in cond and "<= 120.0" in cond
    # the weather dimension reads only the timestamp column of events
    assert "ReadSchema: struct<ts:timestamp_ntz>" in plan


def test_v9_is_one_shuffle_of_pings(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["v9_raw_profile"](spark, SF))
    nodes = re.findall(r"^\(\d+\) (\w+)", plan, flags=re.M)
    assert nodes.count("Exchange") == 2          # row counts by all columns, then the one-row final
    assert "Window" not in nodes and "SortMergeJoin" not in nodes


def test_mart_prunes_fact_columns(spark):
    import __spark_entry__ as E
    plan = _plan(E.queries()["d8_wide_mart"](spark, SF))
    li = [s for s in re.findall(r"ReadSchema: (struct<[^>]*>)", plan) if "l_orderkey" in s]
    assert li and all("l_tax" not in s and "l_shipdate" not in s and "l_returnflag" not in s for s in li)


def test_several_distinct_counts_without_expand(spark):
    from fleetlake.catalog import QUERIES
    for name in ("a2_post_clean_stats", "p16_composite_key", "v12_dataset_profile"):
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString(), name


def test_distinct_and_folds_on_nulls_and_nothing(spark):
    from pyspark.sql import functions as F

    from fleetlake.operators.aggregate import distinct_and_folds
    rows = [("a", 1, 2.0), ("a", None, None), (None, 1, 4.0), ("b", 2, 1.0), ("b", 2, 1.0), (None, None, None)]
    df = spark.createDataFrame(rows, "x string, y int, v double").repartition(3)
    folds = {"n": (F.count(F.lit(1)), "sum"), "lo": (F.min("v"), "min"), "hi": (F.max("v"), "max"), "total": (F.sum("v"), "sum")}
    got = distinct_and_folds(df, {"xs": "x", "ys": "y"}, folds)
    assert got.first().asDict() == {"xs": 2, "ys": 2, "n": 6, "lo": 1.0, "hi": 4.0, "total": 8.0}
    none = distinct_and_folds(df.limit(0), {"xs": "x", "ys": "y"}, folds).collect()
    assert len(none) == 1 and (none[0].xs, none[0].ys, none[0].n, none[0].hi) == (0, 0, None, None)


def test_post_clean_stats_of_nothing(spark):
    from fleetlake.operators.aggregate import post_clean_stats
    df = spark.createDataFrame([], "Ruta string, ID_Bus string, Velocidad_kmh double, Clima_Condicion string, Nivel_Congestion string")
    r = post_clean_stats(df).first()
    assert (r.total_registros, r.rutas_unicas, r.n_fluido, r.vel_promedio) == (0, 0, 0, None)


def test_view_means_with_and_without_weights(spark):
    from fleetlake.operators.insights import view_mean, view_totals
    view = spark.createDataFrame([(8, 10.0, 3), (8, 20.0, 1), (8, None, 5), (9, None, 2)],
                                 "hora int, velocidad_promedio double, total_pings long")
    assert {r.hora: r.velocidad_promedio for r in view_mean(view, ["hora"]).collect()} == {8: 15.0, 9: None}
    assert {r.hora: r.velocidad_promedio for r in view_mean(view, ["hora"], weight="total_pings").collect()} == {8: 12.5, 9: None}
    assert {r.hora: r.total_pings for r in view_totals(view, ["hora"], "total_pings").collect()} == {8: 9, 9: 2}


def test_messages_are_parsed_one_by_one(spark):
    import datetime as dt

    from fleetlake.streaming.ingest import parse_messages
    at = dt.datetime(2024, 1, 5, 8, 0)
    values = [b'{"bus_id": "B1", "velocidad_kmh": 12.5, "ts": "2024-01-04 07:00:00", "other": 1}', b'{"bus_id": "B2"}',
              b'{"bus_id": "B3", "ts": "yesterday"}', b"no json", None]
    raw = spark.createDataFrame([(v, at) for v in values], "value binary, timestamp timestamp")
    got = [(r.bus_id, r.velocidad_kmh, r.ts) for r in parse_messages(raw).collect()]
    assert got == [("B1", "12.5", dt.datetime(2024, 1, 4, 7)), ("B2", None, at), ("B3", None, at), (None, None, at), (None, None, at)]


def test_load_stats_counts_while_the_load_is_written(spark, tmp_path):
    from fleetlake.sources.files import load_stats
    df, seen = load_stats(spark.range(37).repartition(3), "load")
    df.write.parquet(str(tmp_path / "t"))
    assert seen.get == {"registros": 37}


def test_box_statistics_share_their_frequencies(spark):
    from fleetlake.catalog import QUERIES
    df = QUERIES["a15_box_by_condition"](spark, "/root/testdata/sf0.001")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # events are read once for the pings and once for the days with weather; the
    # unused temperature costs nothing
    assert plan.count("FileScan parquet") == 2 and "ReusedExchange" in plan


def test_missing_temperatures_take_one_mean(spark):
    from fleetlake.operators.enrich import impute_temperature
    w = spark.createDataFrame([("a", "x", 10.0), ("b", "x", None), ("c", "x", 21.0)],
                              "fecha string, condicion string, temperatura_promedio double")
    got = {r.fecha: r.temperatura_promedio for r in impute_temperature(w).collect()}
    assert got == {"a": 10.0, "b": 15.5, "c": 21.0}
    assert impute_temperature(w.limit(0)).count() == 0
    nothing = impute_temperature(w.where("fecha = 'b'")).first()
    assert nothing.temperatura_promedio is None
    assert "avg" not in impute_temperature(w).select("condicion")._jdf.queryExecution().optimizedPlan().toString()
