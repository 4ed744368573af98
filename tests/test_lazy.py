"""Building a query starts no job and leaves no cache; reports are ordered."""

import pytest
from conftest import PING_DDL, ping
from pyspark.sql import functions as F

from fleetlake.operators import aggregate, insights, sales, starschema
from fleetlake.streaming import live

SF = "/root/testdata/sf0.001"
#: Queries that write something to read it back.
RUNS = ("k2_", "k3_", "k4_", "k5_", "k6_", "k7_", "k8_", "k9_", "s1_", "s2_", "s4_", "s6_", "l1_")


def test_building_a_batch_query_runs_nothing(spark):
    from fleetlake.catalog import QUERIES
    spark.catalog.clearCache()
    tracker = spark.sparkContext.statusTracker()
    for name, fn in sorted(QUERIES.items()):
        if name.startswith(RUNS) or "stream" in name:
            continue
        group = f"build-{name}"
        spark.sparkContext.setJobGroup(group, name)
        fn(spark, SF)
        jobs = tracker.getJobIdsForGroup(group)
        # reading a table's schema from its footer is Spark's own job
        assert len(jobs) <= 24, (name, len(jobs))
        stages = [s for j in jobs for s in (tracker.getJobInfo(j).stageIds if tracker.getJobInfo(j) else [])]
        assert all((tracker.getStageInfo(s) is None or tracker.getStageInfo(s).name.startswith("parquet")) for s in stages), name
    spark.sparkContext.setJobGroup("", "")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_reports_come_in_order(spark):
    rows = [ping(bus=f"B{i}", route=r, speed=float(s), ts=f"2024-01-05 {h:02d}:00:00")
            for i, (r, s, h) in enumerate([("502", 40, 9), ("210", 10, 8), ("210", 20, 7), ("210", 12, 8), ("104", 35, 8)])]
    df = spark.createDataFrame(rows, PING_DDL).selectExpr(
        "*", "hour(Timestamp) AS Hora", "CASE WHEN Velocidad_kmh >= 30 THEN 'Fluido' WHEN Velocidad_kmh >= 15 "
        "THEN 'Moderado' ELSE 'Congestionado' END AS Nivel_Congestion", "'Lluvia' AS Clima_Condicion").repartition(5)
    assert [(r.Ruta, r.Hora) for r in aggregate.route_hour(df).collect()] == [("104", 8), ("210", 7), ("210", 8), ("502", 9)]
    assert [r.nivel_congestion for r in aggregate.band_distribution(df).collect()] == ["Congestionado", "Fluido", "Moderado"]
    assert [r.Ruta for r in insights.band_shares(df).collect()] == ["104", "502", "210"]
    votes = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "k string").repartition(3)
    assert [r.k for r in sales.share_of_total(votes, "k").collect()] == ["b", "a", "c"]


def test_band_shares_count_rows_with_a_bus(spark):
    df = spark.createDataFrame([("210", "Fluido", "B1"), ("210", "Fluido", None), ("210", "Congestionado", "B2")],
                               "Ruta string, Nivel_Congestion string, ID_Bus string")
    r = insights.band_shares(df).first()
    assert (r.n_fluido, r.n_congestionado, r.pct_fluido) == (1, 1, 50.0)


def test_fact_ids_are_unique(spark):
    raw = spark.createDataFrame([ping(), ping(), ping(), ping(bus="B2")], PING_DDL)
    clima = starschema.dim_weather(spark.createDataFrame([], "fecha date, condicion string, temperatura_promedio double"))
    f = starschema.fact_trips(raw, clima)
    assert f.count() == 4 and f.select("viaje_id").distinct().count() == 4


@pytest.mark.parametrize("stage", ["outcomes", "rejects"])
def test_live_plan_reads_events_at_most_twice_and_compiles(spark, stage):
    from fleetlake.catalog import _pings
    _, out = live.process_batch(live.events_from_pings(_pings(spark, SF)))
    if stage == "rejects":
        out = out.where(F.col("outcome") == live.REJECTED_INVALID)
    old = spark.conf.get("spark.sql.codegen.fallback")
    spark.conf.set("spark.sql.codegen.fallback", "false")  # code that grows too large is an error
    try:
        out.write.format("noop").mode("overwrite").save()
        out.collect()
    finally:
        spark.conf.set("spark.sql.codegen.fallback", old)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "SortAggregate" not in plan
    assert 1 <= plan.count("FileScan parquet") <= 2
