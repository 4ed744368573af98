from pyspark.sql import functions as F

from conftest import PING_DDL, ping
from fleetlake.operators.dedup import replicate, row_counts, split_duplicates

SF = "/root/testdata/sf0.001"


def test_replicate_chunks_hot_row(spark):
    rows = [ping()] * 23 + [ping(bus="B2")] * 2 + [ping(bus="B3")]
    counted = row_counts(spark.createDataFrame(rows, PING_DDL))
    out = replicate(counted, 2, chunk=3)        # the hot row is emitted by 8 separate chunks
    got = sorted((r.ID_Bus, r.rn) for r in out.collect())
    assert [rn for b, rn in got if b == "BUS_1"] == list(range(2, 24))
    assert [rn for b, rn in got if b == "B2"] == [2]
    assert all(b != "B3" for b, _ in got)


def test_keyed_surplus_with_hot_identical_rows(spark):
    rows = [ping(ts="2024-01-05 10:00:05")] * 50 + [ping(ts="2024-01-05 10:00:20")] * 3
    df = spark.createDataFrame(rows, PING_DDL).withColumn("m", F.date_trunc("minute", "Timestamp"))
    kept, surplus = split_duplicates(df, ["ID_Bus", "m"], ["Timestamp"])
    assert kept.count() == 1 and kept.first().Timestamp.second == 5
    assert surplus.count() == 52
    assert kept.unionByName(surplus).groupBy().count().first()[0] == df.count()


def test_split_and_dedup_invariants(spark):
    import __spark_entry__ as E
    q = E.queries()
    pings = q["v3_dedup_kept"](spark, SF)
    raw_n = q["s11_load_stats"](spark, SF).first().registros_gps
    assert pings.count() + q["v3_duplicates_evidence"](spark, SF).count() == raw_n
    kept_again, surplus_again = split_duplicates(pings)
    assert kept_again.count() == pings.count() and surplus_again.count() == 0      # idempotent
    outcomes = q["r1_outcomes"](spark, SF)
    assert outcomes.count() == raw_n                                                 # one outcome per event
    a8 = q["a8_ingest_counters"](spark, SF).first()
    assert a8.aceptados + a8.rechazados_validacion + a8.rechazados_duplicado == a8.recibidos


def test_view_reaggregation_and_shares(spark):
    import __spark_entry__ as E
    q = E.queries()
    positions = q["r2_dedup_batch_twin"](spark, SF).count()
    assert q["a19_pings_by_route_band"](spark, SF).agg(F.sum("total_pings")).first()[0] == positions
    assert q["a6_totals"](spark, SF).first().pings == positions
    pct = q["a3_band_distribution"](spark, SF).agg(F.sum("porcentaje")).first()[0]
    assert abs(pct - 100.0) < 0.2
    for r in q["a16_band_shares"](spark, SF).collect():
        assert abs(r.pct_fluido + r.pct_moderado + r.pct_congestionado - 100.0) < 1e-3
