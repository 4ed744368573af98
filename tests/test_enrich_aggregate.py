import datetime as dt
import random

import numpy as np

from pyspark.sql import functions as F

from conftest import PING_DDL, ping
from fleetlake.config import ImputePolicy
from fleetlake.operators import aggregate, insights
from fleetlake.operators.enrich import enrich_weather, impute_temperature
from fleetlake.operators.quantiles import box_stats, exact_quantiles, value_bucket

W_DDL = "fecha date, condicion string, temperatura_promedio double"


def _weather(spark, rows):
    return spark.createDataFrame([(dt.date.fromisoformat(d), c, t) for d, c, t in rows], W_DDL)


def test_imputation_rounded_and_unrounded(spark):
    w = _weather(spark, [("2024-01-01", "Lluvia", 10.0), ("2024-01-02", "Nublado", 11.05),
                         ("2024-01-03", "Despejado", None)])
    raw = {r.fecha.day: r.temperatura_promedio for r in impute_temperature(w).collect()}
    assert abs(raw[3] - 10.525) < 1e-12
    rnd = {r.fecha.day: r.temperatura_promedio for r in impute_temperature(w, ImputePolicy(1)).collect()}
    assert rnd[3] == 10.5


def test_left_join_missing_and_duplicate_date(spark):
    w = _weather(spark, [("2024-01-05", "Lluvia", 10.0), ("2024-01-05", "Nublado", 11.0)])
    p = spark.createDataFrame([ping(), ping(ts="2024-01-06 10:00:00")], PING_DDL) \
        .withColumn("Fecha", F.to_date("Timestamp"))
    out = enrich_weather(p, w).collect()
    assert len(out) == 3   # the duplicated weather date fans out, the missing day keeps NULLs
    assert sum(1 for r in out if r.Clima_Condicion is None) == 1


def test_route_hour_std_single_row_and_rounding(spark):
    rows = [("210", 1, "B1", 39.89), ("210", 1, "B2", 39.9), ("502", 2, "B1", 10.0)]
    df = spark.createDataFrame(rows, "Ruta string, Hora long, ID_Bus string, Velocidad_kmh double")
    got = {(r.Ruta, r.Hora): r for r in aggregate.route_hour(df).collect()}
    assert got[("210", 1)].Velocidad_Promedio == 39.9    # 39.895 half-up on the decimal text
    assert got[("502", 2)].Velocidad_Std is None          # single-row group: NULL, not NaN
    assert got[("210", 1)].Total_Buses == 2 and got[("210", 1)].Total_Registros == 2


def test_exact_quantiles_match_percentile_with_hot_group(spark):
    rnd = random.Random(7)
    rows = [("hot", float(rnd.randint(0, 500)) / 4) for _ in range(3000)]
    rows += [(f"g{i % 7}", rnd.random() * 100) for i in range(700)]
    rows += [("one", 5.0), ("two", 1.0), ("two", 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    ex = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    ref = df.groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q")).collect()
    for r in ref:
        e = ex[r.g]
        for i, p in enumerate(probs):
            assert abs(e[f"p{int(p * 100)}"] - r.q[i]) < 1e-9, (r.g, p)


def test_box_stats_equal_numpy(spark):
    rnd = random.Random(3)
    rows = [(c, rnd.gauss(40, 15)) for c in ("Despejado", "Nublado", "Lluvia") for _ in range(400)]
    rows += [("Lluvia", 500.0), ("Lluvia", -300.0)] + [("small", v) for v in (0.0, 0.0, 0.0, 10.0)]
    rows += [("hot", rnd.gauss(30, 10)) for _ in range(2000)] + [("one", 7.5)] + [("same", -2.0)] * 9
    rows += [("wide", v) for v in (1e-300, -1e300, 1e300, 0.0, -0.0, 3.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r for r in box_stats(df, ["k"], "v").collect()}
    assert got.keys() == {k for k, _ in rows}
    for k, r in got.items():
        v = np.array([x for g, x in rows if g == k])
        q1, q2, q3 = np.quantile(v, [0.25, 0.5, 0.75])
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        want = (len(v), q1, q2, q3, min(q1, v[v >= lo].min()), max(q3, v[v <= hi].max()), ((v < lo) | (v > hi)).sum())
        have = (r.n, r.q1, r.mediana, r.q3, r.bigote_inf, r.bigote_sup, r.atipicos)
        assert np.allclose(have, want, rtol=1e-9, atol=1e-9), (k, have, want)
    assert got["small"].q3 == 2.5 and got["small"].bigote_sup == 2.5   # never inside the box


def test_value_buckets_never_fall(spark):
    vals = sorted([-1e308, -5.0, -1.0, -1e-9, -5e-324, 0.0, 5e-324, 1e-9, 0.999, 1.0, 1.001, 2.0, 120.0, 1.7e308,
                   float("inf"), float("-inf")])
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = {r.v: r.b for r in df.select("v", value_bucket(F.col("v")).alias("b")).collect()}
    b = [got[v] for v in vals]
    assert b == sorted(b) and len(set(b)) > 10


def test_argmin_ties_and_absent_class(spark):
    rows = [("210", 1, 10.0, "Despejado", "Congestionado"), ("210", 2, 10.0, "Despejado", "Congestionado"),
            ("502", 1, 40.0, "Nublado", "Fluido"), ("502", 2, 40.0, "Nublado", "Fluido")]
    df = spark.createDataFrame(rows, "Ruta string, Hora long, Velocidad_kmh double, Clima_Condicion string, "
                                     "Nivel_Congestion string").withColumn("ID_Bus", F.lit("B"))
    pk = insights.peak_hours(df).first()
    assert pk.hora_punta == 1 and pk.hora_libre == 1 and pk.evitar_desde == 0 and pk.evitar_hasta == 2
    assert insights.worst_cells(df).first().ruta_peor == "210"
    cm = {r.condicion: r.velocidad_promedio for r in insights.condition_means(df).collect()}
    assert cm["Lluvia"] is None and cm["Despejado"] == 10.0
    ri = insights.rain_impact(df).first()
    assert ri.vel_lluvia is None and ri.diferencia is None and ri.porcentaje is None
    only_rain = df.withColumn("Clima_Condicion", F.lit("Lluvia"))
    assert insights.rain_impact(only_rain).first().porcentaje == 0.0   # clear missing: NaN > 0 is false
    ri2 = insights.rain_impact(df, fill_missing=True).first()
    assert ri2.vel_lluvia == 10.0 and ri2.vel_despejado == 10.0
    sh = {r.Ruta: r for r in insights.band_shares(df).collect()}
    assert sh["210"].pct_congestionado == 100.0 and sh["502"].n_moderado == 0
    k = insights.kpis(df).first()
    assert k.ruta_critica == "210" and k.pct_congestionado == 50.0


def test_band_distribution_sums_to_100(spark):
    df = spark.createDataFrame([("Fluido",)] * 3 + [("Moderado",)] * 2 + [("Congestionado",)] * 2,
                               "Nivel_Congestion string")
    rows = aggregate.band_distribution(df).collect()
    assert abs(sum(r.porcentaje for r in rows) - 100.0) < 0.2
