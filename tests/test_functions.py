from pyspark.sql import functions as F

from fleetlake.config import Bands, RouteMap
from fleetlake.functions.bands import band_sql, band_table
from fleetlake.functions.numeric import round_half_up
from fleetlake.functions.text import canonical_route, clean_id, composite_key


def test_band_edges_sql_and_table(spark):
    speeds = [0.0, 14.9, 15.0, 29.9, 30.0, 119.9, 120.0, None, float("nan"), -1.0]
    df = spark.createDataFrame([(s,) for s in speeds], "s double")
    rows = df.select("s", band_sql("s").alias("q"), band_table("s", Bands(mode="table")).alias("t")).collect()
    got = {(r.s if r.s is None or r.s == r.s else "nan"): (r.q, r.t) for r in rows}
    assert got[0.0] == ("Congestionado", "Congestionado")
    assert got[14.9] == ("Congestionado", "Congestionado")
    assert got[15.0] == ("Moderado", "Moderado")
    assert got[29.9] == ("Moderado", "Moderado")
    assert got[30.0] == ("Fluido", "Fluido")
    assert got[119.9] == ("Fluido", "Fluido")
    # 120 is Fluido for the SQL CASE but outside the half-open table
    assert got[120.0] == ("Fluido", "Desconocido")
    # NULL reaches the ELSE branch of the CASE; the table says unknown
    assert got[None] == ("Congestionado", "Desconocido")
    assert got["nan"] == ("Fluido", "Desconocido")
    assert got[-1.0] == ("Congestionado", "Desconocido")


def test_route_normalisation(spark):
    df = spark.createDataFrame([("502c",), (" 502C ",), ("210e",), ("x9",), ("",), (None,)], "r string")
    rows = df.select("r", canonical_route("r").alias("case"),
                     canonical_route("r", RouteMap(mode="map")).alias("map"),
                     clean_id("r").alias("clean")).collect()
    got = {r.r: (r.case, r.map, r.clean) for r in rows}
    assert got["502c"] == ("502C", "502C", "502C")
    assert got[" 502C "] == (" 502C ", " 502C ", "502C")   # no trim in the batch path
    assert got["210e"] == ("210E", "210E", "210E")
    assert got["x9"] == ("X9", "X9", "X9")
    assert got[""] == ("", "", "")
    assert got[None] == (None, None, None)


def test_round_half_up_on_decimal_text(spark):
    df = spark.createDataFrame([(39.895,), (2.675,), (-0.05,), (None,)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 2)).collect()]
    assert got[:3] == [39.9, 2.68, -0.05]
    assert got[3] is None


def test_composite_key_null_and_collision(spark):
    df = spark.createDataFrame([("1", "23"), ("12", "3"), ("1", None)], "a string, b string")
    got = [r[0] for r in df.select(composite_key("a", "b")).collect()]
    assert got == ["123", "123", None]
    assert df.select(F.countDistinct(F.struct("a", "b"))).first()[0] == 3


def test_half_even_rounds_the_binary_value_as_python_does(spark):
    import random
    import struct

    from fleetlake.functions.numeric import round_half_even
    rnd = random.Random(5)
    vals = [-0.05, 0.15, 0.25, 0.35, -0.04, 0.05, 2.675, 1e15, 2.0 ** 49 + 0.25, 2.0 ** 48 + 0.25, 0.0, -0.0, 5e-324]
    vals += [rnd.uniform(-200, 200) for _ in range(40_000)] + [k / 20 for k in range(-4000, 4000)]
    vals += [round(rnd.uniform(-200, 200), 2) for _ in range(40_000)] + [k / 16 for k in range(-2000, 2000)]
    vals += [rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-12, 14) for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for digits in (1, 2):
        got = df.select("x", round_half_even("x", digits).alias("y")).collect()
        for r in got:
            assert struct.pack("d", r.y) == struct.pack("d", round(r.x, digits)), (r.x, r.y)
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    assert [str(r.y) for r in odd.select(round_half_even("x", 1).alias("y")).collect()] == ["None", "nan", "inf", "-inf"]
