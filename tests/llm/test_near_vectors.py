import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import near_vectors as nv


def brute(rows, groups, threshold=0.95):
    """rows: (id, list or None); quadratic, in Python floats."""
    def fine(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    g = groups(range(len(rows)))
    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            x, y = rows[a][1], rows[b][1]
            if fine(x) and fine(y) and len(x) == len(y):
                x, y = ([t / max(map(abs, v)) for t in v] for v in (x, y))
                c = math.fsum(p * q for p, q in zip(x, y, strict=True)) / math.sqrt(
                    math.fsum(p * p for p in x)) / math.sqrt(math.fsum(p * p for p in y))
                if c >= threshold:
                    g.link(a, b)
                    links[a] += 1
                    links[b] += 1
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            r = g.find(k)
            low[r] = min(low.get(r, i), i)
    return sorted(((i, links[k], low.get(g.find(k)), i == low.get(g.find(k))) for k, (i, _) in enumerate(rows)), key=str)


def result(df, **how):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in nv.near_vectors(df, **how).collect()), key=str)


@pytest.mark.parametrize("tile", [4096, 60])
def test_table_equals_brute_force(spark, groups, tile):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, list(map(float, r.embedding))) for r in df.collect()]
    assert result(df, tile=tile) == brute(rows, groups)


def test_edges(spark, groups):
    rng = np.random.default_rng(0)
    base = rng.normal(size=6)
    rows = [(1, None), (2, []), (3, [0.0] * 6), (4, [float("nan"), 1.0]), (5, [1.0, None]), (6, [float("inf"), 1.0]),
            (10, [1.0, 2.0]), (9, [2.0, 4.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0]), (11, [-1.0, -2.0]), (12, [1.0, 2.0, 0.0]),
            (None, [1.0, 2.0]), (None, [7.0]), (13, [1e200, 2e200]), (14, [5.0, -5.0])]
    # a chain: neighbours are near, the ends are not; and a dense group
    rows += [(20 + k, [math.cos(0.3 * k), math.sin(0.3 * k), 0.0, 0.0]) for k in range(9)]
    rows += [(40 + k, (base + rng.normal(0, 0.01, 6)).tolist()) for k in range(40)]
    rows += [(100 + k, rng.normal(size=6).tolist()) for k in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for tile in (4096, 8):
        assert result(df, tile=tile) == brute(rows, groups)
    assert nv.near_vectors(df.limit(0)).count() == 0
    extra = df.withColumn("_v", F.lit(1)).withColumn("node", F.lit("x")).withColumn("low_id", F.lit(None).cast("int"))
    assert result(extra) == result(df)


def test_bound_never_hides_a_pair():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(300, 16)).astype(np.float32)
    a[100:200] = a[:100] + rng.normal(0, 0.08, (100, 16))  # many pairs about the threshold
    u = nv.unit_rows(a)
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(u @ u.T, 1) >= 0.95), strict=True)}
    near = {(i, j) for i, j in zip(*np.nonzero(np.triu(u @ u.T, 1) >= 0.9499), strict=True)}

    def pairs(x, y):
        got = {(i, j): s for p, q, k in nv.linked_pairs(x, y, 0.95)
               for i, j, s in zip(p.tolist(), q.tolist(), k.tolist(), strict=True)}
        return set(got), {ij for ij, s in got.items() if s}

    may, sure = pairs(nv.Tile.of(a), None)
    assert sure <= want <= may <= near and want and len(may - sure) <= 3
    whole, two = nv.Tile.of(a[:150]), nv.Tile.of(a[150:])
    may, sure = pairs(whole, nv.Tile.unpacked(two.packed(), 16))
    across = {(i, j - 150) for i, j in want if i < 150 <= j}
    assert sure <= across <= may


def test_pairs_at_the_threshold_are_computed_in_full(spark, groups):
    """Cosines so near the threshold that no code can tell."""
    rows = []
    for k in range(12):
        c, pad = 0.95 + (k - 6) * 1e-9, [0.0] * k
        rows += [(10 * k, [1.0, 0.0, *pad]), (10 * k + 1, [c, math.sqrt(1 - c * c), *pad])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = result(df)
    assert got == brute(rows, groups) and {r[1] for r in got} == {0, 1}


def test_quantisation_bounds():
    rng = np.random.default_rng(4)
    u = nv.unit_rows(rng.normal(size=(50, 64)))
    codes, scale, length, rest = nv.quantise(u)
    decoded = codes * scale[:, None]
    assert (np.linalg.norm(u - decoded, axis=1) <= rest).all() and np.allclose(np.linalg.norm(decoded, axis=1), length)
    assert (abs(u @ u.T - decoded @ decoded.T) <= length[:, None] * rest + rest[:, None] * (length + rest) + 1e-12).all()
