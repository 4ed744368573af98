"""Embedding near-duplicates by int8 tile products with error bounds.

Equal vectors are collapsed. The distinct ones are scaled to length one in
double precision and quantised once, to int8 with a scale per vector and the
rest to int8 again; codes, scales and error bounds are dealt into tiles of
bounded size, the vectors themselves stay where they are. A task multiplies
two tiles: the product of the first int8 matrices plus a rigorous bound on what
quantisation can hide (the lengths of the two residuals) is an upper bound of
every cosine. Pairs whose bound reaches the threshold are computed again with
both codes, whose bounds are some 200 times narrower: nearly all are then
certain, and only pairs whose interval still holds the threshold fetch their
vectors and are computed in full double precision.

A pair of tiles hands on one row per vector: how many rows it is linked to,
and the links of a spanning forest of what the tile pair links, so a dense
group of g vectors makes g rows there and not g * g.

Every vector meets every other: the number of products is quadratic in the
distinct vectors by the nature of the method; a tile is replicated to as many
tasks as there are tiles, and a task holds two tiles whatever the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .runtime import ship, written

THRESHOLD = 0.95
#: Distinct vectors in a tile, on average.
TILE = 8192
#: Rows of a tile that are multiplied at once.
STRIP = 512
#: Added to the bound for rounding in float32 products and sums.
SLACK = 1e-5


#: Added on both sides of an interval for rounding in double precision.
DOUBLE_SLACK = 1e-12


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, lengths of the decoded vectors, and upper bounds of
    the lengths of the residuals, for rows of length one (or for residuals)."""
    top = np.abs(unit).max(axis=1)
    scale = np.where(top > 0, top / 127.0, 1.0)
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    decoded = codes * scale[:, None]
    rest = np.sqrt(((unit - decoded) ** 2).sum(axis=1)) * (1 + 1e-12) + 1e-15
    return codes, scale, np.sqrt((decoded ** 2).sum(axis=1)), rest


class Tile:
    """Quantised vectors: codes, codes of their residuals, bounds."""

    PARTS = (("codes", np.int8), ("scale", np.float64), ("length", np.float64), ("rest", np.float64),
             ("fine", np.int8), ("fine_scale", np.float64), ("fine_rest", np.float64))

    def __init__(self, parts: list[np.ndarray]):
        (self.codes, self.scale, self.length, self.rest, self.fine, self.fine_scale, self.fine_rest) = parts
        self.near = self.codes * self.scale[:, None] + self.fine * self.fine_scale[:, None]
        self.near_length = np.sqrt((self.near ** 2).sum(axis=1))

    @staticmethod
    def of(vectors: np.ndarray) -> Tile:
        u = unit_rows(vectors)
        codes, scale, length, rest = quantise(u)
        fine, fine_scale, _, fine_rest = quantise(u - codes * scale[:, None])
        return Tile([codes, scale, length, rest, fine, fine_scale, fine_rest])

    def packed(self) -> list[bytes]:
        return [np.ascontiguousarray(getattr(self, n), t).tobytes() for n, t in self.PARTS]

    @staticmethod
    def unpacked(parts: list[bytes], dim: int) -> Tile:
        return Tile([np.frombuffer(b, t).reshape(-1, dim) if t is np.int8 else np.frombuffer(b, t)
                     for b, (_, t) in zip(parts, Tile.PARTS, strict=True)])


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision (finite, not zero)."""
    v = vectors.astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow in the squares
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def linked_pairs(a: Tile, b: Tile | None, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places (i, j) of the pairs of rows of ``a`` and ``b`` (None: pairs i < j
    within ``a``) whose cosine may reach the threshold, and whether it is sure to."""
    same, b = b is None, a if b is None else b
    # float32 products of int8 codes are exact up to 1,000 dimensions or so
    exact = np.float32 if 127 * 127 * a.codes.shape[1] < 1 << 24 else np.float64
    fa, fb = a.codes.astype(exact), b.codes.astype(exact).T
    # |x.y - x'.y'| <= |x'| |ry| + |rx| |y'| + |rx| |ry|
    side = b.length + b.rest
    for k in range(0, len(fa), STRIP):
        rows = slice(k, k + STRIP)
        upper = (fa[rows] @ fb) * (a.scale[rows, None] * b.scale).astype(exact)
        upper += (a.length[rows, None] * b.rest).astype(exact)
        upper += (a.rest[rows, None] * side).astype(exact)
        i, j = np.nonzero(upper >= threshold - SLACK)
        i += k
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        for m in range(0, len(i), 1 << 16):  # bounded memory in dense groups
            p, q = i[m:m + (1 << 16)], j[m:m + (1 << 16)]
            dot = (a.near[p] * b.near[q]).sum(axis=1)
            off = (a.near_length[p] * b.fine_rest[q] + a.fine_rest[p] * (b.near_length[q] + b.fine_rest[q])) + DOUBLE_SLACK
            may = dot + off >= threshold
            yield p[may], q[may], (dot - off >= threshold)[may]


def _forest(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Lowest place reachable for each of n places."""
    up = np.arange(n)
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = np.minimum(up[i], up[j])
            before = up.copy()
            np.minimum.at(up, i, low)
            np.minimum.at(up, j, low)
            changed |= bool((up != before).any())
        up = up[up]
    return up


def _pair_rows(ids_a, n_a, a, ids_b, n_b, b, threshold) -> pd.DataFrame:
    """Rows (node, links, low, other). For sure links: links by number of input
    rows, ``low`` the forest's link. For pairs to be computed in full: the two
    nodes in ``node`` and ``other``."""
    same = b is None
    ids = ids_a if same else np.concatenate([ids_a, ids_b])
    mult = n_a if same else np.concatenate([n_a, n_b])
    shift = 0 if same else len(ids_a)
    links = np.zeros(len(ids), np.int64)
    up, open_ = np.arange(len(ids)), []
    for i, j, sure in linked_pairs(a, b, threshold):
        j = j + shift
        open_.append((ids[i[~sure]], ids[j[~sure]]))
        i, j = i[sure], j[sure]
        np.add.at(links, i, mult[j])
        np.add.at(links, j, mult[i])
        if len(i):
            # fold this block into the forest: the pairs and what is known
            known = np.flatnonzero(up != np.arange(len(up)))
            up = _forest(len(ids), [(i, j), (known, up[known])])
    touched = np.flatnonzero(links)
    sure = pd.DataFrame({"node": ids[touched], "links": links[touched], "low": pd.array(ids[up[touched]], dtype="Int64"),
                         "other": pd.array([None] * len(touched), dtype="Int64")})
    x, y = (np.concatenate([o[k] for o in open_]) if open_ else np.empty(0, np.int64) for k in (0, 1))
    rest = pd.DataFrame({"node": x, "links": np.zeros(len(x), np.int64), "low": pd.array([None] * len(x), dtype="Int64"),
                         "other": pd.array(y, dtype="Int64")})
    return pd.concat([sure, rest]) if len(rest) else sure


def _full(batches: Iterator[pd.DataFrame], threshold: float) -> Iterator[pd.DataFrame]:
    """The pairs (node, other, _x, _y) whose cosine reaches the threshold."""
    for pdf in batches:
        hit = np.array([float((unit_rows(np.array([x])) * unit_rows(np.array([y]))).sum()) >= threshold
                        for x, y in zip(pdf["_x"], pdf["_y"], strict=True)], bool)
        yield pdf.loc[hit, ["node", "other", "n_node", "n_other"]]


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding",
                 threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """One row per input row: id, ``n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable, its own included), ``kept``.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing; vectors of different lengths do not link. Rows that
    repeat an id are vectors of their own. A row whose id is null takes part
    and can be linked, but is never kept unless every id of its component is
    null (then ``component_id`` is null and all such rows are kept). An empty
    table gives an empty result.
    """
    spark = vectors.sparkSession
    ship(spark)
    double = F.transform(F.col(vector), lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).alias("_id"), double.alias("_v"))
    fine = F.expr("size(_v) > 0 AND forall(_v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
                  " AND exists(_v, x -> x <> 0)")
    rows = rows.withColumn("_v", F.when(F.coalesce(fine, F.lit(False)), F.col("_v")))
    rows = rows.withColumns({"_k1": F.xxhash64("_v"), "_k2": F.xxhash64(F.lit(1), "_v")})
    # equal vectors by 128 bits of hash; the node number is fixed by the write
    distinct = written(rows.where("_v is not null").groupBy("_k1", "_k2")
                       .agg(F.first("_v").alias("_v"), F.min("_id").alias("low_id"), F.count("*").alias("n"))
                       .withColumn("node", F.monotonically_increasing_id()), "vectors")
    sizes = distinct.groupBy(F.size("_v").alias("dim")).agg(F.count("*").alias("n"))
    tiles = sizes.select("dim", F.ceil(F.col("n") / F.lit(float(tile))).cast("int").alias("tiles"))
    placed = (distinct.withColumn("dim", F.size("_v")).join(tiles, "dim")
              .withColumn("tile", F.pmod(F.col("_k1"), F.col("tiles")).cast("int")))
    names = [n for n, _ in Tile.PARTS]

    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        parts = Tile.of(np.array(pdf["_v"].tolist(), np.float64)).packed()
        return pd.DataFrame({"dim": [key[0]], "tile": [key[1]], "tiles": [pdf["tiles"].iloc[0]],
                             "ids": [pdf["node"].to_numpy(np.int64).tobytes()],
                             "n": [pdf["n"].to_numpy(np.int64).tobytes()], **{k: [v] for k, v in zip(names, parts, strict=True)}})

    packed = written(placed.select("dim", "tile", "tiles", "node", "n", "_v").groupBy("dim", "tile").applyInPandas(
        pack, "dim int, tile int, tiles int, ids binary, n binary, " + ", ".join(f"{n} binary" for n in names)), "tiles")
    other = packed.withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
    paired = other.select("dim", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"),
                          "tile", "ids", "n", *names)

    def multiply(key, pdf: pd.DataFrame) -> pd.DataFrame:
        dim, i, j = key
        parts = []
        for t in (i, j) if i != j else (i,):
            r = pdf[pdf["tile"] == t].iloc[0]
            parts.append((np.frombuffer(r["ids"], np.int64), np.frombuffer(r["n"], np.int64),
                          Tile.unpacked([r[n] for n in names], dim)))
        second = parts[1] if i != j else (None, None, None)
        return _pair_rows(*parts[0], *second, threshold)

    made = written(paired.groupBy("dim", "i", "j").applyInPandas(multiply, "node long, links long, low long, other long"),
                   "linked")
    x = distinct.select("node", F.col("_v").alias("_x"), F.col("n").alias("n_node"))
    y = distinct.select(F.col("node").alias("other"), F.col("_v").alias("_y"), F.col("n").alias("n_other"))
    full = (made.where("other is not null").select("node", "other").join(x, "node").join(y, "other")
            .mapInPandas(lambda batches: _full(batches, threshold), "node long, other long, n_node long, n_other long"))
    full = written(full, "full")
    sure = made.where("other is null").select("node", "links", "low")
    found = (sure.unionAll(full.select("node", "n_other", "other")).unionAll(full.select("other", "n_node", "node")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    comp = connected_components(found.select(F.col("node").alias("a"), F.col("low").alias("b")))
    named = (distinct.join(links, "node", "left").join(comp, "node", "left")
             .select("_k1", "_k2", "n", "low_id", F.coalesce("links", F.lit(0)).alias("links"),
                     F.coalesce("component", "node").alias("component")))
    lowest = named.groupBy("component").agg(F.min("low_id").alias("component_id"))
    # equal vectors link with each other: n - 1 more
    final = named.join(lowest, "component").select("_k1", "_k2", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    narrow = rows.select("_id", *[F.when(F.col("_v").isNotNull(), F.col(k)).alias(k) for k in ("_k1", "_k2")])
    out = narrow.join(final, ["_k1", "_k2"], "left")
    alone = F.col("n_links").isNull()
    component = F.when(alone, F.col("_id")).otherwise(F.col("component_id"))
    return out.select(F.col("_id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("_id").eqNullSafe(component).alias("kept"))
