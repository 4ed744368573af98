"""Exact quantiles and box statistics without collecting a group.

``percentile`` keeps a value -> count map per group in one task, and a window
over a group sorts it in one task. Here

1. value frequencies per group (partially aggregated: repeats collapse) fall
   into buckets of a monotone function of the value (512 to a factor of two,
   so there are at most some two million whatever the data),
2. running sums over a group's buckets give every bucket its rank interval,
   which tells the few buckets that hold the wanted ranks,
3. the values of those buckets only are ranked.

One lazy plan: no job while it is built, nothing cached. Linear interpolation
at position p*(n-1), as numpy, DuckDB ``quantile_cont`` and Spark
``percentile``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PER_OCTAVE = 512
_ZERO = 1 << 20


def value_frequencies(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """(groups..., value, _c). NULL and NaN values and rows with a NULL
    group key are ignored (as pandas grouping does)."""
    v = F.col(value)
    keep = v.isNotNull() & ~F.isnan(v)
    for g in groups:
        keep = keep & F.col(g).isNotNull()
    return df.where(keep).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_c"))


def value_bucket(v: Column) -> Column:
    """A whole number that never falls as ``v`` rises (infinities included).
    Never NULL: a join on it then adds no filter below the frequencies, whose
    exchange all branches of the plan share."""
    size = F.least(F.abs(v.cast("double")), F.lit(1.7e308))
    step = F.floor(F.log2(F.when(size > 0, size)) * PER_OCTAVE) + _ZERO
    return F.coalesce(F.when(v > 0, step).when(v < 0, -step).cast("long"), F.lit(0).cast("long"))


def exact_quantiles(df: DataFrame, groups: list[str], value: str, probs: list[float],
                    names: list[str] | None = None, freq: DataFrame | None = None) -> DataFrame:
    """One row per group with one column per probability (linear
    interpolation), plus ``n``. Groups with no non-null value are absent.
    ``freq``: the frequencies where the caller has them."""
    names = names or [f"p{int(round(p * 100))}" for p in probs]
    freq = value_frequencies(df, groups, value) if freq is None else freq
    rows = freq.withColumn("_b", value_bucket(F.col(value)))
    buckets = rows.groupBy(*groups, "_b").agg(F.sum("_c").alias("_bc"))
    upto = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    all_ = Window.partitionBy(*groups)
    spans = buckets.select(*groups, "_b", F.sum("_bc").over(upto).alias("_end"), "_bc",
                           F.sum("_bc").over(all_).alias("_n"))
    at = [f"{float(p)!r}D * (_n - 1)" for p in probs]
    wanted = ", ".join(f"named_struct('q', {i}, 'rank', floor({pos}) + {side}, 'side', {side}, 'frac', {pos} - floor({pos}))"
                       for i, pos in enumerate(at) for side in (0, 1))
    inside = F.expr(f"filter(array({wanted}), t -> t.rank < _end AND t.rank >= _end - _bc)")
    targets = (spans.select(*groups, "_b", "_n", (F.col("_end") - F.col("_bc")).alias("_start"), inside.alias("_t"))
               .where(F.size("_t") > 0))
    near = rows.join(targets, [*groups, "_b"])
    run = Window.partitionBy(*groups, "_b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    hi = F.col("_start") + F.sum("_c").over(run)
    hits = (near.select(*groups, F.col(value).alias("_v"), "_n", "_c", "_t", hi.alias("_hi"))
            .selectExpr("*", "inline(filter(_t, t -> t.rank < _hi AND t.rank >= _hi - _c))"))
    picked = []
    for i in range(len(probs)):
        picked += [f"max(_v) FILTER (WHERE q = {i} AND side = 0) AS _v{i}0",
                   f"max(_v) FILTER (WHERE q = {i} AND side = 1) AS _v{i}1", f"max(frac) FILTER (WHERE q = {i}) AS _f{i}"]
    out = hits.groupBy(*groups).agg(*[F.expr(e) for e in ("max(_n) AS n", *picked)])
    return out.select(*groups, "n", *[F.expr(f"IF(_f{i} > 0, _v{i}0 + _f{i} * (_v{i}1 - _v{i}0), _v{i}0)").alias(n)
                                      for i, n in enumerate(names)])


def box_stats(df: DataFrame, groups: list[str], value: str, whisker: float = 1.5) -> DataFrame:
    """Per group: n, mean, q1, median, q3, IQR, whiskers (most extreme
    values within ``whisker`` IQR of the box, never inside the box) and the
    outlier count."""
    freq = value_frequencies(df, groups, value)
    q = exact_quantiles(df, groups, value, [0.25, 0.5, 0.75], ["q1", "mediana", "q3"], freq=freq)
    iqr = F.col("q3") - F.col("q1")
    box = q.select(*groups, "n", "q1", "mediana", "q3", iqr.alias("iqr"),
                   (F.col("q1") - whisker * iqr).alias("_lof"), (F.col("q3") + whisker * iqr).alias("_hif"))
    v, c = F.col(value), F.col("_c")
    stats = freq.join(box.select(*groups, "_lof", "_hif"), groups, "inner").groupBy(*groups).agg(
        (F.sum(v * c) / F.sum(c)).alias("media"),
        F.min(F.when(v >= F.col("_lof"), v)).alias("_low"),
        F.max(F.when(v <= F.col("_hif"), v)).alias("_high"),
        F.coalesce(F.sum(F.when((v < F.col("_lof")) | (v > F.col("_hif")), c)), F.lit(0))
        .cast("long").alias("atipicos"))
    return box.join(stats, groups, "inner").select(
        *groups, "n", "q1", "mediana", "q3", "iqr", "media", F.least("_low", "q1").alias("bigote_inf"),
        F.greatest("_high", "q3").alias("bigote_sup"), "atipicos")
