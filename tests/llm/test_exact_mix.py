import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fleetlake.llm import exact, mixing
from fleetlake.llm.ordered import last_before, placed, running

from .conftest import doc

SF = "/root/testdata/sf0.001"
LONG = "x y " * 50000


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[t or ""] if x is not None]
        keep = max(ids) if ids else None
        out.append((i, keep, len(groups[t or ""]), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_table_and_filter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = exact.exact_groups(docs, digest=True)
    assert sorted(map(tuple, got.collect()), key=str) == brute_exact(rows_of(docs))
    kept = {r.doc_id for r in exact.exact_dedup(docs).collect()}
    assert kept == {r.doc_id for r in got.where("kept").collect()}


def test_exact_edges(spark, docs):
    near = LONG + "!"  # same prefix and, with the other, the same length
    rows = [doc(1, None), doc(2, ""), doc(3, "a"), doc(4, "a "), doc(5, "a"), doc(5, "a"), doc(6, LONG + "?"), doc(7, near),
            doc(8, near), doc(None, "a"), doc(None, "z"), doc(None, "z"), doc(9, "ä"), doc(10, "ä")]
    df = docs(rows)
    got = sorted(map(tuple, exact.exact_groups(df, digest=True).collect()), key=str)
    assert got == brute_exact([(r[0], r[1]) for r in rows])
    kept = sorted(((r.doc_id, r.text) for r in exact.exact_dedup(df).collect()), key=str)
    assert kept == sorted([(2, ""), (4, "a "), (5, "a"), (6, LONG + "?"), (8, near), (None, "z"), (9, "ä"), (10, "ä")],
                          key=str)
    assert exact.exact_groups(docs([])).count() == 0 and exact.exact_dedup(docs([])).count() == 0
    extra = df.withColumn("_len", F.lit("x")).withColumn("_sha", F.lit(1)).withColumn(
        "m", F.create_map(F.lit("k"), F.lit(1))).withColumn("_row", F.lit(2))
    out = exact.exact_dedup(extra)
    assert out.columns == extra.columns and out.count() == 8
    assert exact.exact_groups(extra).count() == len(rows)


def test_the_table_hashes_and_groups_what_the_refinement_leaves(spark, docs, monkeypatch):
    rows = [doc(1, "alone"), doc(2, "twice"), doc(3, "twice"), doc(4, None), doc(5, LONG + "?"), doc(6, LONG + "!"),
            doc(7, "the same"), doc(8, "not same"), doc(None, "a row without id")]
    seen, keep = {}, exact.written
    monkeypatch.setattr(exact, "written", lambda df, name: seen.setdefault(name, keep(df, name)))
    got = sorted(map(tuple, exact.exact_groups(docs(rows), digest=True).collect()), key=str)
    assert got == brute_exact([(r[0], r[1]) for r in rows])
    # full hashes for the grouping: the copies, and two texts of one length and prefix
    assert {r._id for r in seen["measures"].where("_sha is not null").collect()} == {2, 3, 5, 6}
    assert seen["pairs"].count() == 2 and seen["copies"].count() == 1


def test_exact_is_native(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (exact.exact_groups(docs, digest=True), exact.exact_dedup(docs), mixing.mix(docs), mixing.mixed_rows(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))


# ------------------------------------------------------------------- mixing

def fill(sizes, weights=(1, 2, 3), most=3):
    """Water filling by repeated sharing, as the contract words it."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        if not open_:
            return {s: float(v) for s, v in fixed.items()}
        share = (total - sum(fixed.values())) / sum(w[s] for s in open_)
        over = [s for s in open_ if w[s] * share >= most * sizes[s]]
        if not over:
            return {s: float(fixed[s]) if s in fixed else w[s] * share for s in order}
        fixed.update({s: most * sizes[s] for s in over})


def words(t):
    return len((t or "").encode().split())


def check_mix(got, rows):
    sizes = Counter()
    longest = Counter()
    for i, t, _, s, _ in rows:
        sizes[s] += words(t)
        longest[s] = max(longest[s], words(t))
    want = fill(dict(sizes))
    taken = Counter()
    source = {r[0]: r[3] for r in rows}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and math.isclose(r.target, want[s], rel_tol=1e-12, abs_tol=1e-9)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1e-6
    return taken


def test_mix_meets_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()]
    got = mixing.mix(docs, quality=mixing.symbol_quality(F.col("text"))).collect()
    assert [r.size for r in sorted(got, key=lambda r: r.doc_id)] == [words(r[1]) for r in sorted(rows)]
    check_mix(got, rows)
    again = mixing.mix(docs.repartition(7), quality=mixing.symbol_quality(F.col("text"))).collect()
    assert sorted(got) == sorted(again)
    mixed = Counter(r.doc_id for r in mixing.mixed_rows(docs, quality=mixing.symbol_quality(F.col("text"))).collect())
    assert mixed == {r.doc_id: r.copies for r in got if r.copies}


def test_mix_takes_whole_epochs_first_and_caps(spark, docs):
    rows = [doc(i, "a b c", "small") for i in range(3)] + [doc(10 + i, "w " * (i + 1), "big") for i in range(60)]
    rows += [doc(100, "x y", None), doc(101, None, "void"), doc(102, "", "void"), doc(103, LONG, "zz")]
    got = mixing.mix(docs(rows)).collect()
    check_mix(got, rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].copies == 3 for i in range(3))  # capped: exactly three epochs
    assert by[101].target == 0 and by[101].copies == 0
    copies = [by[10 + i].copies for i in range(60)]
    assert max(copies) - min(copies) <= 1


def test_mix_prefers_quality(spark, docs):
    rows = [doc(i, "one two three four", "a") for i in range(400)] + [doc(1000 + i, "w " * 4, "b") for i in range(400)]
    good = F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0)
    got = [r for r in mixing.mix(docs(rows), quality=good).collect() if r.doc_id < 1000 and r.copies]
    even = sum(r.doc_id % 2 == 0 for r in got)
    assert 200 < len(got) < 400 and even > 1.3 * (len(got) - even)


def test_mix_edges(spark, docs):
    assert mixing.mix(docs([])).count() == 0 and mixing.mixed_rows(docs([])).count() == 0
    rows = [doc(None, "a b", "s"), doc(None, "a b", "s"), doc(1, "q", "s"), doc(1, "q", "s"), doc(2, "r s", "t")]
    df = docs(rows).withColumn("size", F.lit("x")).withColumn("_key", F.lit(1)).withColumn("target", F.lit(None).cast("int"))
    bad = F.when(F.col("doc_id") == 1, float("nan")).when(F.col("doc_id") == 2, -1.0)
    assert mixing.mix(df, quality=bad).count() == len(rows)
    assert mixing.mixed_rows(df, quality=bad).columns == df.columns
    assert mixing.mix(docs([doc(1, None), doc(2, " ")])).agg(F.sum("taken")).first()[0] == 0


# ------------------------------------------------------------- shared order

@pytest.mark.parametrize("n", [0, 1, 200])
def test_running_and_last(spark, n):
    data = [(i * 7 % 50, i, None if i % 3 else f"v{i}") for i in range(n)] + [(9, 9, "tie")] * (n // 4)
    df = spark.createDataFrame(data, "k long, x long, v string")
    rows = placed(df, ["k", "x"])
    want = sorted(data, key=lambda r: r[:2])
    got = sorted(running(rows, ["k", "x"], {"s": F.col("x")}).collect(), key=lambda r: r.s)
    total = 0
    assert len(got) == len(want)
    for r, w in zip(sorted(got, key=lambda r: (r.k, r.x, r.s)), want, strict=True):
        total += w[1]
        assert (r.k, r.x, r.s) == (w[0], w[1], total)
    last = None
    seen = sorted(last_before(rows, ["k", "x"], "v", "last").collect(), key=lambda r: (r.k, r.x, r._row))
    for r in seen:
        last = r.v if r.v is not None else last
        assert r["last"] == last
