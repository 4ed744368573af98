import numpy as np
from pyspark.sql import functions as F

from fleetlake.llm import quality as Q

from .conftest import doc


def test_gradient_is_the_likelihoods():
    """One small step lowers the loss; many steps find ordered grades."""
    rng = np.random.default_rng(0)
    rows, grades = [], []
    for _ in range(300):
        x = rng.normal()
        grades.append(int(np.digitize(x + rng.logistic() * 0.1, [-0.5, 0.7])))
        rows.append((np.array([5, 9]), np.array([x, 1.0])))
    m = Q.fit(rows, np.array(grades), 3, steps=300)
    assert m.thresholds[0] < m.thresholds[1] and m.weights[5] > 1
    s = np.array([v @ m.weights[a] for a, v in rows])
    order = [np.mean(s[np.array(grades) == g]) for g in range(3)]
    assert order == sorted(order)
    right = np.mean((m.at_most(s) < 0.5).sum(axis=1) == np.array(grades))
    assert right > 0.8
    assert ((np.diff(m.at_most(s), axis=1) >= 0).all() and (0 <= m.expected(s)).all() and (m.expected(s) <= 2).all())


def test_scores_equal_plain_features(spark):
    """The cached word sums are the dot product of features and weights."""
    rng = np.random.default_rng(1)
    w = Q._Words(rng.normal(size=Q.BUCKETS))
    for t in ["a b B!! b b c", "", None, "x", "é É | | 12 ok***", "word " * 1000]:
        at, v = Q.text_features(t)
        assert abs(Q.text_score(w, t) - (float(v @ w.w[at]) if len(at) else 0.0)) < 1e-9


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), Q.graded(spark.read.parquet(f"{sf}/labels.parquet"))
    held = F.xxhash64(F.lit(9), "doc_id") % 4 == 0
    m = Q.train(docs, labels.where(~held), Q.GRADES, sample=1500)
    out = (Q.with_quality(docs.join(labels.where(held), "doc_id"), m).groupBy("grade")
           .agg(F.avg((F.col("p_good") >= 0.5).cast("int")).alias("kept"), F.avg("expected_grade").alias("e")).collect())
    by = {r.grade: r for r in out}
    assert by[2].kept > 0.99 and by[1].kept > 0.95 and by[0].kept < 0.05
    assert by[0].e < by[1].e < by[2].e


def test_edges(spark, docs):
    junk, fine = "OF!! THE!! AND!!", "the of and in to"
    rows = [doc(i, junk if i % 2 else fine) for i in range(40)]
    rows += [doc(100, None), doc(101, ""), doc(102, "the " * 50000), doc(None, fine), doc(0, fine), doc(0, fine)]
    df = docs(rows)
    labels = spark.createDataFrame(
        [(i, (i + 1) % 2, 0) for i in range(40)] + [(3, 0, 0), (None, 1, 0), (5, None, None), (999, 1, 1)],
        "doc_id long, quality int, toxic int")
    out = Q.quality_table(df, labels).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert all(by[i].selected == (i % 2 == 0) for i in range(40)) and by[100].p_good == by[101].p_good
    assert Q.quality_table(docs([]), labels).count() == 0
    none = Q.quality_table(df, labels.limit(0)).collect()
    assert len(none) == len(rows) and len({round(r.p_good, 9) for r in none}) == 1
    extra = df.withColumn("p_good", F.lit("x")).withColumn("_good", F.lit(1)).withColumn("_text", F.lit(None).cast("int"))
    kept = Q.quality_filter(extra, labels)
    assert kept.columns == extra.columns and {r.doc_id for r in kept.collect()} >= {0, 2, 4}
    assert Q.quality_table(extra, labels).count() == len(rows)


def test_repeated_ids_and_tails(spark, docs):
    """Documents that share an id with other texts, in any order."""
    junk, fine = "OF!! THE!! AND!!", "the of and in to"
    rows = [doc(i % 40, f"{junk if k else fine} w{i}") for k in (0, 1) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 3 > 0, i % 3 == 1) for i in range(40)], "doc_id long, quality boolean, toxic boolean")
    labels = labels.selectExpr("doc_id", "int(quality) quality", "int(toxic) toxic")
    want = None
    for parts, order in ((1, rows), (5, rows[::-1]), (3, rows[::2] + rows[1::2])):
        out = Q.quality_table(docs(order).repartition(parts), labels).collect()
        got = sorted((r.doc_id, round(r.expected_grade, 9), round(r.p_good, 9), round(r.p_clean, 9)) for r in out)
        assert want in (None, got)
        want = got
    assert all(0 <= c <= g <= 1 and abs(e - g - c) < 1e-6 for _, e, g, c in want)
