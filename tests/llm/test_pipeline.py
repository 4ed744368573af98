"""The pipeline's stages against brute force, each on its own input."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

import corpus_pipeline as P
from fleetlake.llm import pieces, quality, simhash
from fleetlake.llm.components import connected_components
from fleetlake.llm.runtime import table, written
from fleetlake.llm.vocabulary import PIECES_32K

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_equal_brute_force(spark, groups):
    docs = table(spark, SF, "documents")
    cols = docs.columns
    stages = dict(P.STAGES)
    assert list(stages) == ["quality_classifier", "exact_dedup", "simhash_near_dedup", "source_mix", "sentencepiece"]

    good = written(stages["quality_classifier"](spark, docs, SF), "t")
    model = quality.train(docs, quality.graded(table(spark, SF, "labels")), quality.GRADES)
    keep = set()
    for i, t in rows(docs).items():
        at, v = quality.text_features(t)
        if 1 - model.at_most((v @ model.weights[at]).reshape(1) if len(at) else [0.0] * 1)[0][0] >= 0.5:
            keep.add(i)
    assert set(rows(good)) == keep and good.columns == cols
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    assert all(i in keep for i, q in labels.items() if q == 1)

    single = written(stages["exact_dedup"](spark, good, SF), "t")
    last = defaultdict(int)
    for i, t in rows(good).items():
        last[t] = max(last[t], i)
    assert set(rows(single)) == set(last.values()) and single.columns == cols

    apart = written(stages["simhash_near_dedup"](spark, single, SF), "t")
    fp = {i: simhash.fingerprint(t) for i, t in rows(single).items()}
    g = groups(fp)
    for a in fp:
        for b in fp:
            if a < b and (fp[a] ^ fp[b]).bit_count() <= 2:
                g.link(a, b)
    assert set(rows(apart)) == {i for i in fp if g.find(i) == i} and apart.columns == cols

    mix = written(stages["source_mix"](spark, apart, SF), "t")
    assert mix.columns == cols and set(rows(mix)) <= set(rows(apart))
    assert mix.groupBy("doc_id").count().where("count > 3").count() == 0

    out = stages["sentencepiece"](spark, mix, SF)
    enc = pieces.Encoder(open(PIECES_32K, "rb").read(), 0.1, 1)
    texts, got, copies = rows(mix), defaultdict(list), 0
    for r in out.collect():
        assert r.round_trip
        got[r.doc_id].append(r.ids)
    for i, many in got.items():  # every epoch of a document draws its own merges
        names = [str(i)] + [f"{i}#{k}" for k in range(1, len(many))]
        assert sorted(many) == sorted(enc.encode([texts[i]], [n])[0].tolist() for n in names)
        copies += len(many) > 1 and len({tuple(x) for x in many}) == len(many)
    assert copies > 20 and sum(map(len, got.values())) == mix.count()
    whole = P.run(spark, SF)
    assert whole.count() == mix.count() and P.ORACLE_SQL is None


def test_pipeline_on_no_documents(spark, tmp_path):
    for t in ("documents", "labels"):
        table(spark, SF, t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    import __spark_entry__ as E
    names = [n for n in E.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in E.queries()


def test_components(spark, groups):
    rnd = random.Random(0)
    links = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(200)]
    links += [(k, k + 1) for k in range(1000, 1080)] + [(5000, k) for k in range(4000, 4400)] + [(7, 7), (None, 3)]
    want = groups({x for ab in links for x in ab if x is not None})
    for a, b in links:
        if a is not None and a != b:
            want.link(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: want.find(n) for n in {x for a, b in links if a is not None and a != b for x in (a, b)}}
    assert connected_components(spark.createDataFrame([], "a long, b long").withColumn("c", F.lit(1))).count() == 0
