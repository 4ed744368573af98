import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import lm

from .conftest import doc

SF = "/root/testdata/sf0.001"


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute_base(rows):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    c = Counter(w for i, t in rows if not held[i] for w in tokens(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        ws = tokens(t)
        out.append((i, held[i], len(ws), sum(c[w] > 0 for w in ws), n,
                    round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)))
    return sorted(out, key=str)


@pytest.mark.parametrize("frequent", [1 << 18, 50, 0])
def test_base_scores_equal_brute_force(spark, frequent):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = lm.lm_scores(docs, frequent=frequent, share=1 / 60, rounds=1).collect()
    got = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out], key=str)
    assert got == brute_base(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)


def test_model_beats_the_base_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lm.lm_scores(docs).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > out[1] + 0.03 * abs(out[1]) * 0.5


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(0)
    prior = np.full(9, 1 / 9)
    m = lm.Model.start(prior, 4, 1)
    keys = rng.integers(0, 9 ** 3, 400)
    m = lm.train(m, prior, np.unique(keys), np.ones(len(np.unique(keys))), 3, noise=8, batch=64, least_steps=20)
    s = lm.Scorer(m)
    for h2 in range(9):
        for h1 in range(9):
            p = np.exp(s(np.full(9, h2), np.full(9, h1), np.arange(9)))
            assert abs(p.sum() - 1) < 1e-5
    # words of the rare class: (c + 1) / (tokens + types + 1), and one unit unseen
    c = [3, 1, 1]
    assert abs(sum((x + 1) / (sum(c) + len(c) + 1) for x in c) + 1 / (sum(c) + len(c) + 1) - 1) < 1e-12


def test_training_learns_a_rule():
    """A class that always follows another gets most of the probability."""
    n = 6
    rng = np.random.default_rng(1)
    seq = []
    for _ in range(3000):
        a = int(rng.integers(2, 5))
        seq += [a, 5 if a == 2 else int(rng.integers(2, 5))]
    keys, w = np.unique(lm.trigrams([np.array([*seq, lm.END])], n), return_counts=True)
    prior = np.bincount(np.array(seq), minlength=n) + 1.0
    prior /= prior.sum()
    m = lm.train(lm.Model.start(prior, 8, 0), prior, keys, w, 0, noise=64, batch=64, least_steps=2000, rate=0.1)
    p = np.exp(lm.Scorer(m)(np.array([3]), np.array([2]), np.array([5])))[0]
    assert p > 3 * prior[5]


@pytest.mark.parametrize("size", [3_000, 200_000])
def test_an_epoch_weighs_trigrams_as_tokens(size):
    rng = np.random.default_rng(size)
    counts = np.minimum(rng.zipf(1.5, size), size)
    counts[0] = counts.sum() // 4  # a hot trigram
    at, share = lm.shares(counts, lm.BATCH)
    steps = -(-len(at) // lm.BATCH)
    assert len(at) <= len(counts) * (1 + 1 / lm.SPLIT)
    assert np.allclose(np.bincount(at, share) / steps, counts / counts.sum(), rtol=1e-5)
    order = rng.permutation(len(at))
    mass = [share[order[k:k + lm.BATCH]].sum() for k in range(0, len(at) - lm.BATCH, lm.BATCH)]
    assert steps < 3 or max(mass) < 1.5 * min(mass)


@pytest.mark.parametrize("words", [64, 640])
def test_training_keeps_the_counts(words):
    """One trigram with half of the tokens gets half of the probability,
    however many batches the others fill."""
    n = words + 2
    counts = np.full(words, 100)
    counts[0] = 100 * (words - 1)
    keys = (lm.END * n + lm.END) * n + 2 + np.arange(words)
    prior = np.full(n, 1 / n)
    m = lm.train(lm.Model.start(prior, 4, 0), prior, keys, counts, 0, noise=64, batch=16, least_steps=3000, rate=0.1)
    e = np.array([lm.END])
    assert 0.4 < np.exp(lm.Scorer(m)(e, e, np.array([2])))[0] < 0.6


def test_scores_follow_from_the_corpus_alone(spark):
    """1, 4 and 16 input parts, rows in another order, small shards."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {}
    for parts in (1, 4, 16):
        df = docs.orderBy(F.rand(parts)).repartition(parts)
        for shard_tokens in (lm.SHARD_TOKENS, 20_000):
            rows = df.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
            if shard_tokens != lm.SHARD_TOKENS:
                learn = rows.where(~lm.held_out("_id"))
                vocab = lm.vocabulary(lm.word_counts(learn))
                shared = spark.sparkContext.broadcast(vocab)
                got[parts, shard_tokens] = lm.fit(learn, vocab, shared, rounds=2, shard_tokens=shard_tokens).flat()
            else:
                got[parts, shard_tokens] = np.array(
                    [r.score for r in lm.lm_scores(df).orderBy("doc_id").collect()])
    for (parts, tokens), x in got.items():
        assert np.abs(x - got[1, tokens]).max() < 1e-6, (parts, tokens)


def test_score_equals_brute_force(spark, docs):
    """Every probability of a small corpus by loops over the whole vocabulary."""
    texts = ["the cat sat on the mat", "the dog sat on a log and the cat ran", "a cat and a dog", None, "mats cats dogs the the",
             "unseen catkin on zebra"]
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2][:1]
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 != 2][:5] + held
    df = docs([doc(i, t) for i, t in zip(ids, texts)])
    for frequent in (1 << 18, 4):
        rows = df.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
        learn = rows.where(~lm.held_out("_id"))
        vocab = lm.vocabulary(lm.word_counts(learn), share=1 / 12, frequent=frequent)
        model = lm.fit(learn, vocab, spark.sparkContext.broadcast(vocab))
        count = Counter(w for t in texts[:5] for w in tokens(t) if w)
        assert vocab.mass.sum() == sum(count.values()) + 5 and vocab.members.sum() + vocab.singles == len(count)

        def class_of(w, vocab=vocab):
            if w is None:
                return lm.END
            w = w.encode()
            return vocab.words.index(w) + 2 if w in vocab.words[:vocab.singles] else vocab.by_ending(w)

        def log_p(h2, h1, w, vocab=vocab, model=model, class_of=class_of):
            a = model.r[h1] @ model.c1 + model.r[h2] @ model.c2
            s = [float(a @ model.q[c] + model.b[c]) for c in range(vocab.classes)]
            c = class_of(w)
            out = s[c] - math.log(sum(math.exp(x) for x in s))
            if w is not None and not 1 < c < vocab.singles + 2:
                same = [x for x in count if class_of(x) == c]
                out += math.log((count[w] + 1) / (sum(count[x] for x in same) + len(same) + 1))
            return out / math.log(10)

        assert vocab.classes > vocab.singles + 3  # endings make classes
        got = {r.doc_id: r.score for r in lm.lm_scores(df, share=1 / 12, frequent=frequent).collect()}
        for i, t in zip(ids, texts):
            h2, h1, total = lm.END, lm.END, 0.0
            for w in tokens(t):
                total += log_p(h2, h1, w)
                h2, h1 = h1, class_of(w)
            assert abs(total - got[i]) < 1e-3, (i, total, got[i])


def test_trigrams_cross_no_texts():
    n = 10
    got = lm.trigrams([np.array([4, 5, 1]), np.array([1]), np.array([6, 1])], n)
    want = [(1, 1, 4), (1, 4, 5), (4, 5, 1), (1, 1, 1), (1, 1, 6), (1, 6, 1)]
    assert [(k // 100, k // 10 % 10, k % 10) for k in got.tolist()] == want


def test_edges(spark, docs):
    long = " ".join(f"w{i % 301}" for i in range(60000))
    rows = [doc(i, t) for i, t in enumerate([None, "", "a", "A b", long, "b " * 7, "unseen words", "\t"])]
    rows += [doc(None, "a b"), doc(3, "A b"), doc(3, "A b")]
    df = docs(rows)
    got = lm.lm_scores(df, frequent=3, share=1 / 4, rounds=1).collect()
    want = brute_base([(r[0], r[1]) for r in rows])
    assert sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got],
                  key=str) == want
    assert lm.lm_scores(docs([])).count() == 0
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    none = lm.lm_scores(docs([doc(i, "x y") for i in held])).collect()  # no training document
    assert [(r.n_known, r.train_tokens, r.base_score) for r in none] == [(0, 0, 0.0)] * 3
    extra = df.withColumn("base", F.lit(1)).withColumn("_row", F.lit("x")).withColumn("known", F.lit(None).cast("int"))
    assert lm.lm_scores(extra, rounds=1).count() == len(rows)


@pytest.mark.parametrize("n", [5, 300, 70_000])
@pytest.mark.parametrize("rows", [0, 1, 2000])
def test_sums_of_rows_by_place(n, rows):
    rng = np.random.default_rng(n + rows)
    at, values = rng.integers(0, n, rows), rng.integers(-9, 9, (rows, 3)).astype(np.float32)
    want = np.zeros((n, 3), np.float32)
    np.add.at(want, at, values)
    assert (lm._sum_rows(at, values, n) == want).all()
