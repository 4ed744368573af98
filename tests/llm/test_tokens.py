import random

import numpy as np
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from fleetlake.llm import pieces, token_counts
from fleetlake.llm.vocabulary import PIECES_32K, load

from .conftest import doc

SF = "/root/testdata/sf0.001"
MODEL = open(PIECES_32K, "rb").read()
ODD = [None, "", " ", "   ", "\n", " \n ", "a  b \n\n c\ttabé Ａ ﬁ", "  lead trail  ", "x" * 5000, "ab " * 3000, "日本語🙂\r\n",
       "▁▁ literal ▁", "<0x0A> <s>", "the " + "\x00\x7f"]


@pytest.fixture(scope="module")
def corpus(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]


def test_without_dropout_it_is_the_tokenizer(corpus):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES_32K)
    texts = [t for _, t in corpus] + [t for t in ODD if t and "▁" not in t]
    got = pieces.Encoder(MODEL, 0.0).encode(texts, ["d"] * len(texts))
    assert [g.tolist() for g in got] == sp.encode(texts)


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5, 1.0])
def test_round_trip_and_variety(corpus, dropout):
    texts = [t for _, t in corpus][:60] + ODD
    a = pieces.Encoder(MODEL, dropout, seed=3).encode(texts, [str(i) for i in range(len(texts))])
    again = pieces.Encoder(MODEL, dropout, seed=3).encode(texts, [str(i) for i in range(len(texts))])
    assert all((x == y).all() for x, y in zip(a, again, strict=True))
    assert [pieces.decode(MODEL, x) for x in a] == [t or "" for t in texts]
    n = [len(x) for x in pieces.Encoder(MODEL, 0.0).encode(texts, ["0"] * len(texts))]
    other = pieces.Encoder(MODEL, dropout, seed=4).encode(texts, [str(i) for i in range(len(texts))])
    if 0 < dropout < 1:
        assert any(len(x) != len(y) or (x != y).any() for x, y in zip(a, other, strict=True))
        assert sum(map(len, a)) > sum(n)
    if dropout == 1:  # no merge at all: single characters and bytes
        text = load(MODEL).text
        assert all(len(text[i]) <= 1 for x in a for i in x.tolist())


def test_rows_and_heap_agree():
    rnd = random.Random(1)
    chunks = ["".join(rnd.choice("abcdetionsr é|!Ａ▁") for _ in range(rnd.randint(1, 30))) for _ in range(500)]
    keys = [rnd.getrandbits(64) for _ in chunks]
    m = pieces._merges(MODEL)
    for cut in (0, 1 << 29, 1 << 31, 1 << 32):
        assert m.rows(chunks, keys, cut) == [m.long(c, k, cut) for c, k in zip(chunks, keys, strict=True)]


def test_every_occurrence_draws_its_own_merges():
    """A word's segmentations are as many in one line, in one text of many
    lines and over documents, and those of a heap keyed by document and place."""
    word, n = "international", 3000
    enc = pieces.Encoder(MODEL, 0.3, seed=5)
    line = enc.encode([" ".join([word] * n)], ["d"])[0]
    lines = enc.encode([("\n" + word) * n], ["d"])[0]
    over = enc.encode([word] * n, [f"d{i}" for i in range(n)])
    m = pieces._merges(MODEL)
    base = xxhash.xxh64_intdigest(b"d", 5)
    key = [pieces._mix1((base + i * pieces._A) & pieces._M) for i in range(n)]
    want = [m.long(" " + word, k, enc.cut) for k in key]
    assert line.astype("<i4").tobytes() == b"".join(want) and len(set(want)) > 20
    assert len({x.tobytes() for x in over}) > 20
    feed = enc.encode(["\n"], ["d"])[0][-1]
    cuts = [x.tobytes() for x in np.split(lines, np.flatnonzero(lines == feed))]
    assert len(set(cuts[1:])) > 20


def test_encode_table(spark, docs, corpus):
    df = docs([doc(i, t) for i, t in corpus[:80]] + [doc(1000 + i, t) for i, t in enumerate(ODD)] + [doc(None, "no id")] * 2)
    out = pieces.encode_documents(df)
    rows = out.collect()
    assert len(rows) == 80 + len(ODD) + 2 and all(r.round_trip and r.n_pieces == len(r.ids) for r in rows)
    back = {r.doc_id: r.text for r in pieces.decode_documents(out).collect() if r.doc_id is not None}
    assert all(back[i] == t for i, t in corpus[:80]) and all(back[1000 + i] == (t or "") for i, t in enumerate(ODD))
    assert pieces.encode_documents(docs([])).count() == 0
    extra = df.withColumn("ids", F.lit("x")).withColumn("_text", F.lit(None).cast("string"))
    assert pieces.encode_documents(extra).where("round_trip").count() == len(rows)


# ------------------------------------------------------------- token counts

def unigram():
    p = load(MODEL)
    vocab = [("<unk>", 0.0)] + [(t.replace(" ", "▁"), p.scores[i]) for t, i in p.ids.items()]
    vocab += [(f"<0x{b:02X}>", 0.0) for b in range(256)]
    return Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))


def brute(chunk):
    """Plain left-to-right relaxation over all pieces at every start."""
    p = load(MODEL)
    chunk = chunk.replace("▁", " ")
    worst = min(p.scores[i] for i in p.ids.values()) - 10.0
    best, count = [None] * (len(chunk) + 1), [0] * (len(chunk) + 1)
    best[0] = 0.0
    for s in range(len(chunk)):
        single = False
        for e in range(s + 1, min(len(chunk), s + 20) + 1):
            i = p.ids.get(chunk[s:e])
            if i is not None:
                single |= e == s + 1
                if best[e] is None or best[s] + p.scores[i] > best[e]:
                    best[e], count[e] = best[s] + p.scores[i], count[s] + 1
        if not single and (best[s + 1] is None or best[s] + worst > best[s + 1]):
            best[s + 1], count[s + 1] = best[s] + worst, count[s] + len(chunk[s].encode())
    return count[-1], best[-1]


def test_counts_equal_brute_force(corpus):
    v = token_counts.Viterbi(MODEL)
    rnd = random.Random(5)
    texts = [t[:300] for _, t in corpus[:60]] + [t for t in ODD if t]
    texts += ["".join(rnd.choice("abten éＡ▁") for _ in range(rnd.randint(1, 40))) for _ in range(300)]
    for t in texts:
        assert v.text(t) == brute(" " + t), t


def test_counts_equal_the_library(corpus):
    tok, v = unigram(), token_counts.Viterbi(MODEL)
    for _, t in corpus:
        assert v.text(t)[0] == len(tok.encode("▁" + t.replace(" ", "▁")).ids)


def test_count_table(spark, docs):
    df = docs([doc(i, t) for i, t in enumerate(ODD)] + [doc(None, "the end"), doc(3, "the end")] * 2)
    rows = token_counts.token_counts(df).collect()
    assert len(rows) == len(ODD) + 4
    assert [(r.n_tokens, r.score) for r in rows if r.doc_id in (0, 1)] == [(0, 0.0)] * 2
    assert token_counts.token_counts(docs([])).count() == 0
    assert token_counts.token_counts(df.withColumn("score", F.lit("x"))).count() == len(rows)
