import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from fleetlake.llm import queries, spelling

from .conftest import doc

SF = "/root/testdata/sf0.001"


def brute_words(rows, typo_rate=31, least=7, occurrences=2):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if typo_rate and h % typo_rate == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= occurrences}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[at + 1:] == b[at + 1:] if len(a) == len(b) else a[at:] == b[at + 1:]


def brute(vocab, ratio=10):
    """All pairs, blocked only by the halves that one edit cannot both touch."""
    blocks, near = defaultdict(set), defaultdict(set)
    for w in vocab:
        half = len(w) // 2
        for k in (-1, 0, 1):
            blocks[0, len(w), w[:half + k]].add(w), blocks[1, len(w), w[half + k:]].add(w)
    for w in vocab:
        half = len(w) // 2
        for m in (len(w) - 1, len(w), len(w) + 1):
            other = m // 2
            for k in (-1, 0, 1):
                near[w] |= {x for x in blocks[0, m, w[:other + k]] if one_edit(w, x)}
                if other + k <= m:
                    near[w] |= {x for x in blocks[1, m, w[len(w) - (m - other - k):]] if one_edit(w, x)}
    form = {}
    for w, xs in near.items():
        if xs:
            best = min(xs, key=lambda x: (-vocab[x], x))
            if vocab[best] >= ratio * vocab[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, form.get(w), root(w), n, len(near[w]), vocab[form[w]] if w in form else None) for w, n in vocab.items())


def test_whole_table_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(map(tuple, queries.op11_spelling_variants(spark, SF).collect()))
    assert got == brute(brute_words(rows))
    assert any(r[1] for r in got)


def test_small_alphabet_every_pair(spark):
    """Dense words: every edit position, repeated letters, all pairs tried."""
    words = sorted({f"{k:07b}".translate(str.maketrans("01", "ab")) for k in range(128)}
                   | {f"{k:08b}".translate(str.maketrans("01", "ab")) for k in range(0, 256, 3)})
    vocab = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = {(r.word, r.near) for r in spelling.near_words(vocab).collect()}
    assert got == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_edges_of_input(spark, docs):
    long = "ab" * 120
    rows = [doc(1, None), doc(2, ""), doc(3, "Straße straße STRASSE strasse"), doc(4, "étendue ÉTENDUE Étendue"),
            doc(5, ("garden " + "gardens ") * 20 + "gardenx gardenx " + "gardening " * 20),
            doc(None, "gardens gardens"), doc(5, "gardens"), doc(6, f"{long} {long}x x{long} " * 2),
            doc(7, f"{long[:95]} {long[:96]} {long[:97]} " * 2), doc(8, "short words only " * 3), doc(9, "x" * 300_000)]
    df = docs(rows).withColumn("word", F.lit("z")).withColumn("n", F.lit(1)).withColumn("_id", F.lit("q"))
    got = sorted(map(tuple, spelling.spelling_variants(df).collect()))
    assert got == brute(brute_words([(r[0], r[1]) for r in rows]))
    assert spelling.spelling_variants(docs([])).count() == 0


def test_chain_of_forms(spark, docs):
    rows = [doc(1, "colourx " * 2 + "colours " * 20 + "coloures " * 200 + "colouress " * 2000)]
    got = {r.word: (r.form, r.root) for r in spelling.spelling_variants(docs(rows), typo_rate=0).collect()}
    assert got["colourx"] == ("colours", "colouress") and got["coloures"] == ("colouress", "colouress")
    assert got["colouress"] == (None, "colouress")
