import random

import pytest
import xxhash
from pyspark.sql import functions as F

from fleetlake.llm import simhash

from .conftest import doc

SF = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, cur = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows, groups, bits=2):
    fp = {i: slow_fingerprint(t) for i, t in rows}
    g = groups(fp)
    ids = sorted(fp)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if (fp[a] ^ fp[b]).bit_count() <= bits:
                g.link(a, b)
    return {i: (f"{fp[i]:016x}", g.find(i)) for i in ids}


def test_whole_table_equals_brute_force(spark, groups):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], groups)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_components(docs).collect()}
    assert got == want
    kept = {r.doc_id for r in simhash.simhash_dedup(docs).collect()}
    assert kept == {i for i, (_, c) in want.items() if i == c}


def test_hash_is_sparks_xxhash64(spark):
    got = spark.sql("select xxhash64('a b c') h").first().h
    assert simhash.fingerprint("A b\tC") == got % (1 << 64)


@pytest.mark.parametrize("bits", [0, 1, 2])
@pytest.mark.parametrize("limit", [2, 64])
def test_links_of_random_and_crowded_prints(spark, groups, bits, limit):
    rnd = random.Random(bits)
    prints = {rnd.getrandbits(64) for _ in range(40)}
    for base in list(prints)[:6]:
        for _ in range(12):
            p = base
            for b in rnd.sample(range(64), rnd.randint(1, 3)):
                p ^= 1 << b
            prints.add(p)
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    want = groups(prints)
    for k, a in enumerate(prints):
        for b in prints[k + 1:]:
            if ((a ^ b) % (1 << 64)).bit_count() <= bits:
                want.link(a, b)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = simhash.close_links(df, bits, limit=limit).collect()
    got = groups(prints)
    for r in links:
        assert ((r.a ^ r.b) % (1 << 64)).bit_count() <= bits
        got.link(r.a, r.b)
    assert [got.find(p) for p in prints] == [want.find(p) for p in prints]


def test_edges(spark, docs):
    long = " ".join(f"w{i % 977}" for i in range(70000))
    rows = [doc(5, None), doc(3, ""), doc(9, " \t\n"), doc(1, "one"), doc(2, "ONE"), doc(7, long), doc(8, long),
            doc(None, "alone here now"), doc(4, "same same same"), doc(4, "same same same")]
    got = [(r.doc_id, r.fingerprint, r.component_id) for r in simhash.simhash_components(docs(rows)).collect()]
    by = {(i, c) for i, _, c in got}
    assert {(5, 3), (3, 3), (9, 3), (1, 1), (2, 1), (7, 7), (8, 7), (4, 4)} <= by and len(got) == len(rows)
    assert (None, None) in by
    kept = sorted((r.doc_id is None, r.doc_id or 0) for r in simhash.simhash_dedup(docs(rows)).collect())
    assert kept == [(False, 1), (False, 3), (False, 4), (False, 7), (True, 0)]
    assert simhash.simhash_components(docs([])).count() == 0
    extra = docs(rows).withColumn("fp", F.lit(1)).withColumn("_rid", F.lit("x")).withColumn("group", F.lit(None).cast("int"))
    out = simhash.simhash_dedup(extra)
    assert out.columns == extra.columns and out.count() == 5
    assert simhash.simhash_components(extra).count() == len(rows)
