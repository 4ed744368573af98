import hashlib
import re

from pyspark.sql import functions as F

from fleetlake.llm import infill, queries

from .conftest import doc

SF = "/root/testdata/sf0.001"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(i, text, rate=50, spm_rate=80):
    text = text or ""
    units = UNIT.findall(text)
    assert "".join(units) == text
    h = hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", text, None, None
    if h4 % 100 < spm_rate:
        return len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op13_fill_in_middle(spark, SF).collect()
    assert len(got) == len(rows) and {r.form for r in got} == {"plain", "psm", "spm"}
    for r in got:
        n, form, out, p, m = brute(r.doc_id, rows[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, p, m)
        assert r.output_sha256 == sha(out) and r.restored_sha256 == sha(rows[r.doc_id] or "")


def test_edges(spark, docs):
    texts = [None, "", " ", "one", "  lead and trail \n", "a <P> b", "a <S> b", "x <M>", "<", "<P", "S>", "a <\tP> $1 \\2 b",
             "𝒳 é b  c", "w " * 100_000, "w" * 300_000, "\x0b\x0c" * 7, "a\x00b c", "half <S half > M> <"]
    rows = [doc(i, t) for i in (None, *range(20)) for t in texts[:13]] + [doc(i, t) for i in range(3) for t in texts[13:]]
    df = docs(rows).withColumn("n", F.lit(3)).withColumn("form", F.lit("x")).withColumn("_a", F.lit(9))
    for rate, spm in ((50, 80), (100, 50)):
        out = infill.fill_in_middle(df, rate=rate, spm_rate=spm)
        out = out.withColumn("back", infill.restored(F.col("output"), F.col("form")))
        got = sorted(((r.doc_id, r.text, r.n, r.form, r.output) for r in out.collect()), key=str)
        want = [(i, t or "", *brute(i, t, rate, spm)[:3]) for i, t, *_ in rows]
        assert got == sorted(want, key=str)
        assert out.where("back <> text or back is null").count() == 0
    assert infill.fill_in_middle(docs([])).count() == 0


def test_native(spark):
    plan = queries.op13_fill_in_middle(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Exchange"))
