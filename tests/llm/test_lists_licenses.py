import datetime as dt
import random

from pyspark.sql import functions as F

from fleetlake.llm import licenses as L
from fleetlake.llm import url_lists as U

from .conftest import doc

DAY = dt.datetime(2024, 1, 1)
ENTRY = "list string, effect string, match string, pattern string, action string, at timestamp_ntz"


def day(n):
    return DAY + dt.timedelta(days=n)


def brute(captures, entries):
    """Replay every entry's history for every capture."""
    out = []
    for i, url, at in captures:
        rest = url.split("://", 1)[1] if url and "://" in url else None
        head = rest.split("/")[0].split("?")[0].split("#")[0].split("@")[-1].split(":")[0].lower().rstrip(".") if rest else ""
        if not head:
            out.append((i, "invalid", None))
            continue
        if at is None:
            out.append((i, "undated", None))
            continue
        path = rest.split("?")[0].split("#")[0]
        segs = [s for s in path.split("/")[1:] if s]
        best = None
        for lst, eff, kind, pat in {e[:4] for e in entries if None not in e}:
            p = pat.strip().rstrip("/.")
            ph = p.split("/")[0].lower()
            if kind == "host":
                hit, rank = head == ph, 1_000_000
            elif kind == "domain":
                hit, rank = head == ph or head.endswith("." + ph), len(ph.split("."))
            else:
                ps = p.split("/")[1:]
                hit, rank = ps and head == ph and segs[:len(ps)] == ps, 2_000_000 + len(ps) + 1
            if not hit:
                continue
            past = sorted((e[5], e[4] == "add") for e in entries if e[:4] == (lst, eff, kind, pat) and None not in e and e[5] <= at)
            if past and past[-1][1]:
                best = min(best or (1,), (-rank, eff, lst, pat))
        out.append((i, "blocked" if best and best[1] == "block" else "allowed", best and best[3]))
    return sorted(out, key=str)


def test_random_histories(spark):
    rnd = random.Random(2)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org"]
    entries = []
    for _ in range(120):
        kind = rnd.choice(["host", "domain", "prefix"])
        h = rnd.choice(hosts)
        entries.append((rnd.choice("pq"), rnd.choice(["block", "allow"]), kind,
                        h + ("/" + rnd.choice(["u", "u/v", "w"]) if kind == "prefix" else ""),
                        rnd.choice(["add", "remove"]), day(rnd.randint(0, 20))))
    caps = [(i, f"http://{rnd.choice(hosts)}/{rnd.choice(['', 'u', 'u/v/z', 'w?q=1', 'uu'])}", day(rnd.randint(-1, 22)))
            for i in range(300)]
    df = spark.createDataFrame(caps, "page_id long, url string, fetched_at timestamp_ntz")
    got = [(r.page_id, r.verdict, r.pattern) for r in U.judge(df, spark.createDataFrame(entries, ENTRY)).collect()]
    assert sorted(got, key=str) == brute(caps, entries)


def test_list_edges(spark):
    entries = [("l", "block", "host", "A.com.", "add", day(1)), ("l", "block", "host", "A.com.", "remove", day(3)),
               ("l", "block", "host", "A.com.", "add", day(3)), (None, "block", "host", "c.com", "add", day(0)),
               ("l", "block", "host", None, "add", day(0)), ("l", "block", "host", "d.com", "add", None)]
    caps = [(1, None, day(2)), (2, "no url", day(2)), (3, "http://a.com", None), (4, "http://u:p@A.COM.:80/x", day(1)),
            (5, "http://a.com/", day(0)), (6, "ftp://a.com?x", day(3)), (7, "http://c.com/" + "s/" * 20000, day(5)),
            (None, "http://a.com", day(9)), (4, "http://u:p@A.COM.:80/x", day(1))]
    df = spark.createDataFrame(caps, "page_id long, url string, fetched_at timestamp_ntz")
    el = spark.createDataFrame(entries, ENTRY)
    got = sorted([(r.page_id, r.verdict) for r in U.judge(df, el).collect()], key=str)
    assert got == sorted([(1, "invalid"), (2, "invalid"), (3, "undated"), (4, "blocked"), (4, "blocked"), (5, "allowed"),
                          (6, "blocked"), (7, "allowed"), (None, "blocked")], key=str)
    assert U.judge(df.limit(0), el).count() == 0
    assert {r.verdict for r in U.judge(df, el.limit(0)).collect()} == {"invalid", "undated", "allowed"}
    extra = df.withColumn("key", F.lit(1)).withColumn("_cap", F.lit("x"))
    assert U.judge(extra, el.withColumn("rank", F.lit("x"))).count() == len(caps)


def test_license_cases(spark, docs):
    mit, gpl = L.TEMPLATES["MIT"], L.TEMPLATES["GPL-3.0"]
    filler = [doc(1000 + i, f"the words of page {i} under this and that work", f"z/{i % 3}/f{i}.txt") for i in range(60)]
    rows = [doc(1, mit, "a/LICENSE"), doc(2, "code without a notice", "a/b/c/x.py"), doc(3, gpl + "\n", "a/b/COPYING"),
            doc(4, "more code", "a/b/c/d/y.py"), doc(5, "text\n  " + mit.upper() + "\nmore text " * 300, "q/z.py"),
            doc(6, "nothing here", "q/w.py"), doc(7, None, "a/b/n.py"), doc(8, "", None), doc(9, "license " * 9, "r/x.py"),
            doc(10, "word " * 60000 + "\n" + gpl, "s/t.py"), doc(None, mit, "u/x"), doc(2, "code without a notice", "a/b/c/x.py"),
            doc(11, "the MIT licensee under version 3 of a general public", "v/x.py")]
    got = L.scan(docs(rows + filler), F.col("source")).collect()
    assert len(got) == len(rows) + 60
    by = {r.doc_id: (r.license, r.origin, r.from_folder) for r in got if r.doc_id is not None}
    assert by[1] == ("MIT", "header", None) and by[2] == ("GPL-3.0", "inherited", "a/b")
    assert by[4] == ("GPL-3.0", "inherited", "a/b") and by[5] == ("MIT", "header", None)
    assert by[6] == (None, "none", None) and by[7] == ("GPL-3.0", "inherited", "a/b") and by[8] == (None, "none", None)
    assert by[10] == ("GPL-3.0", "header", None) and by[1000] == (None, "none", None)
    assert L.scan(docs([]), F.col("source")).count() == 0
    extra = docs(rows).withColumn("unit", F.lit(1)).withColumn("_doc", F.lit("x")).withColumn("term", F.lit("t"))
    assert L.scan(extra, F.col("source")).count() == len(rows)


def test_licenses_and_lists_are_native(spark):
    sf = "/root/testdata/sf0.001"
    d, p = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/pages.parquet")
    for df in (L.scan(d, L.document_path(d)), U.judge(U.page_captures(p), U.page_entries(p))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_a_host_of_very_many_labels(spark):
    """Domains are tried as deep as the lists go, not as deep as a host goes."""
    host = "a." * 20_000 + "bad.example.org"
    t = dt.datetime(2024, 5, 1)
    caps = spark.createDataFrame([(1, f"http://{host}/x", t), (2, "http://org/", t), (3, "http://x.bad.example.org/", t)],
                                 "page_id long, url string, fetched_at timestamp")
    ddl = "list string, effect string, match string, pattern string, action string, at timestamp"
    one = [("l", "block", "domain", "bad.example.org", "add", dt.datetime(2024, 1, 1))]
    got = {r.page_id: r.verdict for r in U.judge(caps, spark.createDataFrame(one, ddl)).collect()}
    assert got == {1: "blocked", 2: "allowed", 3: "blocked"}
    only_host = [("l", "block", "host", "org", "add", dt.datetime(2024, 1, 1))]
    got = {r.page_id: r.verdict for r in U.judge(caps, spark.createDataFrame(only_host, ddl)).collect()}
    assert got == {1: "allowed", 2: "blocked", 3: "allowed"}


def test_licence_files_headers_and_notices(spark, docs):
    """Full texts, source headers, SPDX lines and notices inside a paragraph."""
    full = L.full_texts()
    assert set(full) == {"Apache-2.0", "BSD-3-Clause", "GPL-2.0", "GPL-3.0", "MIT", "MPL-2.0"}
    filler = [doc(1000 + i, f"the words of page {i} are about rivers and towns, and the roads of version {i % 7}", f"z/{i % 3}/f{i}.txt")
              for i in range(80)]
    rows, want = [], {}

    def add(text, path, license):
        i = len(rows)
        rows.append(doc(i, text, path))
        want[i] = license
    for name, text in full.items():
        owned = "Copyright (c) 2021 Some Person. All rights reserved.\n\n" + text
        add(owned, f"full-{name}/COPYING", name)
        add("print(1)", f"full-{name}/src/deep/x.py", name)
        wrapped = "\n".join(" * " + line for line in L.HEADERS.get(name, L.TEMPLATES.get(name, "")).replace(", ", ",\n").split("\n"))
        add("/*\n" + wrapped + "\n */\n\nint main() { return 0; }\n" * 3, f"head-{name}/a.c", name)
        add(f"// SPDX-License-Identifier: {L.SPDX[name][0]}\nint f();\n" + "int g();\n" * 40, f"spdx-{name}/a.c", name)
    for name in ("Apache-2.0", "MIT", "GPL-3.0", "CC-BY-4.0"):
        around = "the river runs past many towns and roads here and there " * 4
        add(around + L.TEMPLATES[name] + " " + around, f"para-{name}/a.txt", name)
    add("// SPDX-License-Identifier: ISC\nint f();\n", "other/a.c", None)
    add("a river of words " * 3000, "other/b.c", None)
    got = {r.doc_id: r for r in L.scan(docs(rows + filler), F.col("source")).collect()}
    assert {i: got[i].license for i in want} == want
    deep = [r for r in got.values() if r.folder.endswith("/src/deep")]
    assert len(deep) == len(full) and all(r.origin == "inherited" and r.from_folder == r.folder.split("/")[0] for r in deep)
    assert all(got[i].license is None for i in range(1000, 1080))


def test_readme_speaks_for_its_folder_and_long_texts_are_cut_everywhere(spark, docs):
    mit = L.TEMPLATES["MIT"]
    rows = [doc(1, "a town by the river " * 50 + mit + " and more words " * 50, "p/README.md"), doc(2, "code", "p/q/x.py"),
            doc(3, "a town by the river " * 50 + mit + " and more words " * 50, "r/notes.md"), doc(4, "code", "r/q/x.py")]
    rows += [doc(10 + k, "word " * (L.CHUNK - 6 + k) + mit + " word" * 7, f"c{k}/x.md") for k in range(12)]
    got = {r.doc_id: (r.license, r.origin) for r in L.scan(docs(rows), F.col("source")).collect()}
    assert got[1] == got[3] == ("MIT", "header") and got[2] == ("MIT", "inherited") and got[4] == (None, "none")
    assert all(got[10 + k] == ("MIT", "header") for k in range(12))
    one = L.scan(docs(rows), F.col("source"), templates={"X": "a town by the river"}).where("license = 'X' AND origin = 'header'")
    assert {r.doc_id for r in one.collect()} == {1, 3}
