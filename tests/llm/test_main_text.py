import html
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fleetlake.llm import main_text, queries

SF = "/root/testdata/sf0.001"
DDL = "page_id long, url string, html string"


def test_whole_table_article(spark):
    """The generated pages by a plain reading of their markup."""
    got = {r.page_id: r for r in queries.op12_main_text(spark, SF).collect()}
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    assert len(got) == len(pages)
    for p in pages:
        body = re.search(r"<article>(.*?)</article>", p.html, re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<(?!/?(?:p|h1)>)[^>]*>", " ", x)).split())
                 for x in re.split(r"</?(?:p|h1)>", body)]
        assert got[p.page_id].text == "\n\n".join(x for x in parts if x)
        assert got[p.page_id].n_chars == len(got[p.page_id].text) and got[p.page_id].n_cut == 0


CASES = [
    (None, []), ("", []), ("just text", [("open", "just text")]),
    ("<p>a &amp; b<br>c&nbsp;d &lt;x&gt;</p>", [("open", "a & b c d <x>")]),
    ("<ARTICLE><h1>T</h1><p>one<p>two <b>bold</b>er</ARTICLE>tail",
     [("article", "T"), ("article", "one"), ("article", "two bolder"), ("open", "tail")]),
    ("<article>a<div class='related-posts'>r</div><aside>s</aside><form>f</form><p>b</p>"
     "<section id=comments><article>c</article></section></article>", [("article", "a"), ("chrome", "r"), ("chrome", "s"),
                                                                       ("chrome", "f"), ("article", "b"), ("chrome", "c")]),
    ("<body class='has-sidebar'><div class='sidebar-wrapper'>x<main>m</main></div><header>h</header>"
     "<div id=cookie-notice>k</div></body>", [("hull", "x"), ("article", "m"), ("hull", "h"), ("hull", "k")]),
    ("<script>var a = '<p>no</p>';</script><style>p{}</style><p>yes</p><script>open <p>gone", [("open", "yes")]),
    ("<!-- <p>no</p> --><!DOCTYPE html><?php x ?><p>a < b and 3<4</p><!-- never closed <p>no",
     [("open", "a < b and 3<4")]),
    ("<p title=\"a > b\">x</p><p title=it's>y</p><p", [("open", "x"), ("open", "y")]),
    ("<ul><li>a<li>b</ul><td>c</td></div></p>d", [("open", "a"), ("open", "b"), ("open", "c"), ("open", "d")]),
    ("<nav>n<article>m</article></nav>", [("chrome", "n"), ("chrome", "m")]),
]


def test_blocks():
    for page, want in CASES:
        assert list(main_text.blocks(page or "")) == want, page
    for page in ("<" * 100_000, "<p " * 100_000, "<a '" * 100_000, "<div>" * 100_000, "</p>" * 100_000, "<!--" * 100_000,
                 "<script>" * 100_000, "<p><b>x" * 50_000 + "</p>" * 100_000, "&" * 200_000):
        list(main_text.blocks(page))  # in one pass each


FOOT = "This site is run by the friends of long footers since 1999"
MENU = ["Home page", "All news", "Contact the team", "About"]


def site(k, host, unique):
    menu = "".join(f"<div>{m}</div>" for m in MENU)
    return f"http://{host}.example.org/{k}", f"<html><body>{menu}<div>{unique}</div><div>{FOOT}</div></body></html>"


def brute(pages):
    """Every window of every page of a host compared as text."""
    streams, seen = {}, defaultdict(set)
    for k, (url, page) in enumerate(pages):
        host = (re.search(r"://([^/]*)", url or "") or ["", ""])[1]
        bs = list(main_text.blocks(page or ""))
        tokens = [(z, n, w) for n, (z, t) in enumerate(bs) if z != "article" for w in (*t.split(), "\n")]
        streams[k] = host, bs, tokens
        for p in range(len(tokens) - main_text.RUN + 1):
            seen[host, tuple(w for _, _, w in tokens[p:p + main_text.RUN])].add(k)
    out = []
    for k, (host, bs, tokens) in streams.items():
        hit = set()
        for p in range(len(tokens) - main_text.RUN + 1):
            if len(seen[host, tuple(w for _, _, w in tokens[p:p + main_text.RUN])]) > 1:
                hit.update(range(p, p + main_text.RUN))
        article = [t for z, t in bs if z == "article"]
        kept, whole, at = [], [], 0
        for n, (z, t) in enumerate(bs):
            if z == "article":
                continue
            words = t.split()
            marks = "".join("x" if at + j in hit else "." for j in range(len(words)))
            at += len(words) + 1
            if z == "open":
                whole.append(t)
                long = "x{%d,}" % min(main_text.RUN, len(words))
                gone = {j for m in re.finditer(long, marks) for j in range(*m.span())}
                rest = [w for j, w in enumerate(words) if j not in gone]
                kept += [" ".join(rest)] if rest else []
        out.append("\n\n".join(article or kept or whole))
    return out


def test_suffix_array_cuts_what_a_host_repeats(spark):
    pages = [site(k, host, f"{host} page {k} tells " + " ".join(f"w{k}x{j}" for j in range(30)))
             for host in ("a", "b") for k in range(25)]
    pages += [site(90, "c", "the only page of its host keeps all")]
    pages += [("http://a.example.org/z", "<article>an article " + FOOT + "</article>"), (None, None), ("no url", ""),
              ("http://d.example.org/1", "<p>the same text on two pages of the host d</p>"),
              ("http://d.example.org/2", "<p>the same text on two pages of the host d</p>")]
    rows = [(k, *p) for k, p in enumerate(pages)]
    df = spark.createDataFrame(rows, DDL).withColumn("row", F.lit(1)).withColumn("text", F.lit("x"))
    for parts in (1, 7):
        out = sorted(main_text.main_text(df.repartition(parts)).collect())
        assert [r.text for r in out] == brute(pages)
    assert out[3].text.startswith("a page 3 tells w3x0") and FOOT not in out[3].text and out[3].n_cut > 10
    assert FOOT in out[50].text and FOOT in out[51].text and out[54].text == out[55].text != ""


def test_empty_null_and_repeats(spark):
    rows = [(None, None, None), (1, "u", "<p>x</p>"), (1, "u", "<p>x</p>"), (2, None, "<article>" + "y " * 300_000)]
    out = main_text.main_text(spark.createDataFrame(rows, DDL))
    assert sorted((r.page_id or 0, r.text[:3], r.n_chars) for r in out.collect()) == [
        (0, "", 0), (1, "x", 1), (1, "x", 1), (2, "y y", 599_999)]
    assert main_text.main_text(spark.createDataFrame([], DDL)).count() == 0


def test_the_array_runs_over_whole_pages(spark):
    """Repeated words of all pages, declared articles too, by brute force."""
    song = "and so the whole village sang until the lamps went out"
    tail = [" ".join(f"u{k}y{j}" for j in range(20)) for k in range(14)]
    pages = [(f"http://{host}.example.org/{k}", f"<nav>{' '.join(MENU)} and all the rest</nav><article><h1>T {k}</h1><p>{song} {t}"
              f"<p>{t} {song if k % 2 else ''}</article><div>x{k} {FOOT}</div>")
             for host, ks in (("a", range(10)), ("b", range(10, 13))) for k, t in zip(ks, tail[ks[0]:])]
    pages += [("http://c.example.org/1", f"<article>{song} alone on its host</article>"),
              ("http://a.example.org/n", f"<p>{song} told without an article</p><p>{FOOT}</p>"), (None, None)]
    streams, seen = [], defaultdict(set)
    for k, (url, page) in enumerate(pages):
        host, bs = (re.search(r"://([^/]*)", url or "") or ["", ""])[1], list(main_text.blocks(page or ""))
        for article in (False, True):
            words = [w for z, t in bs if (z == "article") == article for w in (*t.split(), "\n")]
            runs = [(host, article, *words[p:p + main_text.RUN]) for p in range(len(words) - main_text.RUN + 1)]
            streams.append((words, runs))
            for run in runs:
                seen[run].add(k)
    counts = [len({j for p, run in enumerate(runs) if len(seen[run]) > 1
                   for j in range(p, p + main_text.RUN) if words[j] != "\n"}) for words, runs in streams]
    want = [(k, a + b, b) for k, (a, b) in enumerate(zip(counts[::2], counts[1::2]))]
    for parts in (1, 5):
        df = spark.createDataFrame([(k, *p) for k, p in enumerate(pages)], DDL).repartition(parts)
        out = sorted(main_text.main_text(df).collect())
        assert [(r.page_id, r.n_repeated, r.n_restored) for r in out] == want
        assert all(r.n_cut == 0 and song in r.text for r in out[:14])
    assert out[0].n_restored == 11 and out[13].n_repeated == 0 and out[14].text.startswith(song)


def test_runs_that_begin_with_their_host(spark):
    pages = [(f"http://h{k}.org/", f"<p>page {k}</p><p>h{k}.org tells the same seven words on hosts</p>") for k in range(30)]
    pages += [(f"http://h.org/{k}", f"<p>page {k}</p><p>h.org tells the same seven words on hosts</p>") for k in range(2)]
    out = sorted(main_text.main_text(spark.createDataFrame([(k, *p) for k, p in enumerate(pages)], DDL)).collect())
    assert [r.text for r in out] == brute(pages)
    assert [r.n_cut for r in out] == [0] * 30 + [8] * 2


@pytest.mark.parametrize(("chunk", "spare"), [(5_000, 7), (40_000, -8)])
def test_any_chunks_and_bits_give_the_same_rows(spark, monkeypatch, chunk, spare):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = sorted(main_text.main_text(pages).collect())
    assert sum(r.n_repeated for r in want) > sum(r.n_restored for r in want) > 0
    monkeypatch.setattr(main_text, "CHUNK", chunk)
    monkeypatch.setattr(main_text, "CHUNKS_A_BUCKET", 1)
    monkeypatch.setattr(main_text, "SPARE_BITS", spare)
    assert sorted(main_text.main_text(pages).collect()) == want
