"""The registered queries of the corpus operators: thin wrappers with the
production parameters, over whole tables. ``ORACLE`` holds DuckDB SQL where
SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    exact,
    infill,
    licenses,
    lm,
    main_text,
    mixing,
    near_vectors,
    pieces,
    quality,
    simhash,
    spelling,
    token_counts,
    url_lists,
)
from .runtime import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@register("op4_source_mix", sql=r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         length(text) AS n, length(text) - length(translate(text, '#$%&*|~^<>{}[]', '')) AS marks
  FROM documents),
k AS (
  SELECT *, -ln((('0x' || substr(md5('mix-1:' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
            / CASE WHEN n > 0 THEN greatest(0.1, 1 - 5 * (marks::DOUBLE / n::DOUBLE)) ELSE 1.0 END AS key
  FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight, 3 * source_size AS cap FROM s),
f AS (
  SELECT *, sum(cap) OVER o AS caps, sum(weight) OVER o AS used,
         sum(source_size) OVER () AS total, sum(weight) OVER () AS weights
  FROM w WINDOW o AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
c AS (
  SELECT *, cap::HUGEINT * (weights - used + weight) <= (total - (caps - cap)) * weight AS capped FROM f),
t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE (total - coalesce(sum(cap) FILTER (capped) OVER (), 0))::BIGINT::DOUBLE * weight::DOUBLE
                   / (sum(weight) FILTER (NOT capped) OVER ())::BIGINT::DOUBLE END AS target
  FROM c),
e AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS UNBOUNDED PRECEDING) - k.size AS start
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken
FROM (SELECT *, epochs + CASE WHEN source_size > 0 AND (2 * start + size)::DOUBLE
                                   < 2 * (target - (epochs * source_size)::DOUBLE)
                              THEN 1 ELSE 0 END AS copies FROM e)
""")
def op4_source_mix(spark, sf):
    """Efraimidis-Spirakis mix of all documents to the contract's targets."""
    docs = table(spark, sf, "documents")
    return mixing.mix(docs, quality=mixing.symbol_quality(F.col("text")))


@register("op10_exact_dedup", sql="""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256 FROM g
""")
def op10_exact_dedup(spark, sf):
    """Exact dedup of all documents by refinement; one row per document. The
    SHA-256 of rows that it never had to hash is added for the digest."""
    docs = table(spark, sf, "documents")
    return exact.exact_groups(docs, digest=True)


@register("op6_simhash")
def op6_simhash(spark, sf):
    """Fingerprints and near-duplicate components of all documents: 3-word
    shingles, at most 2 differing bits."""
    return simhash.simhash_components(table(spark, sf, "documents"), shingle_words=3, max_bits=2)


@register("op1_sentencepiece")
def op1_sentencepiece(spark, sf):
    """Merge-dropout encoding (10 %) of all documents, decoded again."""
    return pieces.encode_documents(table(spark, sf, "documents"), dropout=0.1, seed=1)


@register("op5_token_counts")
def op5_token_counts(spark, sf):
    """Unigram token counts of all documents."""
    return token_counts.token_counts(table(spark, sf, "documents"))


@register("op9_lm_scores")
def op9_lm_scores(spark, sf):
    """Log-bilinear model of the training documents, scores of all documents."""
    return lm.lm_scores(table(spark, sf, "documents"))


@register("op2_near_vectors", sql="""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
u AS (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS n FROM v
  WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
r(vec_id, low) AS (
  SELECT vec_id, vec_id FROM v
  UNION SELECT l.a, r.low FROM l JOIN r ON l.b = r.vec_id)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = r.vec_id) AS n_links, min(low) AS component_id,
       vec_id = min(low) AS kept
FROM r GROUP BY vec_id
""")
def op2_near_vectors(spark, sf):
    """Links at cosine 0.95 or more among all embeddings, and components."""
    return near_vectors.near_vectors(table(spark, sf, "embeddings"), threshold=0.95)


@register("op7_quality")
def op7_quality(spark, sf):
    """Expected grade and tail probability of all documents."""
    return quality.quality_table(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("op3_url_lists", sql=r"""
WITH c AS (
  SELECT page_id, TIMESTAMP '2024-01-01' + to_minutes(page_id * 37 % 525600) AS fetched_at,
         rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.') AS h,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), '/'),
                     lambda x: x <> '') AS seg
  FROM pages),
p AS (SELECT page_id, fetched_at, nullif(h, '') AS host, h || '/' || array_to_string(seg, '/') AS path, seg FROM c),
hosts AS (SELECT host AS pattern, count(*) AS n FROM p WHERE host IS NOT NULL GROUP BY host),
domains AS (
  SELECT regexp_extract(pattern, '^[^.]+\.(.+\..+)$', 1) AS pattern, sum(n)::BIGINT AS n FROM hosts
  WHERE regexp_extract(pattern, '^[^.]+\.(.+\..+)$', 1) <> '' GROUP BY 1),
firsts AS (
  SELECT host || '/' || seg[1] AS pattern, count(*) AS n FROM p WHERE host IS NOT NULL AND len(seg) > 0 GROUP BY 1),
e AS (
  SELECT 'abuse' AS list, 'block' AS effect, 'host' AS kind, pattern, (length(pattern) * 13 + n) % 300 + first AS since_day,
         (length(pattern) * 13 + n) % 300 + last AS until_day
  FROM hosts, (VALUES (0, 45), (120, NULL)) x(first, last)
  UNION ALL SELECT 'spam', 'block', 'domain', pattern, n * 7 % 200, n * 7 % 200 + 60 FROM domains
  UNION ALL SELECT 'trusted', 'allow', 'prefix', pattern, n * 5 % 330, n * 5 % 330 + 90 FROM firsts),
i AS (
  SELECT *, TIMESTAMP '2024-01-01' + to_days(since_day::INT) AS since, TIMESTAMP '2024-01-01' + to_days(until_day::INT) AS until,
         CASE kind WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END AS rank, len(string_split(pattern, '.')) AS labels
  FROM e),
m AS (
  SELECT p.page_id, i.list, i.effect, i.pattern, i.since, i.until,
         row_number() OVER (PARTITION BY p.page_id ORDER BY rank DESC, CASE WHEN kind = 'domain' THEN labels END DESC,
                            effect, list, pattern) AS place
  FROM p JOIN i ON p.fetched_at >= i.since AND (i.until IS NULL OR p.fetched_at < i.until)
   AND ((kind = 'host' AND p.host = i.pattern)
     OR (kind = 'domain' AND (p.host = i.pattern OR ends_with(p.host, '.' || i.pattern)))
     OR (kind = 'prefix' AND len(p.seg) > 0 AND p.host || '/' || p.seg[1] = i.pattern)))
SELECT p.page_id, p.fetched_at, p.host,
       CASE WHEN p.host IS NULL THEN 'invalid' WHEN m.effect = 'block' THEN 'blocked' ELSE 'allowed' END AS verdict,
       m.list, m.pattern, m.since, m.until
FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.place = 1
""")
def op3_url_lists(spark, sf):
    """Every page's capture judged by the list entries active at its fetch."""
    pages = table(spark, sf, "pages")
    return url_lists.judge(url_lists.page_captures(pages), url_lists.page_entries(pages))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_FORMS = ", ".join(f"({i}, {_quoted(name)}, {whole}, {_quoted(body)})"
                   for i, (name, whole, body) in enumerate(licenses.forms()))
_PLAIN = (r"regexp_replace(lower({x}), 'spdx-license-identifier:[ \t]*([a-z0-9]+)[.-]?([a-z0-9]*)[.-]?([a-z0-9]*)"
          r"[.-]?([a-z0-9]*)[.-]?([a-z0-9]*)', ' spdx\1\2\3\4\5 ', 'g')")
_WINDOWS = " UNION ALL ".join(
    f"SELECT doc_id, ((pos // {stride} - j) * {stride}) * 8 + {2 + k} AS unit, term "
    f"FROM tp, range({m // stride}) r(j) WHERE pos // {stride} >= j" for k, (m, stride) in enumerate(licenses.WINDOWS))


@register("op8_licenses", sql=rf"""
WITH d AS (
  SELECT doc_id, {_PLAIN.format(x="coalesce(text, '')")} AS text, doc_id % 16 = 0 AS speaks,
         concat_ws('/', source, lang, CASE WHEN doc_id % 256 = 0 THEN NULL ELSE 'p' || (doc_id // 1024) END,
                   CASE WHEN doc_id % 16 = 0 THEN NULL ELSE 'd' || (doc_id // 64) END) AS folder FROM documents),
n AS (SELECT count(*) AS n FROM d),
tl0 AS (SELECT doc_id, regexp_extract_all(text, '[a-z0-9]+') AS t FROM d),
tp AS (SELECT doc_id, unnest(t) AS term, unnest(range(len(t))) AS pos FROM tl0),
df AS (SELECT term, count(DISTINCT doc_id) AS df FROM tp GROUP BY term),
tt AS (
  SELECT form, license, whole, term, 1 + ln(count(*)) AS tf FROM (
    SELECT form, license, whole, unnest(regexp_extract_all({_PLAIN.format(x="body")}, '[a-z0-9]+')) AS term
    FROM (VALUES {_FORMS}) t(form, license, whole, body)) GROUP BY ALL),
tw AS (
  SELECT form, license, whole, term, tf * (ln((1 + n)::DOUBLE / (1 + coalesce(df, 0))) + 1) AS w
  FROM tt LEFT JOIN df USING (term), n),
tl AS (SELECT form, sqrt(sum(w * w)) AS l FROM tw GROUP BY form),
parts AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) * 8 AS unit, unnest(string_split(text, chr(10))) AS body FROM d
  UNION ALL
  SELECT doc_id, unnest(range(len(regexp_split_to_array(text, '\n[^a-z0-9\n]*\n')))) * 8 + 1 AS unit,
         unnest(regexp_split_to_array(text, '\n[^a-z0-9\n]*\n')) AS body FROM d),
u AS (
  SELECT doc_id, unit, unnest(regexp_extract_all(body, '[a-z0-9]+')) AS term FROM parts
  UNION ALL {_WINDOWS}
  UNION ALL SELECT doc_id, -1 AS unit, term FROM tp),
ut AS (SELECT doc_id, unit, term, 1 + ln(count(*)) AS tf FROM u GROUP BY ALL),
uw AS (SELECT doc_id, unit, term, tf * (ln((1 + n)::DOUBLE / (1 + df)) + 1) AS w FROM ut JOIN df USING (term), n),
ul AS (SELECT doc_id, unit, sqrt(sum(w * w)) AS l FROM uw GROUP BY ALL),
s AS (
  SELECT doc_id, unit, license, sum(uw.w * tw.w) / (any_value(ul.l) * any_value(tl.l)) AS s
  FROM uw JOIN tw USING (term) JOIN ul USING (doc_id, unit) JOIN tl USING (form)
  WHERE unit < 0 OR NOT whole GROUP BY doc_id, unit, form, license),
b AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, unit < 0 ORDER BY license = 'Proprietary', s DESC, license) AS place
  FROM s WHERE s >= 0.6),
f AS (
  SELECT folder, license, s,
         row_number() OVER (PARTITION BY folder ORDER BY license = 'Proprietary', s DESC, license) AS place
  FROM b JOIN d USING (doc_id) WHERE (unit < 0 OR speaks) AND b.place = 1),
a AS (
  SELECT g.folder, f.folder AS at, f.license, f.s,
         row_number() OVER (PARTITION BY g.folder ORDER BY length(f.folder) DESC) AS place
  FROM (SELECT DISTINCT folder FROM d) g JOIN f
    ON f.place = 1 AND (f.folder = '' OR g.folder = f.folder OR starts_with(g.folder, f.folder || '/')))
SELECT d.doc_id, d.folder, coalesce(h.license, a.license) AS license,
       CASE WHEN h.license IS NOT NULL THEN 'header' WHEN a.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       round(coalesce(h.s, a.s), 6) AS similarity, CASE WHEN h.license IS NULL THEN a.at END AS from_folder
FROM d LEFT JOIN b h ON h.doc_id = d.doc_id AND h.unit >= 0 AND h.place = 1
LEFT JOIN a ON a.folder = d.folder AND a.place = 1
""")
def op8_licenses(spark, sf):
    """Licences of all documents by header or nearest ancestor folder."""
    docs = table(spark, sf, "documents")
    return licenses.scan(docs, licenses.document_path(docs))


@register("op11_spelling_variants")
def op11_spelling_variants(spark, sf):
    """Words of all documents, their near words and the chains of forms."""
    return spelling.spelling_variants(table(spark, sf, "documents"))


@register("op12_main_text")
def op12_main_text(spark, sf):
    """The main text of every page."""
    return main_text.main_text(table(spark, sf, "pages"))


@register("op13_fill_in_middle", sql=r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents),
k AS (
  SELECT *, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS k1,
         ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS k2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (
  SELECT *, array_to_string(units[1:least(k1, k2)], '') AS prefix,
         array_to_string(units[least(k1, k2) + 1:greatest(k1, k2)], '') AS middle,
         array_to_string(units[greatest(k1, k2) + 1:n], '') AS suffix
  FROM k)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
""")
def op13_fill_in_middle(spark, sf):
    """Fill-in-middle outputs of all documents, with the digests of the output
    and of the text rebuilt from it."""
    rows = infill.fill_in_middle(table(spark, sf, "documents"))
    cut = infill.pieces(F.col("output"), F.col("form"))
    return rows.select(
        "doc_id", "n", "form", F.length(cut["prefix"]).cast("long").alias("prefix_chars"),
        F.length(cut["middle"]).cast("long").alias("middle_chars"),
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))
