"""Main text of HTML pages, with a suffix array per host.

Each page is read once into blocks of text with a zone: ``article`` (inside a
declared article), ``chrome`` (inside an element declared as something else:
menu, footer, form, advert ...) and ``open`` (neither). All blocks of all pages
go into the suffix array of their host: the token streams of the host's pages
are concatenated, every suffix is named by its first ``RUN`` tokens, and equal
names are an interval of the array. An interval with two distinct pages is a
substring repeated across pages; the union of its places covers every such
substring of ``RUN`` tokens or more. Covered tokens go, unique runs stay. The
markup then checks every page: what a declared article lost is put back, since
a passage that articles share is content, whatever its repeats, and what is
declared as something else goes even if no other page repeats it.

The names are sorted in range buckets that hold pages of all hosts, so neither
a large host nor a frequent passage makes a large group. Pages travel in chunks
of some ``CHUNK`` characters. A chunk sends each bucket its names (twice if two
of its pages hold it), and a bucket answers with those that occur twice: first
the leading bits of all names, which tells the suffixes that can be repeated,
then the whole names of these.
A page's declared article is a stream of its own, so text outside articles is
held against text outside articles only.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import ship, text_or_empty

#: Tokens (words and block breaks) of the shortest repeated run.
RUN = 8
BREAK = "\n"
#: Characters of HTML in a chunk of pages, about, and the chunks whose names
#: fill one bucket of the array: what a task holds at once.
CHUNK = 1 << 22
CHUNKS_A_BUCKET = 4
#: Of the suffixes that nothing repeats, one in 2 ** SPARE_BITS, about, shares
#: its leading bits with another one and sends its whole name.
SPARE_BITS = 7

# What an element is by its name. Fixed by HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript template iframe noembed noframes xmp".split())
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp "
             "small span strike strong sub sup time tt u var wbr".split())
CHROME = set("head nav footer aside form menu button select datalist dialog svg canvas object audio video".split()) | RAW
# Words in class, id or role that say an element is no main text. The first
# two sets hold inside an article, too.
COMMENTS = set("comment comments reply replies respond disqus discussion".split())
INSIDE = COMMENTS | set("ad ads adv advert adverts advertisement advertisements banner sponsor sponsored promo promotion "
                        "share sharing social related newsletter subscribe signup cookie cookies consent notice "
                        "notices alert popup modal overlay sidebar widget nav navbar navigation menu breadcrumb "
                        "breadcrumbs pagination pager footer form search login".split())
OUTSIDE = INSIDE | set("header masthead topbar toolbar branding logo copyright legal skip banner complementary "
                       "contentinfo".split())

_TAG = re.compile(r"</?([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(>?)")
_ATTR = re.compile(r"""\b(class|id|role|itemprop)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++)""", re.I)
_ENDS = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in RAW}
_PIECES = re.compile(r"[\s]+")


def _declared(attrs: str) -> tuple[set[str], bool]:
    """The words that class, id and role declare (whole names, and their first
    and last parts), and whether they declare the article."""
    found, body = set(), False
    for name, value in _ATTR.findall(attrs):
        value = html.unescape(value.strip("\"'")).lower()
        body |= (name.lower(), value) in (("role", "main"), ("role", "article"), ("itemprop", "articlebody"))
        if name.lower() != "itemprop":
            for v in _PIECES.split(value):
                parts = re.split(r"[-_]+", v)
                found.update((v, parts[0], parts[-1]))
    return found, body


def blocks(page: str) -> Iterator[tuple[str, str]]:
    """``(zone, text)`` of every non-empty block, in page order. One pass; an
    unclosed element ends with its parent, an unclosed tag with the page."""
    stack, open_count, parts = [("", "open")], {}, []
    at, size = 0, len(page)

    def flush():
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        return text

    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            parts.append(page[at:lt])
        if lt == size:
            break
        zone = stack[-1][1]
        after = page[lt + 1:lt + 2]
        if after in ("!", "?"):
            end = page.find("-->", lt + 4) + 2 if page.startswith("<!--", lt) else page.find(">", lt)
            if page.startswith(("<!-->", "<!--->"), lt):
                end = page.find(">", lt)
            if end < lt + 2:
                break
            at = end + 1
            continue
        tag = _TAG.match(page, lt)
        if tag is None:
            if after == "/" and page[lt + 2:lt + 3]:  # a bogus comment
                end = page.find(">", lt)
                if end < 0:
                    break
                at = end + 1
            else:
                parts.append("<")
                at = lt + 1
            continue
        at = tag.end()
        if not tag.group(3):
            # a stray quote swallowed the end: the tag ends at its first >
            end = page.find(">", lt)
            if end < 0:
                break
            at = end + 1
        name, closing = tag.group(1).lower(), after == "/"
        if name not in INLINE:
            text = flush()
            if text:
                yield zone, text
        elif name == "br":
            parts.append(" ")
        if closing:
            if open_count.get(name):
                while True:
                    top = stack.pop()[0]
                    open_count[top] -= 1
                    if top == name:
                        break
            continue
        if name in RAW:
            end = _ENDS[name].search(page, at)
            if end is None:
                break
            at = page.find(">", end.end()) + 1 or size
            continue
        if name in VOID:
            continue
        if name == "p" and stack[-1][0] == "p" or name == "li" and stack[-1][0] == "li":
            open_count[name] -= 1
            stack.pop()
            zone = stack[-1][1]
        stack.append((name, _zone(name, tag.group(2), zone)))
        open_count[name] = open_count.get(name, 0) + 1
    text = flush()
    if text:
        yield stack[-1][1], text


def _zone(name: str, attrs: str, zone: str) -> str:
    """The zone of an element inside ``zone``. ``hull`` is an element whose
    class speaks of boilerplate though it may wrap a declared article."""
    if zone == "chrome":
        return zone
    words, body = _declared(attrs) if attrs else (set(), False)
    if name in ("article", "main") or body:
        return "chrome" if words & COMMENTS else "article"
    if name in CHROME:
        return "chrome"
    if name in ("html", "body"):
        return zone
    if zone == "article":
        return "chrome" if words & INSIDE else zone
    if words & COMMENTS:
        return "chrome"
    return "hull" if name == "header" or words & OUTSIDE else zone


def _packed(chunk: int, columns: list[list], schema: pa.Schema) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))) as stream:
        stream.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema))
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                      ["chunk", "pages"])


def _parse(chunk_chars: int):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks of parsed pages, one row each, named by their first page's row."""
        chunk, size, columns, schema = None, 0, [], None
        for batch in batches:
            schema = pa.schema([*(batch.schema.field(c) for c in ("page_id", "url", "host")), ("article", pa.string()),
                                ("free", pa.list_(pa.bool_())), ("outside", pa.string())])
            for row, page, *known in zip(*(batch.column(c).to_pylist() for c in ("row", "html", "page_id", "url", "host"))):
                if not size:
                    chunk, columns = row, [[] for _ in schema]
                article, free, outside = [], [], []
                for zone, text in blocks(page):
                    if zone == "article":
                        article.append(text)
                    else:
                        free.append(zone == "open"), outside.append(text)
                # blocks hold no line feed
                for column, value in zip(columns, (*known, "\n\n".join(article), free, BREAK.join(outside))):
                    column.append(value)
                size += len(page) + 1
                if size >= chunk_chars:
                    yield _packed(chunk, columns, schema)
                    size = 0
        if size:
            yield _packed(chunk, columns, schema)
    return parse


def _pages(chunk: pa.Table) -> pa.Table:
    return pa.ipc.open_stream(chunk.column("pages")[0].as_buffer()).read_all()


def suffixes(pages: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(names, places, streams, ends)`` of all suffixes of ``RUN`` tokens or
    more of a chunk: the hash of the stream's host and kind and of the first
    ``RUN`` tokens, where it starts in the concatenated streams, its stream.
    Streams ``2 * k`` and ``2 * k + 1`` are what page ``k`` holds outside and
    inside its declared article, each block closed by a break; ``ends`` are
    the streams' ends."""
    host, outside, article = (pages.column(c).combine_chunks() for c in ("host", "outside", "article"))
    both = pa.concat_arrays([outside, pc.replace_substring(article, "\n\n", BREAK)])
    both = both.take(pa.array(np.arange(len(both)).reshape(2, -1).T.ravel()))
    both = pc.binary_join_element_wise(pc.replace_substring(both, BREAK, f" {BREAK} "), BREAK, " ")
    split = pc.split_pattern(both, " ")
    ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
    words = split.flatten().dictionary_encode()
    tokens = _hashes(words.dictionary)[words.indices.to_numpy()]
    # by other keys than the tokens, of which the host may be one
    salts = np.stack([_hashes(host, "outside articles"), _hashes(host, "inside  articles")], axis=1).ravel()
    n = max(len(tokens) - RUN + 1, 0)
    stream = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    names = salts[stream[:n]]
    for k in range(RUN):
        names = (names ^ tokens[k:n + k]) * np.uint64(0x9E3779B97F4A7C15)
        names ^= names >> np.uint64(32)
    places = np.flatnonzero(stream[:n] == stream[RUN - 1:])
    return names[places], places, stream[places], ends


def _hashes(texts: pa.Array, key: str = "tokens of a page") -> np.ndarray:
    return pd.util.hash_array(texts.to_numpy(zero_copy_only=False).astype(object), hash_key=key, categorize=False)


def _once_or_twice(names: np.ndarray, streams: np.ndarray) -> np.ndarray:
    """The names of a chunk, sorted: once, or twice if two pages hold it."""
    pages = streams >> 1
    order = np.lexsort((pages, names))
    names, pages = names[order], pages[order]
    names = names[np.append(True, (names[1:] != names[:-1]) | (pages[1:] != pages[:-1]))[:len(names)]]
    return names[np.append([True, True], names[2:] != names[:-2])[:len(names)]]


def _among(names: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which names are in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(names), bool)
    return known[np.minimum(np.searchsorted(known, names), len(known) - 1)] == names


def _pack(names: np.ndarray) -> bytes:
    """Sorted names as steps, byte by byte of all: high bytes compress."""
    return zlib.compress(np.diff(names, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _unpack(packed: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1).T)
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)


def _dealt(chunk: int, names: np.ndarray, bits: int, buckets: int) -> pa.Table:
    """Sorted names of ``bits`` bits by range bucket."""
    top = names >> np.uint64(bits - 32) if bits > 32 else names << np.uint64(32 - bits)
    found, starts = np.unique((top * np.uint64(buckets) >> np.uint64(32)).astype(np.int64), return_index=True)
    packed = [_pack(part) for part in np.split(names, starts[1:])] if len(found) else []
    return pa.table([pa.array(found, pa.int64()), pa.array([chunk] * len(found), pa.int64()), pa.array(packed, pa.binary())],
                    ["bucket", "chunk", "names"])


def _leading_bits(bits: int, buckets: int):
    def deal(chunk: pa.Table) -> pa.Table:
        names, _, streams, _ = suffixes(_pages(chunk))
        return _dealt(chunk.column("chunk")[0].as_py(), _once_or_twice(names >> np.uint64(64 - bits), streams), bits, buckets)
    return deal


def _whole_names(bits: int, buckets: int):
    def deal(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        names, _, streams, _ = suffixes(_pages(chunk))
        short = names >> np.uint64(64 - bits)
        asked = _once_or_twice(short, streams)
        # the answers, bucket after bucket, are as long as what was asked
        masks = [np.unpackbits(np.frombuffer(zlib.decompress(m), np.uint8), count=n) for _, n, m in sorted(
            zip(*(answers.column(c).to_pylist() for c in ("bucket", "n", "found"))))]
        hit = _among(short, asked[np.concatenate(masks).astype(bool)]) if masks else np.zeros(len(names), bool)
        return _dealt(chunk.column("chunk")[0].as_py(), _once_or_twice(names[hit], streams[hit]), 64, buckets)
    return deal


def _neighbours(bucket: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sort a bucket of the array: the names of each chunk, and which of them
    are equal to a neighbour."""
    parts = [_unpack(p) for p in bucket.column("names").to_pylist()]
    names = np.concatenate(parts)
    order = np.argsort(names, kind="stable")
    equal = names[order[1:]] == names[order[:-1]]
    hit = np.empty(len(names), bool)
    hit[order] = np.append(equal, False) | np.append(False, equal)
    return parts, np.split(hit, np.cumsum([len(p) for p in parts])[:-1])


def _found_bits(bucket: pa.Table) -> pa.Table:
    parts, hits = _neighbours(bucket)
    masks = [zlib.compress(np.packbits(h).tobytes(), 1) for h in hits]
    return pa.table([bucket.column("chunk"), bucket.column("bucket"), pa.array([len(p) for p in parts], pa.int64()),
                     pa.array(masks, pa.binary())], ["chunk", "bucket", "n", "found"])


def _found_names(bucket: pa.Table) -> pa.Table:
    found = [(c, _pack(np.unique(p[h]))) for c, p, h in zip(bucket.column("chunk").to_pylist(), *_neighbours(bucket)) if h.any()]
    return pa.table([pa.array([c for c, _ in found], pa.int64()), pa.array([n for _, n in found], pa.binary())],
                    ["chunk", "names"])


def repeated_names(chunks: DataFrame, size: int) -> DataFrame:
    """``(chunk, names)``: the names of the chunk's suffixes whose first ``RUN``
    tokens another page of the host repeats, in one row a bucket. ``size``
    is the number of characters of all pages."""
    buckets = size // (CHUNK * CHUNKS_A_BUCKET) + 1
    # a token has more than four characters of HTML, mostly
    bits = min(64, (size // 4 + 1).bit_length() + SPARE_BITS)
    dealt = "bucket long, chunk long, names binary"
    can = (chunks.groupBy("chunk").applyInArrow(_leading_bits(bits, buckets), dealt)
           .groupBy("bucket").applyInArrow(_found_bits, "chunk long, bucket long, n long, found binary"))
    return (chunks.groupBy("chunk").cogroup(can.groupBy("chunk")).applyInArrow(_whole_names(bits, buckets), dealt)
            .groupBy("bucket").applyInArrow(_found_names, "chunk long, names binary"))


def cut(free: list[bool], outside: list[str], covered: list[bool]) -> tuple[str, int]:
    """The text of the free blocks without covered words, and how many were
    cut; ``covered`` speaks of the words and breaks of all blocks. A page that
    would keep nothing is a copy of another page, not boilerplate: it stays
    whole."""
    kept, whole, at = [], [], 0
    for block, is_free in zip(outside, free):
        words = block.split(" ")
        if is_free:
            whole.append(block)
            left = _uncovered(words, covered[at:at + len(words)])
            if left:
                kept.append(" ".join(left))
        at += len(words) + 1
    n = sum(len(b.split(" ")) for b in whole) - sum(len(b.split(" ")) for b in kept)
    return "\n\n".join(kept or whole), n if kept else 0


def _uncovered(words: list[str], hit: list[bool]) -> list[str]:
    """The words outside the covered stretches. A stretch that is part of a
    block counts from ``RUN`` words on: a run that ends some words into a block
    does not take the block's first words with it."""
    left, start = [], 0
    for k in range(1, len(words) + 1):
        if k == len(words) or hit[k] != hit[start]:
            if not hit[start] or k - start < min(RUN, len(words)):
                left.extend(words[start:k])
            start = k
    return left


def _covered_words(text: str, between: str, covered: np.ndarray) -> int:
    """How many words, breaks apart, are covered."""
    if not covered.any():
        return 0
    ends = np.cumsum([b.count(" ") + 2 for b in text.split(between)]) - 1
    return int(covered.sum() - covered[ends].sum())


def _unique_runs(chunk: pa.Table, repeated: pa.Table) -> pa.Table:
    """The pages of a chunk without the places of its repeated names, checked
    by the markup."""
    pages = _pages(chunk)
    names, places, _, ends = suffixes(pages)
    known = np.sort(np.concatenate([np.empty(0, np.uint64), *map(_unpack, repeated.column("names").to_pylist())]))
    starts = np.zeros(ends[-1] + RUN + 1, np.int64)
    hit = places[_among(names, known)]
    starts[hit] += 1
    starts[hit + RUN] -= 1
    covered = np.cumsum(starts) > 0
    texts, n_cuts, n_repeated, n_restored, start = [], [], [], [], 0
    for k, (free, outside, article) in enumerate(zip(*(pages.column(c).to_pylist() for c in ("free", "outside", "article")))):
        out, inside = covered[start:ends[2 * k]], covered[ends[2 * k]:ends[2 * k + 1]]
        start = ends[2 * k + 1]
        restored = _covered_words(article, "\n\n", inside)
        # the array alone would leave a declared article its unique runs
        text, n_cut = (article, 0) if article else cut(free, outside.split(BREAK), out.tolist())
        texts.append(text), n_cuts.append(n_cut), n_restored.append(restored)
        n_repeated.append(restored + _covered_words(outside, BREAK, out))
    return pa.table([pages.column("page_id"), pages.column("url"), pa.array(texts, pa.string()), pa.array(n_cuts, pa.int64()),
                     pa.array(n_repeated, pa.int64()), pa.array(n_restored, pa.int64())],
                    ["page_id", "url", "text", "n_cut", "n_repeated", "n_restored"])


def main_text(pages: DataFrame, id_col: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per row of ``pages``: the id, the url, ``text``, ``n_chars``
    (its code points), ``n_cut`` (words cut because they lie in runs that
    other pages of the host repeat; 0 where the article is declared),
    ``n_repeated`` (words of the whole page in such runs) and ``n_restored``
    (those of them that a declared article got back).

    ``text`` is the unique runs of the open blocks, or the declared article,
    whose repeated runs are put back; character references are decoded, white
    space inside a block is one space, blocks are joined by two line feeds, and
    nothing is capped. A null or empty page gives the empty text; pages without
    a host share the host of the empty name; rows that repeat are pages of
    their own (equal pages without an article are copies and stay whole). An
    empty table gives an empty result; other columns are not read.
    """
    ship(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")),
                                    r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    size = pages.agg(F.sum(F.length(text_or_empty(page)))).first()[0] or 0
    rows = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"),
                        F.col(url).alias("url"), host.alias("host"), text_or_empty(page).alias("html"))
    kind = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    # shuffled once: all three uses of the chunks read the same exchange
    chunks = rows.mapInArrow(_parse(CHUNK), "chunk long, pages binary")
    out = chunks.groupBy("chunk").cogroup(repeated_names(chunks, size).groupBy("chunk")).applyInArrow(
        _unique_runs, f"{kind}, text string, n_cut long, n_repeated long, n_restored long")
    return out.select(F.col("page_id").alias(id_col), F.col("url").alias(url), "text",
                      F.length("text").cast("long").alias("n_chars"), "n_cut", "n_repeated", "n_restored")
