"""Spelling variants by a relational trie frontier.

The words are stored as a trie in a table of edges ``(node, char, child)``,
once read forwards and once backwards. A frontier of states ``(word, target,
position, node, edits)`` is joined with the edges level by level. The first
level makes the one edit: a word that has reached a node without edits takes
an edge with another letter (a replacement, or an insertion). The later levels
follow the rest of the word exactly. A state that ends on a word is a
neighbour. Deletions are insertions seen from the other word, so links are
taken in both directions at the end.

An edit in the later half of a word is looked for in the forward trie, one in
the earlier half in the backward trie: edits are then made at deep nodes, which
have few children. Every edge carries bit masks of what lies below it (next
letters, and hashes of whole rests), so states that cannot end on a word are
dropped before they are shuffled. Masks and hashed node names only ever let
too much through; the join with the words at the end decides.

Runs of letters of more than ``LONG`` code points (junk; a trie of them would
be as deep as they are long) take an equally exact form: words of one edit
share what is left when a letter is deleted from one or both, found by rolling
hashes in one pass over each word and confirmed by the edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .runtime import drop_written, ship, text_or_empty, written

#: Letters of a run; only A-Z are lower-cased.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words of more code points than this are compared by deletions.
LONG = 96
#: Bits of a mask of rests (two longs).
REST_BITS = 128
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


def words(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 7, occurrences: int = 2,
          typo_rate: int = 31) -> DataFrame:
    """``(word, n)``: lower-cased runs of letters of at least ``least`` code
    points that occur ``occurrences`` times or more over all texts.

    A run whose keyed hash ``typo_rate`` divides loses one letter, chosen by
    the same hash (the contract's seeded misspellings); 0 leaves runs as they are.
    """
    runs = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(text_or_empty(text), F.lit(f"([{LETTERS}]{{{least},}})"), F.lit(1))).alias("_run"))
    runs = runs.select("_id", F.translate("_run", UPPER, LOWER).alias("word"))
    if typo_rate:
        runs = runs.withColumn("_h", F.crc32(F.concat(F.col("_id"), F.lit(":"), F.col("word")).cast("binary")))
        runs = runs.withColumn("_at", (F.col("_h") % F.length("word")).cast("int"))
        runs = runs.select(F.when(F.col("_h") % typo_rate == 0, F.expr(
            "concat(substring(word, 1, _at), substring(word, _at + 2))")).otherwise(F.col("word")).alias("word"))
    counts = runs.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= occurrences)


# --------------------------------------------------------------------- trie

def _rest_bit(rest: Column) -> Column:
    return F.pmod(F.xxhash64(rest), F.lit(REST_BITS)).cast("int")


def _bit(expr: str) -> Column:
    return F.expr(f"shiftleft(1L, {expr})")


def _node(text: Column) -> Column:
    return F.xxhash64("side", text)


def _sides(vocab: DataFrame) -> DataFrame:
    """Every word read forwards (side 0) and backwards (side 1); ``half`` is
    the position from which that side makes edits."""
    half = (F.length("word") / 2).cast("int")
    return (vocab.select("word", F.lit(0).alias("side"), F.col("word").alias("read"), half.alias("half"))
            .unionAll(vocab.select("word", F.lit(1), F.reverse("word"), F.length("word") - half)))


def edges(vocab: DataFrame, depth: int) -> DataFrame:
    """``(node, char, child, letters, rest_a, rest_b)``: the edges of both
    tries below ``depth``, with masks of the next letters and of the rests."""
    path = _sides(vocab).select("side", "read", F.explode(F.expr(f"sequence({depth}, length(read) - 1)")).alias("p"))
    path = path.select(
        "side", "read", "p", F.expr("substring(read, p + 1, 1)").alias("char"),
        F.expr("substring(read, p + 2)").alias("_rest"))
    path = path.select(
        _node(F.expr("substring(read, 1, p)")).alias("node"), "char",
        _node(F.expr("substring(read, 1, p + 1)")).alias("child"),
        F.when(F.col("_rest") == "", 0).otherwise(_bit("ascii(_rest) % 64")).alias("_l"),
        _rest_bit(F.col("_rest")).alias("_bit"))
    return path.groupBy("node", "char").agg(
        F.min("child").alias("child"), F.bit_or("_l").alias("letters"),
        F.bit_or(F.when(F.col("_bit") < 64, _bit("_bit")).otherwise(0)).alias("rest_a"),
        F.bit_or(F.when(F.col("_bit") >= 64, _bit("_bit - 64")).otherwise(0)).alias("rest_b"))


def _possible(states: DataFrame) -> DataFrame:
    """States whose rest may lie below ``child``."""
    states = states.withColumn("_rest", F.expr("substring(target, pos + 1)"))
    states = states.withColumn("_bit", _rest_bit(F.col("_rest")))
    held = F.when(F.col("_bit") < 64, F.expr("shiftright(rest_a, _bit) & 1")).otherwise(
        F.expr("shiftright(rest_b, _bit - 64) & 1")) == 1
    letter = (F.col("_rest") == "") | (F.expr("shiftright(letters, ascii(_rest) % 64) & 1") == 1)
    return states.where(held & letter).select("word", "target", "side", "pos", F.col("child").alias("node"))


def _trie_links(vocab: DataFrame, depth: int) -> DataFrame:
    """``(word, near)``: a word and the target its states ended on. Each link
    is found from one of its ends at least."""
    table = written(edges(vocab, depth), "trie")
    start = _sides(vocab).select("word", "side", "read", F.explode(F.expr("sequence(half, length(read))")).alias("p"))
    start = start.withColumn("node", _node(F.expr("substring(read, 1, p)"))).withColumn("own", F.expr("substring(read, p + 1, 1)"))
    first = start.join(table, "node")
    head, tail = "substring(read, 1, p)", "substring(read, p + 1)"
    # of a replacement one end is enough; an insertion into a run of one
    # letter is made behind the run only
    edits = F.array(
        F.when(F.col("char") > F.col("own"), F.when(F.col("own") != "", F.expr(f"concat({head}, char, substring(read, p + 2))"))),
        F.when(F.col("char") != F.col("own"), F.expr(f"concat({head}, char, {tail})")))
    moved = first.select("word", "side", "child", "letters", "rest_a", "rest_b", (F.col("p") + 1).alias("pos"),
                         F.explode(edits).alias("target")).where("target is not null")
    frontier, found = written(_possible(moved), "frontier"), None
    while True:
        done = frontier.where("pos = length(target)").select(
            "word", F.when(F.col("side") == 0, F.col("target")).otherwise(F.reverse("target")).alias("near"))
        found = done if found is None else found.unionAll(done)
        going = frontier.where("pos < length(target)")
        if going.isEmpty():
            return found
        step = going.withColumn("char", F.expr("substring(target, pos + 1, 1)")).join(table, ["node", "char"])
        frontier = written(_possible(step.drop("node").withColumn("pos", F.col("pos") + 1)), "frontier")


def _deletions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of each word and of the word without each of its letters, by
    one forward and one backward pass over it."""
    for pdf in batches:
        ids, keys, cut = [], [], []
        for row, word in zip(pdf["row"], pdf["word"]):
            head = [0]
            for c in word:
                head.append((head[-1] * _BASE + ord(c)) % _PRIME)
            seen, tail, power = set(), 0, 1
            for p in range(len(word) - 1, -1, -1):
                seen.add((head[p] * power + tail) % _PRIME)
                tail = (tail + ord(word[p]) * power) % _PRIME
                power = power * _BASE % _PRIME
            for key in seen:
                ids.append(row), keys.append(key * 2 % _PRIME + len(word) - 1), cut.append(True)
            ids.append(row), keys.append(head[-1] * 2 % _PRIME + len(word)), cut.append(False)
        yield pd.DataFrame({"row": ids, "key": keys, "cut": cut})


def _long_links(vocab: DataFrame) -> DataFrame:
    """``(word, near)`` among words of ``LONG`` code points or more."""
    base = written(vocab.where(F.length("word") >= LONG).select("word").withColumn(
        "row", F.monotonically_increasing_id()), "long-words")
    keys = written(base.select("row", "word").mapInPandas(_deletions, "row long, key long, cut boolean"), "deletions")
    a, b = keys.where("cut"), keys.select(F.col("row").alias("other"), "key")
    pairs = a.join(b, "key").where("row <> other").select("row", "other").distinct()
    near = base.select(F.col("row").alias("other"), F.col("word").alias("near"))
    return (pairs.join(base, "row").join(near, "other")
            .where(F.levenshtein("word", "near", 1) == 1).select("word", "near"))


def near_words(vocab: DataFrame, least: int = 7) -> DataFrame:
    """``(word, near, near_n)``, both directions: the words of ``vocab`` (unique,
    all of ``least`` code points or more) at one inserted, deleted or replaced
    code point from each other."""
    ship(vocab.sparkSession)
    links = _trie_links(vocab.where(F.length("word") <= LONG), least // 2).unionAll(_long_links(vocab))
    both = links.unionAll(links.select("near", "word")).distinct()
    # a target that is no word ended on a mask or hash collision
    known = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    return both.join(vocab.select("word"), "word", "left_semi").join(known, "near").select("word", "near", "near_n")


# -------------------------------------------------------------------- forms

def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for words with a form, by pointer doubling. Counts grow
    tenfold along a chain, so a few rounds reach every end."""
    cur = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = cur.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        nxt = written(cur.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"),
                                                            F.col("_next").isNotNull().alias("_moved")), "roots")
        moved = not nxt.where("_moved").isEmpty()
        drop_written(cur)
        cur = nxt.drop("_moved")
        if not moved:
            return cur


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 7,
                      occurrences: int = 2, ratio: int = 10, typo_rate: int = 31) -> DataFrame:
    """One row per word of :func:`words`: ``word, form, root, n, n_near, form_n``.

    ``form`` is the near word of largest count (ties: smallest in code-point
    order) where that count is ``ratio`` times the word's own or more, else
    null; ``root`` is the end of the chain of forms, the word itself without
    one. Null and empty texts hold no word, rows that repeat count again, a
    null id hashes as the empty string, an empty table gives an empty result,
    and other columns are not read.
    """
    vocab = written(words(docs, id_col, text, least, occurrences, typo_rate), "words")
    near = near_words(vocab, least)
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("_m"), "near")).alias("_best"))
    rows = vocab.join(best, "word", "left")
    big = -F.col("_best._m") >= F.col("n") * ratio
    rows = written(rows.select(
        "word", F.when(big, F.col("_best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(big, -F.col("_best._m")).alias("form_n")), "forms")
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
