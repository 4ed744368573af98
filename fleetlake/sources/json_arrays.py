"""A JSON array of any size, read by several tasks.

The text reader cuts the file at every ``}`` and so splits it by byte ranges;
what a piece means depends on the text before it: a brace can stand inside a
string. That context is small (inside a string or not, and the bracket depth)
and composes: each split is summarised once for both possible starts, the
summaries of a file are folded in order, and every split then knows its start.
Records inside a split are put together there; of a record that crosses
splits only the fragments are brought together, by the split it starts in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_MARK = re.compile(r'\\.|["{}\[\]]', re.S)


def walk(text: str, quoted: bool, depth: int) -> tuple[bool, int]:
    """The context behind ``text``."""
    for m in _MARK.finditer(text):
        c = m.group()
        if c == '"':
            quoted = not quoted
        elif not quoted and len(c) == 1:
            depth += 1 if c in "{[" else -1
    return quoted, depth


def _summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per split: the context behind it if it starts outside a string and if
    it starts inside one, and the first visible character."""
    at, state, first = None, None, ""

    def row():
        return pd.DataFrame([(*at, *state[0], *state[1], first)], columns=SUMMARY)

    for pdf in batches:
        for file, start, value in zip(pdf["file"], pdf["start"], pdf["value"]):
            if (file, start) != at:
                if at is not None:
                    yield row()
                at, state, first = (file, start), [(False, 0), (True, 0)], ""
            text = value + "}"
            first = first or text.lstrip()[:1]
            state = [walk(text, *s) for s in state]
    if at is not None:
        yield row()


SUMMARY = ["file", "start", "out_quoted", "out_depth", "in_quoted", "in_depth", "first"]


def records_of(pieces: Iterator[tuple[str, bool]], quoted: bool, depth: int, base: int) -> Iterator[tuple[str, str]]:
    """``(kind, text)``: whole records (``whole``), the end of a record begun
    before (``head``), the start of one that goes on (``tail``), or a split
    inside one record (``middle``)."""
    begun, parts = not (not quoted and depth <= base), []
    for piece in pieces:
        parts.append(piece)
        quoted, depth = walk(piece, quoted, depth)
        if not quoted and depth == base:
            yield ("head" if begun else "whole"), "".join(parts)
            begun, parts = False, []
    rest = "".join(parts)
    if begun:
        yield "middle", rest
    elif "{" in rest:
        yield "tail", rest


def _assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def finish(key, pieces):
        file, start, quoted, depth, base = key
        rows = [(file, start, k, n, t) for n, (k, t) in enumerate(records_of(iter(pieces), quoted, depth, base))]
        return pd.DataFrame(rows, columns=["file", "start", "kind", "place", "text"])

    key, pieces = None, []
    for pdf in batches:
        for *k, value in zip(pdf["file"], pdf["start"], pdf["quoted"], pdf["depth"], pdf["base"], pdf["value"]):
            if k != key:
                if key is not None:
                    yield finish(key, pieces)
                key, pieces = k, []
            pieces.append(value + "}")
    if key is not None:
        yield finish(key, pieces)


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, start, place, text)``: the text of every object of the arrays
    (or of the single object) in the files of ``path``, in file order by
    ``start, place``. The memory of a task is bounded by its split.

    A file that ends inside its last object is read as if it closed there.
    """
    pieces = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"), "value")
    splits = pieces.select("file", "start", "value").mapInPandas(
        _summaries, "file string, start long, out_quoted boolean, out_depth long, in_quoted boolean, in_depth long, first string")
    # one row per split; a file's splits are folded in order
    ordered = splits.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("start", *SUMMARY[2:]))).alias("s"))
    step = F.aggregate(
        "s", F.expr("named_struct('quoted', false, 'depth', 0L, 'all', "
                    "cast(array() as array<struct<start: bigint, quoted: boolean, depth: bigint>>))"),
        lambda acc, s: F.struct(
            F.when(acc["quoted"], s["in_quoted"]).otherwise(s["out_quoted"]).alias("quoted"),
            (acc["depth"] + F.when(acc["quoted"], s["in_depth"]).otherwise(s["out_depth"])).alias("depth"),
            F.concat(acc["all"], F.array(F.struct(s["start"].alias("start"), acc["quoted"].alias("quoted"),
                                                  acc["depth"].alias("depth")))).alias("all")),
        lambda acc: acc["all"])
    base = F.when(F.element_at(F.filter(F.col("s.first"), lambda c: c != ""), 1) == "[", 1).otherwise(0)
    contexts = ordered.select("file", F.explode(step).alias("c"), base.alias("base")).select("file", "c.*", "base")
    known = pieces.join(contexts, ["file", "start"]).select("file", "start", "quoted", "depth", "base", "id", "value")
    parts = known.sortWithinPartitions("file", "start", "id").mapInPandas(
        _assemble, "file string, start long, kind string, place long, text string")
    whole = parts.where("kind = 'whole'").select("file", "start", "place", "text")
    broken = parts.where("kind <> 'whole'")
    order = Window.partitionBy("file").orderBy("start", "place")
    begun = F.last(F.when(F.col("kind") == "tail", F.struct("start", "place")), ignorenulls=True).over(order)
    crossing = (broken.select("*", begun.alias("_b")).groupBy("file", F.col("_b.start").alias("start"), F.col("_b.place").alias("place"))
                .agg(F.sort_array(F.collect_list(F.struct(F.col("start").alias("s"), F.col("place").alias("p"), "text"))).alias("_t"))
                .select("file", "start", "place", F.concat_ws("", F.col("_t.text")).alias("text")))
    # what stands before a record's own brace: [ , and white space
    return whole.unionByName(crossing).withColumn("text", F.regexp_replace("text", r"\A[^{]*", ""))


def scan_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The objects of JSON array files, in the columns of ``schema``; a
    value of another type is NULL, as with ``multiLine``."""
    rows = array_records(spark, path).select(F.from_json("text", schema).alias("r"))
    return rows.select("r.*")
