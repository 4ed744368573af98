"""Token counts by a count-only Viterbi over a unigram vocabulary.

An Aho-Corasick automaton lists every piece that ends at a position; dynamic
programming carries the best score and its number of pieces, and never the
path. Tie rule of the tokenizer: starts are tried from the left and a later
one replaces only by a strictly better score, so of equal paths the one whose
last piece is longest wins. A character without a piece scores ten less than
the worst piece and counts as its UTF-8 bytes (byte fallback).

Pieces cross no chunk boundary (checked when the vocabulary is loaded), so
the chunks' best paths add up to the text's; sums of double-precision scores
stay exact. A worker remembers the chunks it has met.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import ship, worker_state
from .vocabulary import CHUNK, PIECES_32K, SPACE, load, read_model

#: Chunks remembered by a Python worker (about 50 MB).
CACHE_CHUNKS = 250_000
UNKNOWN_PENALTY = 10.0


class Viterbi:
    def __init__(self, model: bytes):
        pieces = load(model)
        self.found = ahocorasick.Automaton()
        for text, i in pieces.ids.items():
            self.found.add_word(text, (len(text), pieces.scores[i]))
        self.found.make_automaton()
        self.unknown = min(pieces.scores[i] for i in pieces.ids.values()) - UNKNOWN_PENALTY
        self.singles = {t for t in pieces.ids if len(t) == 1}
        self.counts: dict[str, int] = {}
        self.scores: dict[str, float] = {}

    def chunk(self, chunk: str) -> tuple[int, float]:
        """Number of pieces and score of the best path."""
        n = len(chunk)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        at = 0  # ends up to here are settled
        won, won_count, won_length = None, 0, 0

        def settle() -> None:
            nonlocal at, won, won_count, won_length
            c = chunk[at]
            if c not in self.singles:
                score = best[at] + self.unknown
                if won is None or score > won:
                    won, won_count = score, count[at] + len(c.encode("utf-8", "surrogatepass"))
            at += 1
            best[at], count[at] = won, won_count
            won, won_count, won_length = None, 0, 0

        for last, (length, score) in self.found.iter(chunk):
            while at < last:
                settle()
            start = last + 1 - length
            total = best[start] + score
            if won is None or total > won or (total == won and length > won_length):
                won, won_count, won_length = total, count[start] + 1, length
        while at < n:
            settle()
        return count[n], best[n]

    def text(self, text: str | None) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        if len(self.counts) > CACHE_CHUNKS:
            self.counts, self.scores = {}, {}
        counts, scores = self.counts, self.scores
        # a literal U+2581 is a space to the tokenizer
        chunks = CHUNK.findall(" " + text.replace(SPACE, " "))
        for c in set(chunks).difference(counts):
            counts[c], scores[c] = self.chunk(c)
        return sum(map(counts.__getitem__, chunks)), sum(map(scores.__getitem__, chunks))


def token_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = PIECES_32K) -> DataFrame:
    """One row per document: id, ``n_tokens`` and ``score`` (of the best path).

    Null and empty texts have no tokens and score 0. Rows that repeat give
    their row again. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(read_model(spark, path))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text).cast("string").alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = worker_state("viterbi", model.value, lambda: Viterbi(model.value))
        for b in batches:
            found = [best.text(x.as_py()) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.array([n for n, _ in found], np.int64)),
                 pa.array(np.array([s for _, s in found], np.float64))],
                names=[id_col, "n_tokens", "score"])

    schema = T.StructType([T.StructField(id_col, rows.schema["_id"].dataType),
                           T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema)
