"""SentencePiece encoding and decoding with seeded merge-dropout.

Encoding processes an agenda of candidate merges, best score first and
leftmost among equals; a candidate that a keyed hash selects (with
probability ``dropout``) is skipped when its turn comes, so one text has many
segmentations of merge type, all of which decode to the same text. The hash
is keyed by the seed, the document, the chunk's place in the document, and the
place and piece of the candidate, so every occurrence of a word draws its own
merges. Reruns agree, and no order of tasks matters.

Dropout 0 gives the tokenizer's own segmentation. A literal U+2581, which the
tokenizer would turn into a space, is spelled in bytes, so decoding is
lossless for every text.

A chunk is first segmented without dropout, and its merges are kept. An
occurrence that skips none of them has just that segmentation; the others are
segmented anew with their own draws. Chunks are segmented together: one row of
symbols per chunk in NumPy, one merge per row and step. Long chunks take a heap
instead.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import ship, worker_state
from .vocabulary import CHUNK, PIECES_32K, SPACE, load, read_model

DROPOUT = 0.1
SEED = 1
#: Chunks remembered by a Python worker (about 40 MB).
CACHE_CHUNKS = 150_000
#: Longer chunks are segmented one by one with a heap.
ROW_SYMBOLS = 32
#: Occurrences whose candidates are drawn at once.
DRAWN = 1 << 16

_M = (1 << 64) - 1
_A, _B, _C = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_B)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_C)
    return x ^ (x >> np.uint64(31))


def _mix1(x: int) -> int:
    x = (x ^ (x >> 30)) * _B & _M
    x = (x ^ (x >> 27)) * _C & _M
    return x ^ (x >> 31)


class _Merges:
    """Piece that two pieces make, as an open-addressing table in NumPy."""

    def __init__(self, model: bytes):
        p = self.pieces = load(model)
        self.scores = np.array(p.scores, np.float32)  # as the file stores them
        self.none = np.float32(-np.inf)
        self.by_point = np.full(0x110000, -1, np.int32)
        for text, i in p.ids.items():
            if len(text) == 1:
                self.by_point[ord(text)] = i
        self.by_point[ord(SPACE)] = -1
        pairs = {}
        for text, i in p.ids.items():
            for k in range(1, len(text)):
                a, b = p.ids.get(text[:k]), p.ids.get(text[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = i
        self.pairs = pairs
        self.bits = max(10, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.made = np.full(1 << self.bits, -1, np.int32)
        for k, i in pairs.items():
            h = (k * _A & _M) >> (64 - self.bits)
            while self.keys[h] != -1:
                h = (h + 1) & ((1 << self.bits) - 1)
            self.keys[h], self.made[h] = k, i

    def join(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece ids of the pairs; -1 where they make none (or an end is -1)."""
        key = (left.astype(np.int64) << 32) | right
        h = ((key.astype(np.uint64) * np.uint64(_A)) >> np.uint64(64 - self.bits)).astype(np.int64)
        out = np.full(len(key), -1, np.int32)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        while len(open_):
            at = h[open_]
            found = self.keys[at]
            hit = found == key[open_]
            out[open_[hit]] = self.made[at[hit]]
            open_ = open_[~hit & (found != -1)]
            h[open_] = (h[open_] + 1) & ((1 << self.bits) - 1)
        return out

    # ------------------------------------------------------------ segmenting

    def bytes_of(self, ids: np.ndarray, chars: str) -> bytes:
        """Little-endian int32 ids; -1 stands for the next character without a
        piece, spelled in bytes."""
        if (ids >= 0).all():
            return ids.astype("<i4").tobytes()
        p, out, at = self.pieces, [], 0
        for i in ids.tolist():
            if i < 0:
                out += [p.byte_ids[b] for b in chars[at].encode("utf-8", "surrogatepass")]
                at += 1
            else:
                out.append(i)
                at += len(p.text[i])
        return np.array(out, "<i4").tobytes()

    def symbols(self, chunk: str) -> list[int]:
        ids = self.pieces.ids
        return [-1 if c == SPACE else ids.get(c, -1) for c in chunk]

    def long(self, chunk: str, key: int, cut: int, trace: list | None = None) -> bytes:
        """One chunk with a heap; the same result as :meth:`rows`. ``trace``
        takes what the hash adds to the key for each merge."""
        sym, scores, pairs = self.symbols(chunk), self.pieces.scores, self.pairs
        nxt, prv = list(range(1, len(sym) + 1)), list(range(-1, len(sym) - 1))
        heap: list = []

        def offer(a: int) -> None:
            b = nxt[a]
            if b < len(sym) and sym[a] >= 0 and sym[b] >= 0:
                m = pairs.get(sym[a] << 32 | sym[b])
                if m is not None:
                    heapq.heappush(heap, (-scores[m], a, m, sym[a], sym[b]))

        for a in range(len(sym) - 1):
            offer(a)
        gone = [False] * len(sym)
        while heap:
            _, a, m, x, y = heapq.heappop(heap)
            b = nxt[a]
            if gone[a] or b >= len(sym) or sym[a] != x or sym[b] != y:
                continue
            if cut and _mix1((key + a * _A + m * _C) & _M) >> 32 < cut:
                continue
            if trace is not None:
                trace.append((a * _A + m * _C) & _M)
            sym[a], gone[b], nxt[a] = m, True, nxt[b]
            if nxt[a] < len(sym):
                prv[nxt[a]] = a
            if prv[a] >= 0:
                offer(prv[a])
            offer(a)
        return self.bytes_of(np.array([s for s, g in zip(sym, gone, strict=True) if not g], np.int32), chunk)

    def rows(self, chunks: list[str], keys, cut: int, trace: list | None = None) -> list[bytes]:
        """Chunks of at most ROW_SYMBOLS characters, one merge per row and step.
        ``trace`` takes the rows of each step and what the hash adds to their keys."""
        n = len(chunks)
        live = np.fromiter(map(len, chunks), np.int64, n)
        width = int(live.max())
        sym = np.full((n, width + 2), -1, np.int32)  # column 0 stays empty
        points = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4")
        cols = np.arange(width + 2)
        sym[(cols > 0) & (cols <= live[:, None])] = self.by_point[points]
        made = np.full((n, width + 2), -1, np.int32)
        made[:, 1:-1] = self.join(sym[:, 1:-1].ravel(), sym[:, 2:].ravel()).reshape(n, width)
        score = np.where(made >= 0, self.scores[made], self.none)
        key = np.array(keys, np.uint64)
        # symbols stay in their columns; merged ones are skipped by links
        after = np.tile(np.arange(1, width + 3, dtype=np.int32), (n, 1))
        before = np.tile(np.arange(-1, width + 1, dtype=np.int32), (n, 1))
        gone = np.zeros((n, width + 3), bool)
        rows = np.arange(n)
        while len(rows):
            best = score[rows].argmax(axis=1)
            alive = score[rows, best] > self.none
            rows, best = rows[alive], best[alive]
            if not len(rows):
                break
            m = made[rows, best]
            if cut or trace is not None:
                add = (best - 1).astype(np.uint64) * np.uint64(_A) + m.astype(np.uint64) * np.uint64(_C)
            if trace is not None:
                trace.append((rows, add))
            if cut:
                h = _mix(key[rows] + add) >> np.uint64(32)
                skip = h < np.uint64(cut)
                score[rows[skip], best[skip]] = self.none
                go, at, m = rows[~skip], best[~skip], m[~skip]
            else:
                go, at = rows, best
            if not len(go):
                continue
            right = after[go, at]
            far = after[go, right]
            sym[go, at] = m
            gone[go, right] = True
            score[go, right] = self.none
            after[go, at] = far
            before[go, np.minimum(far, width + 1)] = at
            left = before[go, at]
            for a, b in ((left, at), (at, far)):
                new = self.join(sym[go, a], sym[go, np.minimum(b, width + 1)])
                made[go, a] = new
                score[go, a] = np.where(new >= 0, self.scores[new], self.none)
        sym = np.concatenate([sym, np.full((n, 1), -1, np.int32)], axis=1)
        cols = np.arange(width + 3)
        used = (cols > 0) & (cols <= live[:, None]) & ~gone
        flat = sym[used].astype("<i4").tobytes()
        ends = (4 * np.cumsum(used.sum(axis=1))).tolist()
        out = [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        for r in np.flatnonzero((used & (sym < 0)).any(axis=1)).tolist():  # characters to spell in bytes
            out[r] = self.bytes_of(sym[r][used[r]], chunks[r])
        return out

    def segment(self, chunks: list[str], keys, cut: int) -> list[bytes]:
        """Segmentations of chunks with a key each."""
        out: list[bytes] = [b""] * len(chunks)
        for part in self._parts(chunks):
            for i, b in zip(part, self.rows([chunks[i] for i in part], keys[part], cut), strict=True):
                out[i] = b
        for i, c in enumerate(chunks):
            if len(c) > ROW_SYMBOLS:
                out[i] = self.long(c, int(keys[i]), cut)
        return out

    def traced(self, chunks: list[str]) -> tuple[list[bytes], list[np.ndarray]]:
        """Segmentations without dropout, and what the hash adds to a key for
        each of their merges."""
        out: list[bytes] = [b""] * len(chunks)
        adds = [np.empty(0, np.uint64)] * len(chunks)
        for part in self._parts(chunks):
            steps: list = []
            got = self.rows([chunks[i] for i in part], np.zeros(len(part), np.uint64), 0, steps)
            row = np.concatenate([r for r, _ in steps]) if steps else np.empty(0, np.int64)
            add = np.concatenate([x for _, x in steps]) if steps else np.empty(0, np.uint64)
            add = add[np.argsort(row, kind="stable")]
            ends = np.cumsum(np.bincount(row, minlength=len(part))).tolist()
            for i, b, x, y in zip(part, got, [0, *ends[:-1]], ends, strict=True):
                out[i], adds[i] = b, add[x:y]
        for i, c in enumerate(chunks):
            if len(c) > ROW_SYMBOLS:
                trace: list[int] = []
                out[i] = self.long(c, 0, 0, trace)
                adds[i] = np.array(trace, np.uint64)
        return out, adds

    @staticmethod
    def _parts(chunks: list[str]) -> Iterator[list[int]]:
        """Places of the short chunks, those of about one length together."""
        size = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(size, kind="stable")
        order = order[:int((size <= ROW_SYMBOLS).sum())]
        for k in range(0, len(order), 8192):
            yield order[k:k + 8192].tolist()


class _Grown:
    """A NumPy array that rows are added to and cut off from at its end."""

    def __init__(self, dtype):
        self.all, self.n = np.empty(1024, dtype), 0

    def add(self, values: np.ndarray) -> None:
        end = self.n + len(values)
        if end > len(self.all):
            more = np.empty(max(end, 2 * len(self.all)), self.all.dtype)
            more[:self.n] = self.all[:self.n]
            self.all = more
        self.all[self.n:end] = values
        self.n = end

    def get(self) -> np.ndarray:
        return self.all[:self.n]


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each of several stretches."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - before, lengths)


@lru_cache(maxsize=2)
def _merges(model: bytes) -> _Merges:
    return _Merges(model)


class Encoder:
    """Encodes batches of texts; remembers the chunks it has met, with their
    segmentations without dropout and the merges of those.

    A line is cut at its spaces. A word with one space before it (by far the
    most) is looked up without building the chunk; lines with other runs of
    spaces are cut by the general rule.
    """

    def __init__(self, model: bytes, dropout: float = DROPOUT, seed: int = SEED):
        if not 0 <= dropout <= 1:
            raise ValueError("dropout is a probability")
        self.merges = _merges(model)
        self.cut = min(1 << 32, round(dropout * (1 << 32)))
        self.seed = seed
        # places in the lists below: of words after one space, and of any other chunk
        self.spaced: dict[str, int] = {}
        self.other: dict[str, int] = {}
        self.chunks: list[str] = []
        self.ids, self.ids_end = _Grown(np.int32), _Grown(np.int64)
        self.adds, self.adds_end = _Grown(np.uint64), _Grown(np.int64)
        self.ids_end.add(np.zeros(1))
        self.adds_end.add(np.zeros(1))
        self.room = CACHE_CHUNKS
        self._learn(["\n"])

    def _learn(self, chunks: list[str]) -> None:
        got, adds = self.merges.traced(chunks)
        self.chunks += chunks
        self.ids_end.add(self.ids.n + np.cumsum([len(x) // 4 for x in got]))
        self.ids.add(np.frombuffer(b"".join(got), "<i4"))
        if self.cut:
            self.adds_end.add(self.adds.n + np.cumsum([len(x) for x in adds]))
            self.adds.add(np.concatenate(adds))

    def _forget(self, n: int) -> None:
        """Keep the first n chunks only."""
        del self.chunks[n:]
        self.ids_end.n = n + 1
        self.ids.n = int(self.ids_end.all[n])
        if self.cut:
            self.adds_end.n = n + 1
            self.adds.n = int(self.adds_end.all[n])

    def _keys(self, docs: list[str], sizes: np.ndarray) -> np.ndarray:
        """The key of every occurrence: seed, document, place in the document."""
        base = np.array([xxhash.xxh64_intdigest(d.encode("utf-8", "surrogatepass"), self.seed & _M) for d in docs],
                        np.uint64)
        place = _spread(np.zeros(len(sizes), np.int64), sizes).astype(np.uint64)
        return _mix(np.repeat(base, sizes) + place * np.uint64(_A))

    def _skips(self, at: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Occurrences that skip a merge of their chunk's own segmentation."""
        ends, adds, out = self.adds_end.get(), self.adds.get(), []
        for k in range(0, len(at), DRAWN):
            part = at[k:k + DRAWN]
            n = ends[part + 1] - ends[part]
            owner = np.repeat(np.arange(k, k + len(part)), n)
            h = _mix(keys[owner] + adds[_spread(ends[part], n)]) >> np.uint64(32)
            out.append(np.unique(owner[h < np.uint64(self.cut)]))
        return np.concatenate(out) if out else np.empty(0, np.int64)

    def encode(self, texts: list[str | None], docs: list[str]) -> list[np.ndarray]:
        """Piece ids of each text; ``docs`` names the document of each."""
        spaced, other = self.spaced.get, self.other.get
        found: list[int | None] = []
        ends = [0]
        known = len(self.chunks)
        fresh: dict[str, int] = {}
        times: Counter = Counter()
        for text in texts:
            lines = text.split("\n") if text else []
            for k, line in enumerate(lines):
                if k:
                    found.append(0)
                elif not line:
                    line = " "  # the space in front stands alone
                if not line:
                    continue
                words = line.split(" ")
                plain = "" not in words
                if plain:
                    got = list(map(spaced, words))
                    if k:  # no space before a line's first word
                        got[0] = other(words[0])
                else:
                    words = CHUNK.findall(line if k or line == " " and not lines[0] else " " + line)
                    got = list(map(other, words))
                j = -1
                for _ in range(got.count(None)):
                    j = got.index(None, j + 1)
                    c = " " + words[j] if plain and (j or not k) else words[j]
                    got[j] = fresh.setdefault(c, known + len(fresh))
                    times[c] += 1
                found += got
            ends.append(len(found))
        at = np.array(found, np.int64)
        if fresh:
            # only chunks that come again are worth the memory; frequent ones
            # come early, and a full memory stays as it is
            again = [c for c in fresh if times[c] > 1][:max(0, self.room)]
            kept = set(again)
            order = again + [c for c in fresh if c not in kept]
            self._learn(order)
            place = np.empty(len(order), np.int64)
            place[[fresh[c] - known for c in order]] = np.arange(known, known + len(order))
            new = at >= known
            at[new] = place[at[new] - known]
            for i, c in enumerate(again, known):
                self.other[c] = i
                if c[0] == " " and c[1:2] not in ("", " "):
                    self.spaced[c[1:]] = i
            self.room -= len(again)
            known += len(again)
        start = self.ids_end.get()[at]
        size = self.ids_end.get()[at + 1] - start
        pool = self.ids.get()
        if self.cut:
            keys = self._keys(docs, np.diff(ends))
            skips = self._skips(at, keys)
            if len(skips):
                got = self.merges.segment([self.chunks[i] for i in at[skips].tolist()], keys[skips], self.cut)
                size[skips] = [len(x) // 4 for x in got]
                start[skips] = len(pool) + np.cumsum(size[skips]) - size[skips]
                pool = np.concatenate([pool, np.frombuffer(b"".join(got), "<i4")])
        flat = pool[_spread(start, size)]
        self._forget(known)
        cuts = np.concatenate(([0], np.cumsum(size)))[ends]
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Decoder:
    """Texts of piece ids, gathered from one buffer of all pieces."""

    def __init__(self, model: bytes):
        raw = load(model).raw
        self.buffer = np.frombuffer(b"".join(raw), np.uint8)
        self.length = np.array([len(x) for x in raw], np.int64)
        self.start = np.cumsum(self.length) - self.length

    def raw(self, ids: np.ndarray) -> bytes:
        """The bytes of the text, without the space that encoding puts in front."""
        n = self.length[ids]
        shift = np.repeat(self.start[ids] - (np.cumsum(n) - n), n)
        out = self.buffer[np.arange(len(shift)) + shift].tobytes()
        return out[1:] if out[:1] == b" " else out


@lru_cache(maxsize=2)
def _decoder(model: bytes) -> Decoder:
    return Decoder(model)


def decode(model: bytes, ids) -> str:
    """The text of piece ids, without the space that encoding puts in front.
    Bytes that are no UTF-8 (ids that no text has) become U+FFFD."""
    return _decoder(model).raw(np.asarray(ids, np.int64)).decode("utf-8", "replace")


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = PIECES_32K,
                     dropout: float = DROPOUT, seed: int = SEED, apart: bool = False) -> DataFrame:
    """One row per document: id, ``ids`` (array of piece ids), ``n_pieces`` and
    ``round_trip`` (decoding gives the text back).

    Null and empty texts have no pieces; a null text decodes to the empty one
    (``round_trip`` true). Rows that share an id and a text share their
    segmentation; with ``apart`` they are numbered (by the text's hash, so the
    result does not depend on their order) and the k-th one after the first
    draws under ``<id>#<k>``: the epochs of a mix then differ. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(read_model(spark, path))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(id_col).cast("string").alias("_doc"),
                       F.col(text).cast("string").alias("_text"))
    if apart:
        turn = Window.partitionBy("_id").orderBy(F.xxhash64("_text"))
        rows = rows.withColumn("_k", F.row_number().over(turn) - 1).select(
            "_id", F.when(F.col("_k") == 0, F.col("_doc")).otherwise(
                F.concat(F.coalesce("_doc", F.lit("")), F.lit("#"), F.col("_k").cast("string"))).alias("_doc"), "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_state("pieces", (model.value, dropout, seed), lambda: Encoder(model.value, dropout, seed))
        back = _decoder(model.value)
        for whole in batches:
            for b in _by_size(whole):
                texts, names = b.column(2).to_pylist(), b.column(1).to_pylist()
                ids = enc.encode(texts, ["" if n is None else n for n in names])
                same = [back.raw(i) == (t or "").encode("utf-8", "surrogatepass")
                        for t, i in zip(texts, ids, strict=True)]
                ends = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))),
                     pa.array(np.diff(ends).astype(np.int64)), pa.array(same, pa.bool_())],
                    names=[id_col, "ids", "n_pieces", "round_trip"])

    schema = T.StructType([T.StructField(id_col, rows.schema["_id"].dataType),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_pieces", T.LongType()), T.StructField("round_trip", T.BooleanType())])
    return rows.mapInArrow(run, schema)


def decode_documents(rows: DataFrame, ids: str = "ids", name: str = "text", path: str = PIECES_32K) -> DataFrame:
    """``rows`` with the decoded text of the ``ids`` column in ``name`` (null
    ids: null, no ids: the empty text). Rows that repeat are decoded each, an
    empty table stays empty, other columns stay; one called ``name`` is
    replaced."""
    spark = rows.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(read_model(spark, path))

    @F.pandas_udf("string")
    def text_of(column):
        import pandas as pd
        return pd.Series([None if x is None else decode(model.value, x) for x in column], dtype=object)

    return rows.withColumn(name, text_of(F.col(ids)))


def _by_size(batch: pa.RecordBatch, chars: int = 1_500_000, column: int = 2) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``chars`` bytes of text (one row at least)."""
    sizes = np.array([0 if v is None else v for v in pc.binary_length(batch.column(column)).to_pylist()], np.int64)
    part = np.cumsum(sizes) // chars if len(sizes) else sizes
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if b > a:
            yield batch.slice(a, b - a)
