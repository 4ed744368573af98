"""Language-model scores from a log-bilinear neural model.

The output is factored by classes. Classes are cut by token coverage: a word
with a share of ``SHARE`` of the training tokens is a class of its own; all
others are grouped by their endings (the last byte, two or three bytes of the
word, the longest one that still covers ``SHARE``), and the end of a text is a
class. The model predicts a class vector from the vectors of the two classes
before it (one matrix per position) and scores a class by the inner product
plus a bias; a word's own probability within its class is its add-one share of
the class's training tokens, with one more unit for all unseen words of that
ending. The probabilities of all words so add up to one.

The model is trained in NumPy with noise-contrastive estimation on all
training documents. It is a function of the corpus alone: documents are dealt
by a hash of id and text to shards whose number follows from the number of
tokens, a shard's trigrams are sorted before they are dealt into batches, the
steps follow from the shard, and the shards' parameters are averaged (weighted
by tokens) in whole numbers, so neither files, tasks nor order matter. The
driver only ever holds one set of parameters. Scores are normalised exactly:
products of the parameter matrices give the class scores of whole contexts at
once.

Counts of words come from all training documents. The driver collects at most
``FREQUENT`` words (a bound by a histogram of counts, not a sample); the
counts of all other words reach the documents by a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .runtime import drop_written, ship, worker_state, written

#: Share of the training tokens that makes a class; at most 1.5 / SHARE + 2 classes.
SHARE = 1 / 640
#: Most words whose counts are sent to every task (about 40 MB there).
FREQUENT = 1 << 18
DIMENSIONS = 32
ROUNDS = 2
NOISE = 128
BATCH = 2048
#: Training tokens of a shard, about.
SHARD_TOKENS = 4_000_000
#: A shard with few trigrams goes over them until it has made so many steps.
LEAST_STEPS = 200
#: A trigram with more than so many times the mean count is dealt in copies.
SPLIT = 4
RATE = 0.04
SEED = 7

RARE, END = 0, 1
#: Distinct words that a task gathers before it hands them on.
FLUSH_WORDS = 300_000
#: Parameters are averaged as whole multiples of this.
UNIT = 2.0 ** -40

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased; the end is not among them."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def held_out(id_col: str) -> Column:
    """crc32(id as text) mod 7 is 2; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, c)`` of all texts (column ``_text``); the end is the word ''."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays(
                [pa.array(list(seen.keys()), pa.binary()).cast(pa.string()), pa.array(list(seen.values()), pa.int64())],
                names=["word", "c"])
            seen.clear()
            return b

        for b in batches:
            for x in b.column(0):
                seen.update(words_of(x.as_py()))
                seen[b""] += 1
                if len(seen) > FLUSH_WORDS:
                    yield out()
        if seen:
            yield out()

    return (texts.select("_text").mapInArrow(count, "word string, c long")
            .groupBy("word").agg(F.sum("c").alias("c")))


# --------------------------------------------------------------------- model

@dataclass
class Model:
    """Parameters; rows of ``r`` and ``q`` are classes."""

    r: np.ndarray
    q: np.ndarray
    c1: np.ndarray
    c2: np.ndarray
    b: np.ndarray

    @staticmethod
    def start(prior: np.ndarray, dimensions: int, seed: int) -> Model:
        """Small random vectors and the log of the unigram shares as biases,
        so training starts at the unigram model."""
        rng = np.random.default_rng(seed)
        n, d = len(prior), dimensions
        return Model(rng.normal(0, 0.1, (n, d)).astype(np.float32), rng.normal(0, 0.1, (n, d)).astype(np.float32),
                     (np.eye(d) * 0.5).astype(np.float32), (np.eye(d) * 0.5).astype(np.float32),
                     np.log(prior).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.r, self.q, self.c1, self.c2, self.b]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def like(self, flat: np.ndarray) -> Model:
        out, at = [], 0
        for p in self.parts():
            out.append(flat[at:at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Model(*out)


def _sum_rows(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` by their place ``at`` (of n)."""
    if not len(at):
        return np.zeros((n, *values.shape[1:]), np.float32)
    # 16-bit numbers are sorted by radix, with the same order of equal ones
    order = np.argsort(at.astype(np.uint16) if n <= 1 << 16 else at, kind="stable")
    inner = at[order]
    first = np.flatnonzero(np.append(True, inner[1:] != inner[:-1]))
    out = np.zeros((n, *values.shape[1:]), np.float32)
    out[inner[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


def shares(weights: np.ndarray, batch: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of trigrams to deal into batches and what each counts there.

    A count is divided evenly among the copies of its trigram, and the unit is
    the tokens of a mean batch; over an epoch every trigram so weighs as many
    tokens as it has, whichever batches it is dealt to. At most 1 + 1 / SPLIT
    times as many places as trigrams."""
    weights = weights.astype(np.float64)
    copies = np.maximum(1, np.ceil(weights / (SPLIT * weights.mean()))).astype(np.int64)
    at = np.repeat(np.arange(len(weights)), copies)
    mean = weights.sum() / -(-len(at) // batch)
    return at, (weights / copies / mean).astype(np.float32)[at]


def train(model: Model, prior: np.ndarray, keys: np.ndarray, weights: np.ndarray, seed: int,
          noise: int = NOISE, batch: int = BATCH, least_steps: int = LEAST_STEPS, rate: float = RATE) -> Model:
    """Noise-contrastive estimation over class trigrams (two contexts and the
    class, packed in one integer) with their numbers; AdaGrad. A trigram
    weighs as its tokens (:func:`shares`). Each batch shares its noise classes,
    so both sides are matrix products. The result is the mean of the parameters
    over the second half of the steps."""
    n = len(prior)
    rng = np.random.default_rng(seed)
    r, q, c1, c2, b = (p.copy() for p in model.parts())
    squares = [np.full_like(p, 1e-8) for p in (r, q, c1, c2, b)]
    log_kq = np.log(noise * prior).astype(np.float32)
    cumulative = np.cumsum(prior)
    at, share = shares(weights, batch)
    steps = -(-len(at) // batch)
    turns = max(1, -(-least_steps // max(1, steps)))
    mean, done, averaged = [np.zeros_like(p) for p in (r, q, c1, c2, b)], 0, 0
    for _ in range(turns):
        order = rng.permutation(len(at))
        for k in range(0, len(order), batch):
            pick = order[k:k + batch]
            key, g = keys[at[pick]], share[pick]
            h2, rest = np.divmod(key, n * n)
            h1, w = np.divmod(rest, n)
            fake = np.minimum(np.searchsorted(cumulative, rng.random(noise) * cumulative[-1]), n - 1)
            r1, r2 = r[h1], r[h2]
            a = r1 @ c1 + r2 @ c2
            qw, qf = q[w], q[fake]
            real = 1 / (1 + np.exp(-((a * qw).sum(1) + b[w] - log_kq[w])))
            d_made = a @ qf.T  # the noise's probabilities, in place
            np.subtract(log_kq[fake] - b[fake], d_made, out=d_made)
            np.exp(d_made, out=d_made)
            d_made += 1
            np.divide(g[:, None], d_made, out=d_made)
            d_real = (real - 1) * g
            d_a = d_real[:, None] * qw + d_made @ qf
            d_q = _sum_rows(w, d_real[:, None] * a, n)
            np.add.at(d_q, fake, d_made.T @ a)
            d_b = np.bincount(w, d_real, n).astype(np.float32)
            np.add.at(d_b, fake, d_made.sum(0))
            d_r = _sum_rows(h1, d_a @ c1.T, n) + _sum_rows(h2, d_a @ c2.T, n)
            grads = (d_r, d_q, r1.T @ d_a, r2.T @ d_a, d_b)
            for p, s, d in zip((r, q, c1, c2, b), squares, grads, strict=True):
                root = d * d
                s += root
                np.sqrt(s, out=root)
                d *= rate
                d /= root
                p -= d
            done += 1
            if 2 * done > turns * steps:
                averaged += 1
                for p, m in zip((r, q, c1, c2, b), mean, strict=True):
                    m += p
    return Model(*[m / max(1, averaged) for m in mean])


class Scorer:
    """Normalised log-probabilities of classes. A class score is the sum of
    one entry per context matrix and a bias; the normaliser of a context is
    computed when it is first met, whole batches of contexts at once."""

    def __init__(self, model: Model):
        self.m1 = (model.r @ model.c1) @ model.q.T
        self.m2 = (model.r @ model.c2) @ model.q.T
        self.b = model.b
        self.log_z = np.full(len(model.b) ** 2, np.nan, np.float64)

    def __call__(self, h2: np.ndarray, h1: np.ndarray, w: np.ndarray) -> np.ndarray:
        n = len(self.b)
        context = h2 * n + h1
        z = self.log_z[context]
        new = context[np.isnan(z)]
        if len(new):
            new = np.unique(new)
            for k in range(0, len(new), 2048):
                part = new[k:k + 2048]
                s = self.m2[part // n] + self.m1[part % n] + self.b
                top = s.max(axis=1)
                self.log_z[part] = top + np.log(np.exp(s - top[:, None]).sum(axis=1, dtype=np.float64))
            z = self.log_z[context]
        return (self.m2[h2, w] + self.m1[h1, w] + self.b[w]) - z


def contexts(classes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class before last, last class, class) of whole texts; END stands
    before the first word as well."""
    w = np.concatenate(classes)
    starts = np.cumsum([0, *[len(c) for c in classes[:-1]]])
    h1 = np.empty_like(w)
    h2 = np.empty_like(w)
    h1[1:], h2[2:] = w[:-1], w[:-2]
    h1[starts] = END
    h2[starts] = END
    second = starts[np.array([len(c) for c in classes]) > 1] + 1
    h2[second] = END
    return h2, h1, w


def trigrams(classes: list[np.ndarray], n: int) -> np.ndarray:
    """The contexts of whole texts, each packed in one integer."""
    h2, h1, w = contexts(classes)
    return (h2 * n + h1) * n + w


def counted(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys (below n ** 3) in order, and their numbers."""
    if n ** 3 > 1 << 25:
        return np.unique(keys, return_counts=True)
    counts = np.bincount(keys, minlength=1)
    distinct = np.flatnonzero(counts)
    return distinct, counts[distinct]


# ---------------------------------------------------------------- on Spark

@dataclass
class Vocabulary:
    """Frequent words by falling count; the first ``singles`` are classes.
    ``endings`` names the classes of the others: endings of three, two and one
    bytes to class numbers, looked up in this order, else RARE."""

    words: list[bytes]
    counts: np.ndarray
    singles: int
    tokens: int      # all training tokens, ends included
    types: int       # distinct training tokens, the end included
    ends: int
    endings: list[dict[bytes, int]]
    mass: np.ndarray     # training tokens of a class
    members: np.ndarray  # their distinct words
    index: dict[bytes, int] = field(default_factory=dict)
    known: np.ndarray | None = None  # classes of the frequent words

    @property
    def classes(self) -> int:
        return len(self.mass)

    def prior(self) -> np.ndarray:
        c = self.mass + 1.0
        return c / c.sum()

    def inside(self) -> np.ndarray:
        """log10 of what a word's count + 1 is divided by within its class;
        0 for single words and the end."""
        out = np.log10(self.mass + self.members + 1.0)
        out[END:self.singles + 2] = 0
        return out

    def places(self, words: list[bytes]) -> np.ndarray:
        """Index among the frequent words, -1 elsewhere."""
        if not self.index:
            self.index.update(zip(self.words, range(len(self.words)), strict=True))
        get = self.index.get
        return np.fromiter(map(get, words, repeat(-1)), np.int64, len(words))

    def by_ending(self, word: bytes) -> int:
        three, two, one = self.endings
        return three.get(word[-3:]) or two.get(word[-2:]) or one.get(word[-1:]) or RARE

    def class_of(self, words: list[bytes], places: np.ndarray) -> np.ndarray:
        """Classes of a text's words, and the end."""
        if self.known is None:  # once a worker; the last entry is that of place -1
            self.known = np.array([*range(2, self.singles + 2), *map(self.by_ending, self.words[self.singles:]), RARE])
        out = self.known[places]
        for k in np.flatnonzero(places < 0).tolist():
            out[k] = self.by_ending(words[k])
        return np.append(out, END)


def endings(words: DataFrame, least: float, first: int) -> tuple[list[dict], list[int], list[int]]:
    """Classes of the endings of ``words`` (word, c) that cover ``least`` tokens.

    The driver gets the tokens by two last bytes (65,536 rows at most) and by
    three for the two-byte endings of ``2 * least`` tokens or more, of which
    there are few. An ending of three bytes is cut off from one of two, and one
    of two from one of one, where it covers ``least``; the rest stays together.
    Numbers start at ``first``; the last two lists are tokens and distinct words
    of RARE and of each class."""
    byte = lambda n: F.expr(f"right(hex(cast(word as binary)), {2 * n})")
    sums = (F.sum("c").alias("c"), F.count("*").alias("n"))
    two = {r.e: (r.c, r.n) for r in words.groupBy(byte(2).alias("e")).agg(*sums).collect()}
    heavy = [e for e, (c, _) in two.items() if c >= 2 * least]
    three: dict[str, dict] = {}
    if heavy:
        for r in words.where(byte(2).isin(heavy)).groupBy(byte(2).alias("p"), byte(3).alias("e")).agg(*sums).collect():
            three.setdefault(r.p, {})[r.e] = (r.c, r.n)
    found, mass, members = [{}, {}, {}], [0], [0]

    def add(level: int, ending: str, c: int, n: int):
        found[level][bytes.fromhex(ending)] = first + len(mass) - 1
        mass.append(c), members.append(n)

    one: dict[str, list] = {}
    for e, (c, n) in sorted(two.items()):
        for t, (tc, tn) in sorted(three.get(e, {}).items()):
            if tc >= least and t != e:
                add(0, t, tc, tn)
                c, n = c - tc, n - tn
        if c >= least or (e in three and n):
            add(1, e, c, n)
        elif n:
            rest = one.setdefault(e[-2:], [0, 0])
            rest[0], rest[1] = rest[0] + c, rest[1] + n
    for e, (c, n) in sorted(one.items()):
        if c >= least:
            add(2, e, c, n)
        else:
            mass[0], members[0] = mass[0] + c, members[0] + n
    return found, mass, members


def vocabulary(counts: DataFrame, share: float = SHARE, frequent: int = FREQUENT) -> Vocabulary:
    """``counts``: (word, c). The driver gets sums, a histogram of at most
    some thousand bins, sums by endings, and at most ``frequent`` words."""
    bin_ = F.floor(F.log2(F.col("c").cast("double")) * 32)
    bins = counts.where("word <> ''").groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"), F.sum("c").alias("c"))
    found = sorted(((r.bin, r.n, r.c) for r in bins.collect()), reverse=True)
    ends = counts.where("word = ''").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    cut, room = None, frequent
    for b, n, _ in found:
        if n > room:
            break
        cut, room = b, room - n
    rows = []
    if cut is not None:
        t = counts.where("word <> ''").where(bin_ >= cut).select("word", "c").toArrow()
        rows = sorted(zip(t["c"].to_pylist(), t["word"].to_pylist(), strict=True), key=lambda x: (-x[0], x[1]))
    tokens = ends + sum(c for _, _, c in found)
    least = max(2.0, tokens * share)
    singles = sum(c >= least for c, _ in rows)
    lowest = rows[singles - 1] if singles else None
    # the words behind the last single one, in the same order
    others = counts.where("word <> ''")
    if lowest:
        c, w = F.col("c"), F.col("word")
        others = others.where((c < lowest[0]) | ((c == lowest[0]) & (w > lowest[1])))
    names, mass, members = endings(others, least, singles + 2)
    return Vocabulary([w.encode() for _, w in rows], np.array([c for c, _ in rows], np.int64), singles, tokens,
                      (ends > 0) + sum(n for _, n, _ in found), ends, names,
                      np.array([mass[0], ends, *[c for c, _ in rows[:singles]], *mass[1:]], np.int64),
                      np.array([members[0], 0, *[0] * singles, *members[1:]], np.int64))


def _sequences(texts: DataFrame, vocab, shards: int) -> DataFrame:
    """(shard, seq): the classes of each text, two bytes a token, with the
    shard that a hash of id and text deals it to."""
    def classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.value
        for b in batches:
            seqs = []
            for x in b.column(1):
                words = words_of(x.as_py())
                seqs.append(v.class_of(words, v.places(words)).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(seqs, pa.binary())], names=["shard", "seq"])

    shard = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.col("_text")), F.lit(shards)).cast("int")
    return texts.select(shard.alias("shard"), "_text").mapInArrow(classes, "shard int, seq binary")


def fit(texts: DataFrame, vocab: Vocabulary, shared, dimensions: int = DIMENSIONS, rounds: int = ROUNDS,
        seed: int = SEED, shard_tokens: int = SHARD_TOKENS) -> Model:
    """Rounds of training on every trigram of ``texts`` (``_id``, ``_text``),
    the shards' parameters averaged by Spark."""
    spark = texts.sparkSession
    prior, n = vocab.prior(), vocab.classes
    model = Model.start(prior, dimensions, seed)
    shards = max(1, -(-vocab.tokens // shard_tokens))
    seqs = written(_sequences(texts, shared, shards), "sequences")

    def step(now, turn):
        def local(part):
            shard = part["shard"][0].as_py()
            classes = [np.frombuffer(x.as_py(), np.uint16).astype(np.int64) for x in part["seq"]]
            keys, counts = counted(trigrams(classes, n), n)
            got = train(now.value, prior, keys, counts, seed + 1000 * (turn + 1) + shard).flat().astype(np.float64)
            return pa.table({"at": np.arange(len(got), dtype=np.int32), "v": np.rint(got / UNIT).astype(np.int64),
                             "w": np.full(len(got), counts.sum(), np.int64)})
        return local

    for turn in range(rounds):
        local = step(spark.sparkContext.broadcast(model), turn)
        whole = F.col("v").cast("decimal(20,0)") * F.col("w").cast("decimal(18,0)")
        mean = (seqs.groupBy("shard").applyInArrow(local, "at int, v long, w long").groupBy("at")
                .agg(F.sum(whole).cast("double").alias("vw"), F.sum("w").cast("double").alias("w")).toArrow())
        if mean.num_rows:
            flat = model.flat().astype(np.float64)
            flat[mean["at"].to_numpy()] = mean["vw"].to_numpy() / mean["w"].to_numpy() * UNIT
            model = model.like(flat)
    drop_written(seqs)
    return model


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text: str = "text", share: float = SHARE,
              frequent: int = FREQUENT, dimensions: int = DIMENSIONS, rounds: int = ROUNDS,
              seed: int = SEED) -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens`` (words and the
    end), ``n_known`` (tokens that training documents hold), ``train_tokens``,
    ``base_score`` (add-one unigram) and ``score`` (the model), both log10 of
    the whole text's probability.

    Null text: empty, one token (the end). A null id is a training document.
    Repeated rows count as often as they occur. Without training documents
    every count is zero. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("_id"), held_out(id_col).alias("_held"),
                       F.col(text).cast("string").alias("_text"))
    learn = rows.where("not _held").select("_id", "_text")
    counts = written(word_counts(learn), "counts")
    vocab = vocabulary(counts, share, frequent)
    shared = spark.sparkContext.broadcast(vocab)
    model = spark.sparkContext.broadcast(fit(learn, vocab, shared, dimensions, rounds, seed))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, m = shared.value, model.value
        # normalisers stay between the tasks of a worker
        scorer = worker_state("lm", m.b.tobytes() + m.c1.tobytes(), lambda: Scorer(m))
        log_c, inside = np.log10(v.counts + 1.0), v.inside()
        end = math.log10(v.ends + 1.0)
        for b in batches:
            texts = b.column(2)
            for k in range(0, b.num_rows, 512):
                out: list[list] = [[] for _ in range(6)]
                classes = []
                for x in texts.slice(k, 512):
                    words = words_of(x.as_py())
                    at = v.places(words)
                    known = at >= 0
                    classes.append(v.class_of(words, at))
                    rest = Counter([words[i] for i in np.flatnonzero(~known).tolist()])
                    out[0].append(len(words) + 1)
                    out[1].append(int(known.sum()) + (v.ends > 0))
                    out[2].append(float(log_c[at[known]].sum()) + end)
                    out[3].append(float(log_c[at[known & (at >= v.singles)]].sum()))
                    out[4].append(float(inside[classes[-1]].sum()))
                    out[5].append([{"word": w.decode(), "n": n} for w, n in rest.items()])
                h2, h1, w = contexts(classes)
                starts = np.cumsum([0, *[len(c) for c in classes[:-1]]])
                total = np.add.reduceat(scorer(h2, h1, w), starts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(k, 512), b.column(1).slice(k, 512), pa.array(out[0], pa.int64()),
                     pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64()), pa.array(out[3], pa.float64()),
                     pa.array(out[4], pa.float64()), pa.array(total.astype(np.float64)),
                     pa.array(out[5], pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))],
                    names=["_id", "_held", "n_tokens", "known", "base", "rare", "inside", "classes", "rest"])

    schema = T.StructType([T.StructField("_id", rows.schema["_id"].dataType)]).add("_held", "boolean").add(
        "n_tokens", "long").add("known", "long").add("base", "double").add("rare", "double").add(
        "inside", "double").add("classes", "double").add(
        "rest", T.ArrayType(T.StructType().add("word", "string").add("n", "long")))
    # the row id is fixed by the write; words that are not frequent meet their counts by a join
    part = written(rows.mapInArrow(score, schema).withColumn("_row", F.monotonically_increasing_id()), "scored")
    rest = part.select("_row", F.explode("rest").alias("r")).select("_row", "r.word", "r.n")
    logs = (rest.join(counts, "word")
            .groupBy("_row").agg(F.sum("n").alias("more"),
                                 F.sum(F.col("n") * F.log10(F.col("c") + F.lit(1.0))).alias("more_log")))
    base_unit = math.log10(vocab.tokens + vocab.types + 1)
    more = F.coalesce("more_log", F.lit(0.0))
    return part.drop("rest").join(logs, "_row", "left").select(
        F.col("_id").alias(id_col), F.col("_held").alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(base_unit)).alias("base_score"),
        (F.col("classes") / F.lit(math.log(10)) + F.col("rare") + more - F.col("inside")).alias("score"))
