"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a target number of words: its weight's share of all words,
at most ``max_epochs`` times its own words, the excess shared again by weight
(water filling, solved in closed form from running sums). A document's key is
an exponential variate divided by its quality weight; sources take complete
epochs first and then the documents in key order up to the rest of the
target. Orders are global (source, key) range orders, so a source with a
third of all rows is spread over as many tasks as its rows need.
DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import PART, ROW, placed, running
from .runtime import text_or_empty, word_count, written

#: No source is repeated more often than this.
MAX_EPOCHS = 3
#: Symbols that the default quality weight counts as marks.
MARKS = "#$%&*|~^<>{}[]"
#: Weights by the rank of the source, repeating.
WEIGHT_CYCLE = (1, 2, 3)


def uniform(seed: str, *parts: Column) -> Column:
    """A reproducible uniform in (0, 1): 52 bits of an MD5."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHT_CYCLE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, source_size, target, before)`` from ``(source, source_size)``.

    Sources rank by code point, null last; weights repeat by rank. ``before``
    is the number of words in the sources that rank lower. Integer sums
    throughout; the target is one division and one product of exact values.
    """
    key = sources.select("source", F.col("source").isNull().alias("_null"), "source_size")
    ranked = running(placed(key, ["_null", "source"]), ["_null", "source"],
                     {"rank": F.lit(1).cast("long"), "upto": F.col("source_size").cast("decimal(38,0)")})
    cycle = F.array(*[F.lit(int(w)).cast("long") for w in weights])
    weighed = ranked.select(
        "source", "source_size", (F.col("upto") - F.col("source_size")).cast("long").alias("before"), "rank",
        F.element_at(cycle, (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")).alias("weight"),
        (F.col("source_size") * max_epochs).alias("cap"))
    weighed = weighed.withColumn("fill", F.col("cap") / F.col("weight"))
    # sources are capped in the order of cap / weight: source i is capped when
    # its cap is at most its share of what the sources before it leave
    filled = running(placed(weighed, ["fill", "rank"]), ["fill", "rank"],
                     {"caps": F.col("cap").cast("decimal(38,0)"), "used": F.col("weight").cast("long")}).drop(PART, ROW)
    totals = weighed.agg(F.sum("source_size").cast("decimal(38,0)").alias("total"),
                         F.sum("weight").cast("long").alias("weights"))
    all_ = filled.join(F.broadcast(totals))  # one row
    left = F.col("total") - (F.col("caps") - F.col("cap"))
    capped = all_.withColumn("capped", F.col("cap").cast("decimal(38,0)") * (F.col("weights") - F.col("used") + F.col("weight"))
                             <= left * F.col("weight"))
    rest = capped.agg(F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).cast("long").alias("cap_sum"),
                      F.sum(F.when(~F.col("capped"), F.col("weight")).otherwise(0)).cast("long").alias("open_weight"))
    out = capped.join(F.broadcast(rest))  # one row
    share = ((F.col("total").cast("long") - F.col("cap_sum")).cast("double") * F.col("weight").cast("double")
             / F.col("open_weight").cast("double"))
    return out.select("source", "source_size", "before",
                      F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def symbol_quality(text: Column) -> Column:
    """A cheap quality weight in [0.1, 1]: one less five times the share of
    characters that are markup-like symbols (native; null or empty text: 1)."""
    n = F.length(text)
    marks = n - F.length(F.translate(text, MARKS, ""))
    return F.when(n > 0, F.greatest(F.lit(0.1), 1 - 5 * (marks.cast("double") / n.cast("double")))).otherwise(F.lit(1.0))


def _keyed(docs: DataFrame, quality: Column | None, seed: str, id_col: str, source: str) -> DataFrame:
    q = F.lit(1.0) if quality is None else quality.cast("double")
    q = F.when(q.isNotNull() & ~F.isnan(q) & (q > 0), q).otherwise(F.lit(1.0))
    return docs.select(F.col(id_col).alias("_id"), F.col(source).cast("string").alias("_source"),
                       (-F.log(uniform(seed, F.col(id_col))) / q).alias("_key"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_in"))


def _cuts(rows: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """Per source: size, target, whole epochs and the last (key, id) that the
    fractional epoch takes (null: none). ``rows``: _id, _source, _key, size."""
    units = (rows.groupBy(F.col("_source").isNull().alias("_null"), "_source", "_key", "_id")
             .agg(F.sum("size").alias("words")))
    order = ["_null", "_source", "_key", "_id"]
    units = placed(units, order)
    sources = units.groupBy(F.col("_source").alias("source")).agg(F.sum("words").cast("long").alias("source_size"))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    targets = written(source_targets(sources, weights, max_epochs)
                      .withColumn("epochs", epochs.cast("long")), "targets")
    run = running(units, order, {"upto": F.col("words")}).join(
        targets, F.col("_source").eqNullSafe(F.col("source")))
    start = F.col("upto") - F.col("words") - F.col("before")
    rest = F.col("target") - (F.col("epochs") * F.col("source_size")).cast("double")
    inside = (F.col("source_size") > 0) & ((2 * start + F.col("words")).cast("double") < 2 * rest)
    cut = (run.where(inside).groupBy(F.col("source").alias("_s"))
           .agg(F.max(F.struct("_key", "_id")).alias("_cut")))
    cuts = (targets.join(cut, F.col("source").eqNullSafe(F.col("_s")), "left")
            .select("source", "source_size", "target", "epochs", "_cut"))
    # written, so the planner knows its size: few sources are broadcast and
    # no text is shuffled, very many are joined by AQE
    return written(cuts, "cuts")


def _taken(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Adds ``copies``: epochs of the source, one more up to the cut."""
    extra = F.coalesce(F.struct("_key", "_id") <= F.col("_cut"), F.lit(False)).cast("long")
    return (rows.join(cuts, F.col("_source").eqNullSafe(F.col("source")))
            .withColumn("copies", F.col("epochs") + extra))


def mix(docs: DataFrame, quality: Column | None = None, seed: str = "mix-1", id_col: str = "doc_id",
        text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHT_CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document: id, ``size`` (words), ``source_size``, ``target``,
    ``copies`` (times the mix takes it) and ``taken`` (words taken).

    ``quality``: a positive weight per row (null, zero, negative or NaN: 1);
    a document with twice the weight tends to come earlier in its source.

    Whole epochs first: every document of a source is taken
    floor(target / source_size) times; the rest goes to documents in key order
    while the middle of the document lies within the rest of the target, so a
    source misses its target by at most half a document. Rows of one source
    that share id and key are one document given in parts, taken or left
    together. Null text: size 0. Sources without words have target 0 and take
    nothing; a null source is a source of its own. An empty table gives an
    empty result.
    """
    rows = _keyed(docs, quality, seed, id_col, source)
    rows = written(rows.select("_id", "_source", "_key",
                               word_count(text_or_empty(f"_in.{text}")).alias("size")), "sizes")
    out = _taken(rows, _cuts(rows, weights, max_epochs))
    return out.select(F.col("_id").alias(id_col), "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, quality: Column | None = None, seed: str = "mix-1", id_col: str = "doc_id",
               text: str = "text", source: str = "source",
               weights: tuple[int, ...] = WEIGHT_CYCLE, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as :func:`mix` takes
    it. Texts are read twice (sizes, then output) and never shuffled unless
    the table of sources itself is too large to broadcast."""
    rows = _keyed(docs, quality, seed, id_col, source)
    sizes = written(rows.select("_id", "_source", "_key",
                                word_count(text_or_empty(f"_in.{text}")).alias("size")), "sizes")
    out = _taken(rows, _cuts(sizes, weights, max_epochs)).where("copies > 0")
    return (out.select("_in", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"))
            .select("_in.*"))
