"""Corpus pipeline: quality, exact copies, near copies, mix, pieces.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir), calls one operator of ``fleetlake.llm`` with its production
parameters and returns the rows that go on, with the columns of ``documents``
(the last one returns the encoded documents). :func:`run` writes each stage's
rows as Parquet under ``spark.checkpoint.dir`` and reads them again, so a lost
executor repeats tasks of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import exact, mixing, pieces, quality, simhash
from fleetlake.llm.runtime import table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents below half a chance of a good grade go."""
    return quality.quality_filter(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exact dedup: of equal texts the row with the largest id stays."""
    return exact.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup (3-word shingles, 2 bits): the smallest id of each
    component stays."""
    return simhash.simhash_dedup(docs, shingle_words=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources mixed to their target weights; repeated epochs repeat rows."""
    return mixing.mixed_rows(docs, quality=mixing.symbol_quality(F.col("text")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of every document of the mix, 10 % merge-dropout; every epoch of a
    document draws its own merges."""
    return pieces.encode_documents(docs, dropout=0.1, seed=1, apart=True)


STAGES = [
    ("quality_classifier", keep_quality),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("sentencepiece", encode),
]

#: The classifier, the fingerprints and the pieces are beyond SQL; the tests
#: hold the pipeline against brute-force versions of its stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
