"""Helpers shared by the corpus operators: code shipping, scratch tables,
column names that cannot clash, one-row statistics."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Words of a text are runs of anything but this.
SPACES = r"[\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so Python
    tasks import it wherever the driver was started. Modules imported by
    reference also keep their caches while a Python worker lives."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="fleetlake-code-"), "fleetlake_code.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("fleetlake", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


_kept: dict = {}


def worker_state(owner: str, key, make):
    """What a Python worker keeps between the tasks of one operator: one
    object at a time, so a worker that goes on to another operator (or to
    other parameters) gives the memory back first."""
    if (owner, key) not in _kept:
        _kept.clear()
        _kept[owner, key] = make()
    return _kept[owner, key]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet under ``spark.checkpoint.dir`` and read it
    back: lineage ends at files that every executor can read, so a lost
    executor costs its running tasks only."""
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete a table made by :func:`written` that nothing reads any more."""
    spark = df.sparkSession
    files = df.inputFiles()
    if not files:
        return
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def word_count(text):
    """Number of words of a text column (native): the parts between runs of
    white space, without the empty ones that can stand at both ends."""
    parts = F.split(text, SPACES)
    first, last = F.element_at(parts, 1) == "", F.element_at(parts, -1) == ""
    ends = first.cast("int") + (last & (F.size(parts) > 1)).cast("int")
    return (F.size(parts) - ends).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
