"""Tables whose readers see whole commits only.

A table is a folder of data folders and a ``_commits`` folder of numbered
manifests. A manifest names every live data folder, so a reader opens the
newest one and reads exactly the folders it lists: it never sees half a batch,
a batch that failed before its commit, or a folder that was merged away.

* A manifest is created only if its number is free, so of two writers one
  wins, and the other one looks again (:func:`create_if_absent`).
* A batch that is repeated after its commit changes nothing; one that failed
  before its commit is written again over its own, unlisted folder.
* Folders carry row counts and the bounds of one column. Readers skip folders
  outside the bounds they ask for, and :func:`compact` merges folders of like
  size, so a table of n batches has some ``WIDTH * log(n)`` folders.
* Replaced folders stay for ``GRACE`` versions, for readers that are still at it.

Manifests are written through Hadoop's file systems, data by Spark's writers.
"""

from __future__ import annotations

import json
import os
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

COMMITS = "_commits"
#: Folders of one size class that are merged into one of the next.
WIDTH = 8
#: Versions for which replaced folders and old manifests stay.
GRACE = 10


class CommitConflict(RuntimeError):
    """Another writer has committed meanwhile."""


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with all its text at once; False if it is there."""
    fs, target = _hadoop(spark, path)
    _, temp = _hadoop(spark, f"{os.path.dirname(path)}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        # a rename that does not overwrite
        files.rename(temp, target, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Exception as e:
        fs.delete(temp, False)
        if "AlreadyExists" in str(e):
            return False
        raise


def names(spark: SparkSession, folder: str) -> list[str]:
    """The visible file names of a folder, sorted; none if it is not there."""
    fs, p = _hadoop(spark, folder)
    found = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in found if not n.startswith("."))


def _text(spark: SparkSession, path: str) -> str:
    fs, p = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


def manifest(spark: SparkSession, path: str) -> dict:
    """The newest manifest; version 0 without folders for a new table."""
    for _ in range(5):
        found = names(spark, f"{path}/{COMMITS}")
        if not found:
            break
        try:
            return json.loads(_text(spark, f"{path}/{COMMITS}/{found[-1]}"))
        except Exception:  # noqa: BLE001 - removed between the listing and the read: look again
            time.sleep(0.05)
    return {"version": 0, "batch_id": -1, "folders": [], "dropped": []}


def read_folders(spark: SparkSession, path: str, folders: list[dict], schema, fmt: str = "parquet") -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load([f"{path}/{f['name']}" for f in folders])


def read_snapshot(spark: SparkSession, path: str, schema, lo=None, hi=None, fmt: str = "parquet") -> DataFrame:
    """The rows of the newest commit. With bounds, folders that lie outside are
    not read; rows inside the folders are not filtered."""
    live = manifest(spark, path)["folders"]
    return read_folders(spark, path, [f for f in live if _meets(f, lo, hi)], schema, fmt)


def _meets(folder: dict, lo, hi) -> bool:
    if lo is None or folder["rows"] and folder["lo"] is None:
        return True
    return folder["rows"] > 0 and folder["lo"] <= hi and lo <= folder["hi"]


def _publish(spark: SparkSession, path: str, state: dict, folders: list[dict], gone: list[dict], batch_id: int) -> dict:
    version = state["version"] + 1
    old = [d for d in state["dropped"] if d["version"] <= version - GRACE]
    dropped = [d for d in state["dropped"] if d not in old] + [{"name": f["name"], "version": version} for f in gone]
    new = {"version": version, "batch_id": max(batch_id, state["batch_id"]), "folders": folders, "dropped": dropped}
    newest = names(spark, f"{path}/{COMMITS}")[-1:]
    stale = newest and int(newest[0].split(".")[0]) >= version
    if stale or not create_if_absent(spark, f"{path}/{COMMITS}/{version:012d}.json", json.dumps(new)):
        raise CommitConflict(f"version {version} of {path} was committed by another writer")
    for d in old:
        _remove(spark, f"{path}/{d['name']}")
    for n in names(spark, f"{path}/{COMMITS}")[:-GRACE]:
        _remove(spark, f"{path}/{COMMITS}/{n}")
    return new


def _store(df: DataFrame, path: str, name: str, bound: str | None, fmt: str, partition_by: list[str],
           options: dict | None = None) -> dict:
    """Write one data folder; count and bounds are observed by the same job."""
    seen = Observation()
    limits = [F.min(F.col(bound).cast("long")).alias("lo"), F.max(F.col(bound).cast("long")).alias("hi")] if bound else []
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"), *limits).write.mode("overwrite").format(fmt)
    out = out.options(**(options or {})).option("partitionOverwriteMode", "static")  # nothing of a failed attempt stays
    (out.partitionBy(*partition_by) if partition_by else out).save(f"{path}/{name}")
    got = seen.get
    return {"name": name, "rows": got["rows"], "lo": got.get("lo"), "hi": got.get("hi")}


def commit(df: DataFrame, path: str, batch_id: int, replace: bool = False, bound: str | None = None,
           fmt: str = "parquet", partition_by: list[str] | None = None, options: dict | None = None) -> bool:
    """Add a batch's rows to the table, or put them in place of all rows
    (``replace``). False, and nothing written, if the batch is in already.
    ``bound`` names a column of whole numbers whose smallest and largest value
    are kept."""
    spark = df.sparkSession
    state = manifest(spark, path)
    if batch_id <= state["batch_id"]:
        return False
    folder = _store(df, path, f"batch_id={batch_id}", bound, fmt, partition_by or [], options)
    gone = state["folders"] if replace else []
    _publish(spark, path, state, ([] if replace else state["folders"]) + [folder], gone, batch_id)
    return True


def size_class(rows: int, width: int = WIDTH) -> int:
    """0 for up to ``width`` thousand rows, one more for each factor ``width``."""
    k, limit = 0, width * 1000
    while rows > limit:
        k, limit = k + 1, limit * width
    return k


def merge_plan(folders: list[dict], width: int = WIDTH) -> list[dict]:
    """The folders to merge next: the smallest size class with ``width`` of
    them, or the oldest ``width`` small ones; nothing if no class is full."""
    classes: dict[int, list[dict]] = {}
    for f in folders:
        classes.setdefault(max(size_class(f["rows"], width), f.get("merges", 0)), []).append(f)
    for k in sorted(classes):
        if len(classes[k]) >= width:
            return classes[k][:width]
    return []


def compact(spark: SparkSession, path: str, schema, bound: str | None = None, width: int = WIDTH,
            order: list[str] | None = None) -> int:
    """Merge folders until no size class is full; the number of merges.
    Readers see the rows once throughout. Not for partitioned folders."""
    done = 0
    while True:
        state = manifest(spark, path)
        group = merge_plan(state["folders"], width)
        if not group:
            return done
        rows = read_folders(spark, path, group, schema)
        parts = max(1, sum(f["rows"] for f in group) // 5_000_000)
        rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order) if order else rows.coalesce(parts)
        folder = _store(rows, path, f"merged={uuid.uuid4().hex}", bound, "parquet", [])
        folder["merges"] = 1 + max(f.get("merges", 0) for f in group)
        live = [f for f in state["folders"] if f not in group] + [folder]
        _publish(spark, path, state, live, group, state["batch_id"])
        done += 1
