"""File and table sources: CSV, JSON array, NDJSON, raw-zone ingest with
checksums, first-available source, load statistics."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from .json_arrays import scan_json_array

PING_SCHEMA = ("ID_Bus string, Ruta string, Velocidad_kmh double, Latitud double, Longitud double, "
               "Timestamp timestamp")
WEATHER_SCHEMA = "fecha date, condicion string, temperatura_promedio double"
TS_PATTERN = "yyyy-MM-dd HH:mm:ss"


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with header and inferred types (a sampling pass over the
    file; prefer an explicit schema at scale, see :func:`load_pings`)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def load_pings(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """CSV with the fixed 6-column ping schema, header skipped. The
    default mode fails on a malformed row, as the warehouse load job does;
    ``PERMISSIVE`` turns bad fields into NULL."""
    return (spark.read.schema(PING_SCHEMA).option("header", True).option("mode", mode)
            .option("timestampFormat", TS_PATTERN).csv(path))


def load_weather_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of weather objects, read by several tasks."""
    return scan_json_array(spark, path, WEATHER_SCHEMA)


def scan_ndjson(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Newline-delimited JSON, explicit or inferred schema."""
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.json(path)


def json_array_to_ndjson(spark: SparkSession, src: str, dst: str, schema: str = WEATHER_SCHEMA) -> DataFrame:
    """Convert a JSON array file into NDJSON files (one object per line)."""
    df = scan_json_array(spark, src, schema)
    df.write.mode("overwrite").json(dst)
    return df


#: Larger files are not read as one value.
WHOLE_FILE = 16 << 20
#: More than any file has: a file in one piece, and one file to a task.
ONE_PIECE = 1 << 50
#: Names by which the line reader unpacks a file. Such files are read as one value.
PACKED = r"\.(gz|bz2|deflate|snappy|lz4|zst|passthrough)$"
BOM = b"\xef\xbb\xbf"


def _running_md5(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per file whose lines come in order, one batch held at a time.
    The line reader drops a byte order mark and does not tell whether the last
    line was closed; the file's size tells both."""
    import hashlib

    def finish(path, size, read, plain, marked):
        left = size - read
        if left not in (0, 1, len(BOM), len(BOM) + 1):
            raise ValueError(f"{path}: {read} bytes in lines, {size} in the file")
        md5 = marked if left >= len(BOM) else plain
        if left in (1, len(BOM) + 1):
            md5.update(b"\n")
        return pa.RecordBatch.from_pydict({"_file": [path], "bytes": [size], "md5": [md5.hexdigest()]})

    file = None
    for batch in batches:
        runs, start = pc.run_end_encode(batch.column("_file")), 0
        for path, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            part = b"\n".join(batch.column("line").slice(start, end - start).to_pylist())
            if file is None or path != file[0]:
                if file is not None:
                    yield finish(*file)
                file = [path, batch.column("size")[start].as_py(), 0, hashlib.md5(), hashlib.md5(BOM)]
            else:
                part = b"\n" + part
            file[2] += len(part)
            file[3].update(part)
            file[4].update(part)
            start = end
    if file is not None:
        yield finish(*file)


def ingest_raw(spark: SparkSession, paths: list[str], whole_file: int = WHOLE_FILE) -> DataFrame:
    """Raw-zone manifest: path, size in bytes and MD5 of every file.

    A missing input raises (as the original stage does); Spark lists no empty
    files. Files of up to ``whole_file`` bytes, and packed ones
    (:data:`PACKED`, up to 2 GB), are hashed as one value by the task that
    reads them. A larger one, of any size, is streamed line by line through one
    task with a running MD5 (hashing is sequential by nature): no shuffle and
    no sort, in the memory of a batch of lines (64 MB, or one longer line).
    Files are hashed side by side, each in a task of its own.
    """
    # filters on file metadata alone keep files out of a scan, unread
    size, key = F.col("_metadata.file_size"), F.col("_metadata.file_path").alias("_file")
    as_one = (size <= whole_file) | F.col("_metadata.file_name").rlike(PACKED)
    files = spark.read.format("binaryFile").load(paths)
    times = files.select(key, "path", F.col("modificationTime").alias("modificado"))
    small = files.where(as_one).select(key, F.col("length").alias("bytes"), F.md5(F.col("content")).alias("md5"))
    # the size of a read's pieces is a setting of its session
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", ONE_PIECE)
    own.conf.set("spark.sql.files.openCostInBytes", ONE_PIECE)
    lines = (own.read.option("lineSep", "\n").text(paths).where(~as_one)
             .select(key, size.alias("size"), F.col("value").cast("binary").alias("line")))
    large = lines.mapInArrow(_running_md5, "_file string, bytes long, md5 string")
    return small.unionByName(large).join(times, "_file").select("path", "bytes", "md5", "modificado")


def first_available(spark: SparkSession, candidates: list[tuple[str, str]]) -> DataFrame:
    """The first readable source among ``(kind, location)`` candidates,
    where kind is ``table``, ``parquet`` or ``csv``; error if none works."""
    errors = []
    for kind, loc in candidates:
        try:
            if kind == "table":
                df = spark.table(loc)
            elif kind == "parquet":
                df = spark.read.parquet(loc)
            elif kind == "csv":
                df = scan_csv(spark, loc)
            else:
                raise ValueError(f"unknown source kind {kind}")
            df.schema  # resolves the relation: a missing path fails here
            return df
        except (AnalysisException, ValueError) as e:
            errors.append(f"{kind}:{loc}: {str(e).splitlines()[0]}")
    raise FileNotFoundError("no source available: " + "; ".join(errors))


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Whole-table scan of a result table."""
    return spark.table(name)


def load_stats(df: DataFrame, name: str = "carga") -> tuple[DataFrame, object]:
    """Attach a row-count observation to a load; the count is filled
    in when the frame is first written or collected (no extra pass)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("registros")), obs
