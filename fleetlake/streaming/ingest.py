"""The live ingest as Structured Streaming queries.

Two forms share the parsing and validation of :mod:`.live`:

* :func:`start_outcomes` judges every event exactly once. Each micro-batch
  meets a table of claims (one row per accepted bus and minute, in folders
  bounded by their minutes and merged as they grow): the first valid event of
  an unclaimed key is accepted, every other one is a duplicate, whenever it
  comes. Built-in column functions only; no event is dropped, however late.
* :func:`positions_stream` is the plain streaming frame with Spark's
  watermarked dedup. State is evicted when the watermark passes, and events
  behind the watermark are dropped by Spark; their number is reported by
  :func:`batch_counters`. Use it where late events may go.

Every query has its own checkpoint under ``spark.checkpoint.dir``, so a
restart (or a lost executor) resumes from the last committed batch; sinks are
either the file sink (exactly-once via its commit log) or ``foreachBatch``
writes keyed by ``batch_id`` (idempotent overwrite of one batch's folder). A
sink that fails stops its own query with an error, and the batch is written
when that query is started again.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from .. import config as C
from ..functions.text import rejection_text
from ..operators.aggregate import ingest_counters
from ..operators.audit import activity_log_from_outcomes, log_event
from ..session import checkpoint_dir
from ..sinks import versioned
from .live import (
    ACCEPTED,
    REJECTED_DUPLICATE,
    REJECTED_INVALID,
    check_events,
    dedup_batch,
    enrich_positions,
    with_minute,
    with_reason,
)

PING_EVENT_SCHEMA = ("bus_id string, ruta string, velocidad_kmh string, latitud string, longitud string, "
                     "ts string")


def read_ping_events(spark: SparkSession, path: str, fmt: str = "json", schema: str = PING_EVENT_SCHEMA,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-based event stream (one JSON object per line by default).
    Every field is read as text; the normaliser decides what parses."""
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def read_kafka_events(spark: SparkSession, servers: str, topic: str,
                      schema: str = PING_EVENT_SCHEMA) -> DataFrame:
    """The same events from a Kafka topic (needs the Kafka connector
    on the classpath). The message timestamp is the arrival time."""
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
           .option("subscribe", topic).load())
    return parse_messages(raw, schema)


def parse_messages(raw: DataFrame, schema: str = PING_EVENT_SCHEMA) -> DataFrame:
    """The events of Kafka messages (``value`` bytes, ``timestamp``): one row
    per message. A missing time or one that does not parse is the arrival
    time; a message that is no JSON object has NULL fields, which the
    normaliser rejects."""
    parsed = raw.select(F.from_json(F.col("value").cast("string"), schema).alias("e"),
                        F.col("timestamp").alias("_arrival"))
    return parsed.select("e.*", "_arrival").withColumn("ts", F.coalesce(F.col("ts").try_cast("timestamp"),
                                                                         F.col("_arrival"))).drop("_arrival")


def with_event_time(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time as TIMESTAMP (a watermark needs it; TIMESTAMP_NTZ and text
    are converted). Events without a time get the processing time, the
    arrival-time rule of the original service."""
    return events.withColumn(ts, F.coalesce(F.col(ts).cast("timestamp"), F.current_timestamp()))


def split_stream(events: DataFrame, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) normalised events of a stream (stateless)."""
    checked = check_events(with_event_time(events, ts), ts)
    return (checked.where(F.col("_check").isNull()).drop("_check"),
            with_reason(checked.where(F.col("_check").isNotNull())))


def dedup_stream(valid: DataFrame, ts: str = "ts", delay: str = "2 minutes") -> DataFrame:
    """R2: one accepted ping per bus and minute; only valid events claim a
    key. State per key lives until the watermark passes it; events behind the
    watermark are dropped (and counted by Spark)."""
    keyed = valid.withColumn("minuto", F.date_trunc("minute", F.col(ts)))
    return keyed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["bus_id", "minuto"]).drop("minuto")


def positions_stream(events: DataFrame, weather: DataFrame | None = None, ts: str = "ts",
                     delay: str = "2 minutes", observe: bool = True) -> tuple[DataFrame, DataFrame]:
    """(positions, rejected) streams from raw events.

    With ``observe`` the positions query reports per micro-batch the number
    of valid events (``validos``) and of accepted ones (``aceptados``) as
    observed metrics (A8/R6); duplicates = validos - aceptados, see
    :func:`batch_counters`.
    """
    valid, rejected = split_stream(events, ts)
    if observe:
        valid = valid.observe("validos", F.count(F.lit(1)).alias("validos"))
    accepted = dedup_stream(valid, ts, delay)
    if observe:
        accepted = accepted.observe("aceptados", F.count(F.lit(1)).alias("aceptados"))
    return enrich_positions(accepted, weather, ts), rejected


def _progress_counters(p) -> dict:
    """The counters of one progress record (an object, or its dict form)."""
    def field(p, name):
        return p.get(name) if isinstance(p, dict) else getattr(p, name, None)

    def metric(m, name):
        r = m.get(name)
        if r is None:
            return 0
        return r.get(name, 0) if isinstance(r, dict) else r[name]

    m = field(p, "observedMetrics") or {}
    v, a = metric(m, "validos"), metric(m, "aceptados")
    late = sum(field(s, "numRowsDroppedByWatermark") or 0 for s in field(p, "stateOperators") or [])
    return {"batch_id": field(p, "batchId"), "validos": v, "aceptados": a, "tardios": late, "duplicados": v - a - late}


def batch_counters(query: StreamingQuery) -> list[dict]:
    """Per micro-batch counters from the query's progress: valid and
    accepted events (observed metrics), late ones (dropped behind the
    watermark, Spark's state metrics) and the rest, which are duplicates.
    Spark keeps the last 100 records only; :class:`CounterRecorder` keeps all."""
    return [_progress_counters(p) for p in query.recentProgress]


class CounterRecorder(StreamingQueryListener):
    """Keeps every micro-batch's counters of one query as a small file,
    ``path/<query id>/<batch id>.json``, for the life of the stream. The query
    id survives restarts, and a batch that reports twice counts once. Register
    it with ``spark.streams.addListener`` before the query starts."""

    def __init__(self, spark: SparkSession, path: str, query_name: str | None = None):
        self._spark, self._path, self._name = spark, path, query_name

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        if self._name is None or p.name == self._name:
            versioned.create_if_absent(self._spark, f"{self._path}/{p.id}/{p.batchId:012d}.json",
                                       json.dumps(_progress_counters(p)))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


RECORD_SCHEMA = "batch_id long, validos long, aceptados long, tardios long, duplicados long"


def recorded_counters(spark: SparkSession, path: str) -> DataFrame:
    """The rows kept by :class:`CounterRecorder`, one per batch and query."""
    return spark.read.schema(RECORD_SCHEMA).option("recursiveFileLookup", True).json(path)


def start_logged(spark: SparkSession, start, log_path: str, name: str = "ingest") -> StreamingQuery:
    """Start a streaming query with a start row in the activity log;
    :func:`stop_logged` writes the stop row."""
    q = start()
    log_event(spark, "stream_start", f"{name} id={q.id}", "OK", path=log_path)
    return q


def stop_logged(spark: SparkSession, query: StreamingQuery, log_path: str, name: str = "ingest") -> None:
    query.stop()
    log_event(spark, "stream_stop", f"{name} id={query.id}", "OK", path=log_path)


def _ckpt(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "streams", name)


#: JSON writers cut times to milliseconds unless told otherwise.
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def start_lake_sink(positions: DataFrame, path: str, name: str | None = "positions_lake",
                    trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """K7: NDJSON lake files partitioned by ingest day (yyyyMMdd), written
    by the file sink (exactly-once through its commit log)."""
    spark = positions.sparkSession
    out = positions.withColumn("day", F.date_format("ingest_timestamp", "yyyyMMdd"))
    w = (out.writeStream.format("json").partitionBy("day").option("path", path).option("timestampFormat", JSON_TIME)
         .option("checkpointLocation", checkpoint or _ckpt(spark, name or os.path.basename(path)))
         .outputMode("append"))
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or {"availableNow": True})).start()


REQUIRED_POSITION_COLUMNS = ["viaje_id", "bus_id"]
POSITION_SCHEMA = ("viaje_id string, bus_id string, ruta string, ruta_raw string, velocidad_kmh double, latitud double, "
                   "longitud double, hora long, dia_semana string, nivel_congestion string, clima_condicion string, "
                   "clima_temperatura double, ingest_timestamp timestamp")


def start_table_sink(positions: DataFrame, path: str, name: str = "positions_table",
                     trigger: dict | None = None) -> StreamingQuery:
    """K8 + K5: append to the positions table (parquet files); a row with a
    NULL in a required column fails the batch instead of being stored."""
    from ..sinks.files import check_not_null
    spark = positions.sparkSession
    w = (check_not_null(positions, REQUIRED_POSITION_COLUMNS).writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", _ckpt(spark, name)).queryName(name).outputMode("append"))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def start_fanout(positions: DataFrame, rejected: DataFrame, base: str, trigger: dict | None = None,
                 log_path: str | None = None) -> dict[str, StreamingQuery]:
    """K9 + R4: the accepted positions to the lake (JSON by day) and to the
    table (parquet), the rejected events to their log: three queries with a
    checkpoint each. A failing sink (or a NULL in a required column) writes a
    warning row to the activity log and fails its own query only; the batch is
    not committed and is written when that query is started again. Lake and
    table are committed batch by batch (:mod:`..sinks.versioned`): a reader of
    :func:`read_positions` sees whole batches only, and a repeated batch
    changes nothing. Returns the queries by sink."""
    from ..sinks.files import check_not_null
    spark = positions.sparkSession
    log_path = log_path or os.path.join(base, "activity_log")

    def lake(df: DataFrame, batch_id: int):
        rows = check_not_null(df, REQUIRED_POSITION_COLUMNS)
        versioned.commit(rows.withColumn("day", F.date_format("ingest_timestamp", "yyyyMMdd")),
                         os.path.join(base, "lake"), batch_id, fmt="json", partition_by=["day"],
                         options={"timestampFormat": JSON_TIME})

    def table(df: DataFrame, batch_id: int):
        versioned.commit(check_not_null(df, REQUIRED_POSITION_COLUMNS), os.path.join(base, "table"), batch_id)

    def logged(kind, write):
        def run(df: DataFrame, batch_id: int):
            try:
                write(df, batch_id)
            except Exception as e:
                df.sparkSession.createDataFrame(
                    [(f"{kind}-{batch_id}", "sink_error", f"{kind}: {e}", "WARN")],
                    "event_id string, event_type string, description string, status string") \
                    .withColumn("created_at", F.current_timestamp()).write.mode("append").parquet(log_path)
                raise
        return run

    def start(writer, kind):
        return (writer.option("checkpointLocation", os.path.join(base, "_checkpoints", kind))
                .trigger(**(trigger or {"availableNow": True})).start())

    rej = rejected.select(F.expr("uuid()").alias("event_id"), F.lit(C.EVENT_REJECTED).alias("event_type"),
                          rejection_text(F.col("reason")).alias("description"),
                          F.lit("ERROR").alias("status"), F.col("ts").alias("created_at"),
                          "bus_id", "ruta_raw")
    return {
        "lake": start(positions.writeStream.foreachBatch(logged("lake", lake)), "lake"),
        "table": start(positions.writeStream.foreachBatch(logged("table", table)), "table"),
        "rejected": start(rej.writeStream.format("parquet").option("path", os.path.join(base, "rejected")), "rejected"),
    }


def read_positions(spark: SparkSession, base: str) -> DataFrame:
    """K9: the positions table of :func:`start_fanout`, whole batches only."""
    return versioned.read_snapshot(spark, os.path.join(base, "table"), POSITION_SCHEMA)


def run_available(query: StreamingQuery | dict[str, StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait for ``availableNow`` queries to finish, however long they take. A
    limit that is given and reached stops the query and raises; so does a
    query's own failure, after all of them have ended."""
    failed = []
    for q in query.values() if isinstance(query, dict) else [query]:
        try:
            ended = q.awaitTermination() if timeout_s is None else q.awaitTermination(timeout_s)
        except Exception as e:  # noqa: BLE001
            failed.append(e)
            continue
        if timeout_s is not None and not ended:
            q.stop()
            failed.append(TimeoutError(f"the stream had not finished after {timeout_s} s; its output is incomplete"))
    if failed:
        raise failed[0]


def run_concurrently(spark: SparkSession, start_stream, batch_job, timeout_s: float | None = None):
    """Start the streaming query (or queries), run the batch job in the
    same session while it runs (separate output tables), then wait for it."""
    q = start_stream()
    try:
        result = batch_job()
    finally:
        run_available(q, timeout_s)
    return result


# -------------------------------------------------- every event's outcome

CLAIM_SCHEMA = "bus_id string, minuto timestamp, tramo long, batch_id long"
COUNTER_SCHEMA = ("batch_id long, recibidos long, aceptados long, rechazados_validacion long, "
                  "rechazados_duplicado long")


def _tramo(minute):
    """The minute's number, the column by which claim folders are bounded."""
    return (F.unix_seconds(minute) / 60).cast("long")


def judge_batch(events: DataFrame, batch_id: int, base: str, ts: str = "ts",
                weather: Callable[[SparkSession], DataFrame] | None = None) -> None:
    """One micro-batch of :func:`start_outcomes`.

    Claims are a committed table (:mod:`..sinks.versioned`) whose folders carry
    the bounds of their minutes: a batch reads the folders that meet its own
    minutes, and merging keeps their number at some ``8 log(batches)`` however
    long the stream runs. A repeated batch reads the events it stored the first
    time and leaves out its own claims, so it gives the same rows; every folder
    of the batch is overwritten.
    """
    spark = events.sparkSession
    place = lambda kind: os.path.join(base, kind, f"batch_id={batch_id}")
    # stored once, for this batch: the source is read once, and arrival times
    # stay what they were when the batch is repeated
    checked = check_events(with_event_time(events, ts), ts)
    stored = os.path.join(base, "_events")
    if not versioned.commit(checked.withColumn("_tramo", F.when(F.col("_check").isNull(), _tramo(F.col("ts")))),
                            stored, batch_id, replace=True, bound="_tramo"):
        if versioned.manifest(spark, stored)["batch_id"] > batch_id:
            return  # a later batch has begun, so this one is complete
    kept = versioned.manifest(spark, stored)["folders"]
    checked = versioned.read_folders(spark, stored, kept, checked.schema)
    lo, hi = kept[0]["lo"], kept[0]["hi"]
    valid = checked.where("_check IS NULL").drop("_check")
    invalid = with_reason(checked.where("_check IS NOT NULL"))
    claims = os.path.join(base, "claims")
    known = (versioned.read_snapshot(spark, claims, CLAIM_SCHEMA, lo, hi) if lo is not None
             else spark.createDataFrame([], CLAIM_SCHEMA))
    known = known.where((F.col("batch_id") < batch_id) & F.col("tramo").between(lo, hi)).select("bus_id", "minuto")
    first, later = dedup_batch(valid)
    accepted = first.join(known, ["bus_id", "minuto"], "left_anti")
    again = first.join(known, ["bus_id", "minuto"], "left_semi")
    cols = ["bus_id", "ruta", "ruta_raw", "velocidad_kmh", "latitud", "longitud", "ts"]
    out = (invalid.select(*cols, F.lit(REJECTED_INVALID).alias("outcome"), "reason")
           .unionByName(later.unionByName(again, allowMissingColumns=True)
                        .select(*cols, F.lit(REJECTED_DUPLICATE).alias("outcome"), F.lit(C.REASON_DUPLICATE).alias("reason")))
           .unionByName(accepted.select(*cols, F.lit(ACCEPTED).alias("outcome"), F.lit("ok").alias("reason"))))
    out.write.mode("overwrite").parquet(place("outcomes"))
    done = spark.read.parquet(place("outcomes"))
    new = with_minute(done.where(F.col("outcome") == ACCEPTED)).select(
        "bus_id", "minuto", _tramo(F.col("minuto")).alias("tramo"), F.lit(batch_id).cast("long").alias("batch_id"))
    versioned.commit(new, claims, batch_id, bound="tramo")
    versioned.compact(spark, claims, CLAIM_SCHEMA, bound="tramo", order=["tramo", "bus_id"])
    (activity_log_from_outcomes(done).select(F.expr("uuid()").alias("event_id"), "*")
     .write.mode("overwrite").parquet(place("activity_log")))
    if weather is not None:
        kept = done.where(F.col("outcome") == ACCEPTED).select(*cols)
        enrich_positions(kept, weather(spark)).write.mode("overwrite").parquet(place("positions"))
    counters = os.path.join(base, "counters")
    versioned.commit(ingest_counters(done).select(F.lit(batch_id).cast("long").alias("batch_id"), "*"), counters, batch_id)
    versioned.compact(spark, counters, COUNTER_SCHEMA)


def stream_counters(spark: SparkSession, base: str) -> DataFrame:
    """The counters of the whole life of an outcome stream, restarts
    included: one row of sums over its batches."""
    rows = versioned.read_snapshot(spark, os.path.join(base, "counters"), COUNTER_SCHEMA)
    return rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in rows.columns if c != "batch_id"])


def start_outcomes(events: DataFrame, base: str, ts: str = "ts", trigger: dict | None = None,
                   weather: Callable[[SparkSession], DataFrame] | None = None) -> StreamingQuery:
    """Every event's outcome row under ``base/outcomes`` (accepted,
    duplicate or rejected with its reason; exactly one per event, late events
    included), the activity-log rows of rejections and duplicates under
    ``base/activity_log`` and, with ``weather``, the enriched accepted
    positions under ``base/positions``. ``weather`` is called for every
    micro-batch, so days added while the stream runs are seen."""
    return (events.writeStream.foreachBatch(lambda df, n: judge_batch(df, n, base, ts, weather))
            .option("checkpointLocation", os.path.join(base, "_checkpoint"))
            .trigger(**(trigger or {"availableNow": True})).start())
